import random

import pytest
from tidemark.llm import pages, trees
from tidemark.llm.queries import QUERIES

HEAD = "<head><title>t</title><style>p{}</style><script>var a='</p>';</script></head>"


def extract(html, template=None):
    return pages.extract(html, template)


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<article></article>", ""), ("just text", "just text"),
    (f"<html>{HEAD}<body><nav><ul><li>m</ul></nav><article><h1>A &amp; B</h1><p>x <b>y</b>\n z<p>w</article><footer>f</footer>", "A & B\nx y z\nw"),
    ("<article><p><b>One<br><p>Two</p></article>", "One\nTwo"),
    ("<article><p>a<br>b&nbsp;&#233;&eacute;</p><!-- c --><aside>s</aside><form>f</form></article>", "a b éé"),
    ("<article><p>keep</p><div class='ad big'>no</div><div id=comments><p>no</p></div><section class='article-body'>yes</section></article>", "keep\nyes"),
    ("<article><header><h1>T</h1></header><p>b</p><div role=complementary>n</div></article>", "T\nb"),
    ("<body><main><p>m1<p>m2</main><p>out</body>", "m1\nm2"),
    ("<article><p>1 < 2 &am <p>un<i>closed", "1 < 2 &am\nunclosed"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<article><p>one</p></article><article><p>two</p></article>", "one\ntwo"),
    # Names of what holds an article, or of what an element has around it, take nothing away.
    ("<body class='has-sidebar'><article><p>a</p></article></body>", "a"),
    ("<body class='sidebar'><main class='no-sidebar'><p>b</p></main></body>", "b"),
    ("<div id='main' class='with-nav'><p>c</p></div>", "c"),
    ("<article class='post tag-social category-search'><p>d</p></article>", "d"),
    ("<div class='sidebar'><article><p>held</p></article></div>", "held"),
    ("<article><div class='post-header'><h1>T</h1></div><p>e</p><div class='post-comments'>x</div></article>", "T\ne"),
    ("<article><div class='ad-slot'>x</div><div class='header'>y</div><p class='no-ad'>f</p></article>", "f"),
    ("<main><p>one</p></main><div>no</div><main><p>two</p></main>", "one\ntwo"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>end</p></article>", "deep\nend"),
])
def test_pages_without_template(html, text):
    assert extract(html) == text


def site(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        body = "".join(f"<p>{' '.join(str(rng.random()) for _ in range(3))}</p>" for _ in range(rng.randint(1, 5)))
        extra = "<div class=x>sometimes</div>" if rng.random() < 0.3 else ""
        out.append((f"<body><div class=top><span>Site name</span></div>{extra}<div class=story>{body}</div><div class=low>All rights</div></body>", body))
    return out


def test_constant_slots_are_template():
    data = site(120)
    template = None
    for html, _ in data:
        own = trees.slots_of(trees.parse(html))
        template = own if template is None else trees.merge(template, own)
    for html, body in data:
        assert extract(html, template) == body.replace("</p><p>", "\n").replace("<p>", "").replace("</p>", "")


def learned(htmls):
    template = None
    for h in htmls:
        own = trees.slots_of(trees.parse(h))
        template = own if template is None else trees.merge(template, own)
    return template


def plain(body):
    return body.replace("</p><p>", "\n").replace("<p>", "").replace("</p>", "")


@pytest.mark.parametrize("n", [2, 5, 20, 300])
def test_hosts_of_any_size_show_their_template(n):
    """The same pages give the same texts, however many more their host has."""
    data = site(n, seed=n)
    template = learned([h for h, _ in data])
    for html, body in data:
        # The block that only some pages have is template where it is the same on all that have it.
        assert extract(html, template).replace("sometimes\n", "") == plain(body)


def test_one_page_shows_nothing():
    html, body = site(1)[0]
    assert extract(html, learned([html])) == "Site name\n" + plain(body) + "\nAll rights"


def test_constant_containers_are_opened():
    pages_ = [f"<body><div class=wrap><div class=top>Site</div><div class=box><p>same</p><p>x{i}</p></div></div></body>" for i in range(30)]
    template = learned(pages_)
    assert extract(pages_[3], template) == "same\nx3"
    kept = ["<article><div class=entry><div class=in><p>the text</p></div></div></article>"] * 2
    assert extract(kept[0], learned(kept)) == "the text"


def test_copies_vote_once(spark):
    """Nine tenths of a host are copies of one page whose article is a plain div: its text stays."""
    copy = "<body><div class=top>Site</div><div class=story>the article</div></body>"
    others = [f"<body><div class=top>Site</div><div class=story>text {i}</div></body>" for i in range(4)]
    rows = [(i, "http://h.org/", copy) for i in range(60)] + [(100 + i, "http://h.org/", h) for i, h in enumerate(others)]
    rows += [(200 + i, "http://lone.org/", copy) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert pages.distinct_pages(df.selectExpr("url AS host", "html")).count() == 6
    got = {r["page_id"]: r["text"] for r in pages.extract_text(df).collect()}
    assert all(got[i] == "the article" for i in range(60)) and got[101] == "text 1"
    # One distinct page shows no template: the host's only page is whole.
    assert all(got[200 + i] == "Site\nthe article" for i in range(30))


def test_merging_in_any_order_keeps_counts():
    parts = [trees.slots_of(trees.parse(h)) for h, _ in site(24)]
    left = parts[0]
    for p in parts[1:]:
        left = trees.merge(left, p)
    halves = [parts[0], parts[12]]
    for i in range(1, 12):
        halves = [trees.merge(halves[0], parts[i]), trees.merge(halves[1], parts[12 + i])]
    both = trees.merge(*halves)

    def flat(s):
        yield s.label, s.pages, s.constant()
        for c in s.children:
            yield from flat(c)

    assert sorted(flat(left)) == sorted(flat(both))
    assert trees.loads(trees.dumps(both)).dump() == both.dump()


def test_matching_keeps_order():
    def tree(x):
        return trees.Slot(x[0], children=[tree(c) for c in x[1:]])

    a = tree(["r", ["a", ["x"]], ["b"], ["a", ["y"], ["z"]]])
    b = tree(["r", ["a", ["y"], ["z"]], ["c"]])
    assert trees.match(a.children, b.children) == [(2, 0)]


def test_articles_keep_constant_paragraphs():
    html = "<article><div class=kicker>Daily</div><p>the same</p></article>"
    template = trees.slots_of(trees.parse(html))
    for _ in range(30):
        template = trees.merge(template, trees.slots_of(trees.parse(html)))
    assert extract(html, template) == "the same"


def test_operator(spark, small):
    rows = [(i, f"http://A.example.org/{i}", h, "old") for i, (h, _) in enumerate(site(30))]
    rows += [(100, None, "<p>x</p>", "o"), (101, "not a url", None, "o"), (102, "https://u:p@b.org:80/x", "<article>q</article>", "o")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    out = pages.extract_text(df)
    assert out.columns == ["page_id", "url", "html", "text"]
    got = sorted((r["page_id"], r["text"]) for r in out.collect())
    assert len(got) == len(rows) and all("Site name" not in t for _, t in got)
    assert got[-6:] == [(100, "x")] * 2 + [(101, "")] * 2 + [(102, "q")] * 2
    assert pages.extract_text(df.where("false")).count() == 0
    whole = QUERIES["op7_html_text"](spark, small).collect()
    assert len(whole) == spark.read.parquet(f"{small}/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) for r in whole)
