"""HTML extraction by wrapper induction: one template per host tells what its pages share.

The element trees of a host's distinct pages are aligned by simple tree matching and merged into a template, first
within each task, then over tasks in two steps, so a large host is spread. Slots whose text is the same on most pages
are template; slots that vary hold content. Copies of a page vote once. A constant container is opened and only the
blocks in it that hold no others are left out, so one that varies elsewhere or holds an article loses nothing else.
Boilerplate may vary too (menus, adverts), so elements whose tag, class, id or role names it are left out, but never
the document, its body, an article or ``main``, or what holds one; and an article may hold a constant paragraph, so
paragraphs and headings inside one always stay. If a page marks no article, its content is what the template leaves.

How sure a constant slot must be follows the number of distinct pages: on up to ``FEW_PAGES`` all must agree, on more
nine tenths. One page alone shows nothing.

Blocks are joined by line breaks in page order; white space inside a block is one space; a ``br`` is white space.

Defined results: a null or broken page gives what can be read of it, at least an empty text; pages without host
are one host; repeated rows are extracted each; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import trees
from tidemark.llm.common import fresh, join_weighted, small, store
from tidemark.llm.trees import Node, Slot

#: Up to so many distinct pages all must have the same text for it to be constant.
FEW_PAGES = 20
#: Groups in which the templates of a host's tasks are merged first.
SALTS = 64
# Elements that are never article text, and names that mark such elements.
LEFT_OUT = frozenset(
    "head script style noscript template iframe object svg canvas nav header footer aside form button select textarea "
    "menu dialog datalist".split()
)
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "disclaimer footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo related "
    "share sharing sidebar social sponsor sponsored subscribe toolbar widget replies reply banner navigation "
    "complementary contentinfo search alert".split()
)
#: First parts of a name that say what an element has or lacks around it, not what it is.
ABOUT = frozenset("no has with without is not tag category cat page type format status lang".split())
#: Names that also count as the last part of another (``post-comments``), unless the element has a heading.
LAST_NAMES = frozenset("ad ads advert comments comment sidebar menu nav navbar footer newsletter share breadcrumb breadcrumbs".split())
ROOTS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEPT_IN_ROOT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table dl figure".split())


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _is_root(node: Node) -> bool:
    return node.tag in ROOTS or (node.tag in trees.BLOCKS and "main" in node.names)


def _holds(node: Node, what: Callable[[Node], bool]) -> bool:
    stack = list(node.children)
    while stack:
        x = stack.pop()
        if not isinstance(x, str):
            if what(x):
                return True
            stack.extend(x.children)
    return False


def _named(node: Node) -> bool:
    """Whether a name says that the element is boilerplate: a whole name, the first part of one, or certain last parts."""
    if node.tag in ("html", "body") or _is_root(node):
        return False
    last = False
    for name in node.names:
        parts = name.replace("_", "-").split("-")
        if name in NAMES or (parts[0] in NAMES and parts[0] not in ABOUT):
            break
        last = last or (parts[0] not in ABOUT and parts[-1] in LAST_NAMES)
    else:
        if not last or _holds(node, lambda x: x.tag in HEADINGS):
            return False
    return not _holds(node, _is_root)


def _skipped(node: Node, in_root: bool) -> bool:
    # An article may have a header of its own: its headings are part of the article.
    return (node.tag in LEFT_OUT and not (in_root and node.tag == "header")) or _named(node)


def _roots(node: Node) -> list[Node]:
    """Outermost articles that are not left out; else outermost ``main`` elements."""
    articles: list[Node] = []
    mains: list[Node] = []
    stack = [(node, False)]
    while stack:
        x, inside = stack.pop()
        if isinstance(x, str) or _skipped(x, False):
            continue
        if x.tag == "article":
            articles.append(x)
            continue
        if _is_root(x):
            if not inside:
                mains.append(x)
            inside = True
        stack.extend((c, inside) for c in reversed(x.children))
    return articles or mains


def _constant(slot: Slot) -> bool:
    if slot.pages <= FEW_PAGES:
        return slot.pages > 1 and slot.votes == slot.pages
    return slot.constant()


def _leaves(node: Node, in_root: bool) -> bool:
    """Whether a constant element goes: not one that holds blocks, nor in an article a paragraph or part of one."""
    if in_root and (node.tag in KEPT_IN_ROOT or node.tag not in trees.BLOCKS):
        return False
    return not _holds(node, lambda x: x.tag in trees.BLOCKS)


class _Text:
    """Collects blocks of text."""

    def __init__(self) -> None:
        self.blocks: list[str] = []
        self.open: list[str] = []

    def close(self) -> None:
        text = " ".join("".join(self.open).split())
        if text:
            self.blocks.append(text)
        self.open = []


def _collect(node: Node, slot: Slot | None, out: _Text, in_root: bool, judged: bool) -> None:
    """Walks the page beside its template. An explicit stack, as pages may be nested deeply."""
    stack: list = [(node, slot)]
    while stack:
        x = stack.pop()
        if x is None:
            out.close()
            continue
        if isinstance(x, str):
            out.open.append(x)
            continue
        node, slot = x
        block = node.tag in trees.BLOCKS
        if block:
            out.close()
            stack.append(None)
        todo: list = []
        pairs = _aligned(node, slot) if slot is not None else {}
        for child in node.children:
            if isinstance(child, str):
                todo.append(child)
            elif child.tag == "br":
                todo.append(" ")
            elif not _skipped(child, in_root):
                own = pairs.get(id(child))
                if not (judged and own is not None and _constant(own) and _leaves(child, in_root)):
                    todo.append((child, own))
        stack.extend(reversed(todo))


def _aligned(node: Node, slot: Slot) -> dict[int, Slot]:
    """The slot of every child, by matching the runs of equal children with the template's."""
    runs: list[list[Node]] = []
    for child in node.children:
        if not isinstance(child, str):
            if runs and runs[-1][0].label == child.label:
                runs[-1].append(child)
            else:
                runs.append([child])
    own = [Slot(r[0].label) for r in runs]
    return {id(n): slot.children[q] for p, q in trees.match(own, slot.children) for n in runs[p]}


def extract(html: str | None, template: Slot | None) -> str:
    """The article's blocks. ``template``: what the pages of its host share, if known."""
    page = trees.parse(html)
    out = _Text()
    roots = _roots(page)
    if roots:
        slots = _slots_at(page, template, roots) if template is not None else {}
        for root in roots:
            _collect(root, slots.get(id(root)), out, True, template is not None)
            out.close()
    else:
        _collect(page, template, out, False, template is not None)
        out.close()
    return "\n".join(out.blocks)


def _slots_at(page: Node, template: Slot, roots: list[Node]) -> dict[int, Slot]:
    wanted, found = {id(r) for r in roots}, {}
    stack = [(page, template)]
    while stack:
        node, slot = stack.pop()
        pairs = _aligned(node, slot)
        for child in node.children:
            if not isinstance(child, str) and id(child) in pairs:
                if id(child) in wanted:
                    found[id(child)] = pairs[id(child)]
                else:
                    stack.append((child, pairs[id(child)]))
    return found


def distinct_pages(pages: DataFrame) -> DataFrame:
    """One row of each page of a host. ``pages``: host, html.

    Digests are counted alone. Pages that do not repeat stay where they are; of those that do, every task sends one.
    """
    marked = pages.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    seen = marked.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n"))
    copied = store(seen.where("n > 1").select("host", "digest"), "copied-pages")
    keys = small(copied)
    alone = marked.join(keys, ["host", "digest"], "left_anti")
    once = marked.join(keys, ["host", "digest"], "left_semi").groupBy("host", "digest").agg(F.min("html").alias("html"))
    return alone.select("host", "html").unionByName(once.select("host", "html"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, n, template) per host. ``pages``: host, html."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Slot] = {}
        for batch in batches:
            for name, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                own = trees.slots_of(trees.parse(html))
                known[name] = trees.merge(known[name], own) if name in known else own
        task = TaskContext.get().partitionId()
        for name, slot in known.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([task % SALTS], pa.int32()), pa.array([trees.dumps(slot)])],
                names=["host", "salt", "template"],
            )

    def join(group: pa.Table) -> pa.Table:
        slot = None
        # In a fixed order, so that a repeated task gives the same template.
        for text in sorted(group["template"].to_pylist()):
            own = trees.loads(text)
            slot = own if slot is None else trees.merge(slot, own)
        return pa.table({c: group[c].slice(0, 1) for c in ("host", "salt")} | {"template": pa.array([trees.dumps(slot)])})

    schema = "host string, salt int, template string"
    parts = store(distinct_pages(pages.select("host", "html")).mapInArrow(learn, schema), "page-templates")
    halves = parts.groupBy("host", "salt").applyInArrow(join, schema)
    whole = halves.groupBy("host").applyInArrow(join, schema)
    counts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    return store(whole.select("host", "template").join(counts, "host"), "host-templates")


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the article of each page."""
    name, n, template = (fresh(c, pages.columns) for c in ("_host", "_n", "_template"))
    kept = [c for c in pages.columns if c != "text"]
    keyed = pages.select(*kept, host(F.col("url")).alias(name))
    found = templates(keyed.select(F.col(name).alias("host"), "html"))
    total = found.agg(F.sum("n").alias("n")).first()["n"] or 0
    named = found.select(F.col("host").alias(name), F.col("n").alias(n), F.col("template").alias(template))
    joined = join_weighted(keyed, named, name, n, total, "left").select(*kept, template)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Slot] = {}
        for batch in batches:
            texts = []
            for html, text in zip(batch.column("html").to_pylist(), batch.column(template).to_pylist(), strict=True):
                if text is not None and text not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[text] = trees.loads(text)
                texts.append(extract(html, known.get(text) if text is not None else None))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], names=[*kept, "text"])

    fields = [f for f in pages.schema.fields if f.name != "text"]
    return joined.mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType())]))
