"""Element trees of web pages, their alignment by simple tree matching, and templates merged from many pages."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import xxhash

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: A start tag ends an open element of its group, up to the element that holds such groups.
GROUPS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}),
}
#: Elements nested deeper than this become siblings at that depth, as browsers do.
MAX_DEPTH = 200
_DIGITS = re.compile(r"\d+")


class Node:
    """An element: its tag, name tokens (class, id, role), and children, which are nodes or texts."""

    __slots__ = ("children", "label", "names", "tag")

    def __init__(self, tag: str, names: tuple[str, ...] = ()) -> None:
        self.tag, self.names, self.children = tag, names, []
        self.label = ".".join([tag, *sorted({_DIGITS.sub("", n) for n in names})])


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.stack = [self.root]

    def _end(self, tags: set[str], within: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                del self.stack[i:]
                return
            if tag in within:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end({"p"}, {"table", "td", "th", "article", "section", "div", "li", "main", "body"})
        if tag in GROUPS:
            self._end(*GROUPS[tag])
        names = [t for k, v in attrs if k in ("class", "id", "role") and v for t in v.lower().split()]
        node = Node(tag, tuple(names))
        if len(self.stack) > MAX_DEPTH:
            self.stack.pop()
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def text_under(node: Node) -> str:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack.extend(reversed(x.children))
    return " ".join(" ".join(out).split())


class Slot:
    """A template node: its label, pages that have it, and the text most of them have there.

    ``votes`` counts pages with that text less those with another, so of a text on nine tenths of the pages at
    least eight tenths remain, in whatever order templates were merged. Neighbouring children of one label are one
    slot (a list's items, a page's paragraphs).
    """

    __slots__ = ("children", "digest", "label", "pages", "votes")

    def __init__(self, label: str, pages: int = 1, digest: int = 0, votes: int = 1, children: list[Slot] | None = None) -> None:
        self.label, self.pages, self.digest, self.votes = label, pages, digest, votes
        self.children = children if children is not None else []

    def dump(self) -> list:
        return [self.label, self.pages, self.digest, self.votes, [c.dump() for c in self.children]]

    @classmethod
    def load(cls, x: list) -> Slot:
        return cls(x[0], x[1], x[2], x[3], [cls.load(c) for c in x[4]])

    def constant(self) -> bool:
        return self.votes * 10 >= self.pages * 8


def slots_of(node: Node) -> Slot:
    """The page as a template of its own."""
    return _slot([node])


def _slot(nodes: list[Node]) -> Slot:
    joined = "\n".join(text_under(n) for n in nodes)
    digest = xxhash.xxh3_64_intdigest(joined.encode("utf-8", "surrogatepass")) >> 1
    runs: list[list[Node]] = []
    for n in nodes:
        for child in n.children:
            if isinstance(child, str):
                continue
            if runs and runs[-1][0].label == child.label:
                runs[-1].append(child)
            else:
                runs.append([child])
    # Across several merged elements the same labels come again: align them by label in order.
    children: list[Slot] = []
    for run in runs:
        children = merge_children(children, [_slot(run)]) if len(nodes) > 1 else [*children, _slot(run)]
    return Slot(nodes[0].label, 1, digest, 1, children)


def match(a: list[Slot], b: list[Slot]) -> list[tuple[int, int]]:
    """Pairs of children that simple tree matching aligns: the most matching nodes, in order."""
    if [x.label for x in a] == [x.label for x in b]:
        return [(i, i) for i in range(len(a))]
    weight = [[_weight(x, y) if x.label == y.label else 0 for y in b] for x in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + weight[i - 1][j - 1])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if weight[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weight[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def _weight(a: Slot, b: Slot) -> int:
    """Nodes in the best matching of two trees with equal roots."""
    if not a.children or not b.children:
        return 1
    row = [0] * (len(b.children) + 1)
    for x in a.children:
        new = [0]
        for j, y in enumerate(b.children, 1):
            new.append(max(row[j], new[j - 1], row[j - 1] + (_weight(x, y) if x.label == y.label else 0)))
        row = new
    return 1 + row[-1]


def merge_children(a: list[Slot], b: list[Slot]) -> list[Slot]:
    out: list[Slot] = []
    i = j = 0
    for p, q in [*match(a, b), (len(a), len(b))]:
        out += a[i:p] + b[j:q]
        if p < len(a):
            out.append(merge(a[p], b[q]))
        i, j = p + 1, q + 1
    return out


def merge(a: Slot, b: Slot) -> Slot:
    """Both templates as one; slots that match are counted together."""
    if a.digest == b.digest:
        digest, votes = a.digest, a.votes + b.votes
    else:
        digest, votes = (a.digest, a.votes - b.votes) if a.votes >= b.votes else (b.digest, b.votes - a.votes)
    return Slot(a.label, a.pages + b.pages, digest, votes, merge_children(a.children, b.children))


def dumps(slot: Slot) -> str:
    return json.dumps(slot.dump(), separators=(",", ":"))


def loads(text: str) -> Slot:
    return Slot.load(json.loads(text))
