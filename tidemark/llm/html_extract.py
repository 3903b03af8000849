"""Main text of web pages by wrapper induction.

Every page becomes a small tree of blocks. Pages of one host are aligned by simple tree
matching, each with the host's reference tree, the union of the shapes that the host's pages
have. A matched node whose text is the same on most of the host's pages is template, the others are varying slots. The
wrapper also says where the host's content lies: where its pages mark no article, in the smallest subtree of the reference
that holds most of the varying plain text, summed over all pages. Blocks there are content unless they are template
or lie in a part that serves the site (menus, headers, footers, sidebars, notices, adverts, forms, comments), told by the
element or its names, which varying texts can't tell. Only a page that has no node of that subtree, or whose host has
no wrapper, is judged by its own plain text.

A node that matches nothing, as the reference is bounded and may lack its shape, is counted by its place, the tags that
lead to it, and is template likewise, or if a template text of the reference has that place. So no shape is left out.

Two passes: the first aligns all pages and counts, for each host and node, the pages that
have it and the texts it has; the second aligns again and reads out the content. Shapes are interned and alignments
remembered, so pages of one shape are aligned once a worker. Counts are aggregated before the shuffle, so a hot host is no
single task. No function recurses, so depth is no limit.

In the text, white space inside a block is one space, blocks are trimmed and joined by two \\n.
A null or empty html, or a page without an article or other text, gives the empty text. Pages without
a url, or without a host in it, form one host. A form around an article, or around four fifths of a page's text, is none to fill in,
and a quotation's header and footer are its own. Within an article the names of headings tell nothing, nor do names of more than three words;
words that an article may be about tell a part of the site only where its text is mostly links or is template. Rows that repeat an id are pages of their own, though
equal pages count once for what is template. Broken markup is read as far as browsers would: open elements
end with their parents, paragraphs where the next block begins, and a quote opens a value only after an equals sign.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>\x00]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
#: Attributes whose values name an element.
NAMES = frozenset("class id role aria-label itemprop".split())
UNSEEN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their contents are no text.
RAW = frozenset("script style noscript template iframe object svg math canvas audio video head title textarea select option button".split())
#: Those whose content runs to the end tag, whatever it holds.
OPAQUE = frozenset("script style textarea title iframe noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SITE = frozenset("nav header footer aside form menu dialog".split())
#: Parts of names that tell a part of the site, wherever it lies.
SITE_PARTS = frozenset("ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer menu nav navbar navigation newsletter notice notices pagination popup promo promos promotion replies respond share sharing sidebar sponsor sponsored sponsors subscribe widget contentinfo complementary".split())
#: Those that an article may be about, as a part of a longer name, or in the name of a section: within one they need evidence, most of their text in links or the same text on most of the host's pages.
TOPICS = frozenset("cookie cookies consent menu navigation notice notices promotion share sharing widget".split())
#: Names that tell one outside an article; within it only where most of the text is links, as "social" or "related" may be about anything.
WEAK_PARTS = frozenset("related social".split())
#: What follows a weak part in a name.
LISTS = frozenset("articles bar block box buttons content icons items links list media news pages posts section stories".split())
#: Names that tell one only outside an article, which has headings and alerts of its own.
TOP_PARTS = frozenset("alert banner header masthead search toolbar topbar".split())
ARTICLE_NAME = re.compile(r"(?:^|[\s_-])(?:articlebody|article-body|post-content|entry-content|article-content|main-content|story-body)(?:$|[\s_-])", re.I)
#: An open paragraph ends where one of these begins.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table body article section div main nav aside footer header form".split())


class Node:
    """An element, or a text block with its text; inline elements melt into the block around them."""

    __slots__ = ("chars", "children", "has_article", "has_main", "hidden", "inside", "kind", "linked", "parent", "shape", "site", "tag", "text", "weak")

    def __init__(self, tag: str, parent: Node | None = None, site: bool = False, weak: bool = False, kind: str = ""):
        self.tag, self.parent, self.site, self.weak, self.kind = tag, parent, site, weak, kind
        self.children: list[Node] = []
        self.text = ""
        self.chars = self.linked = self.shape = 0  # characters of text below, and of links; the shape's number
        self.hidden = self.has_article = self.has_main = False
        self.inside = parent is not None and bool(parent.inside or parent.kind)  # an article
        if parent is not None:
            parent.children.append(self)

    def label(self) -> str:
        return self.tag + ("!" if self.site else "") + ("*" if self.kind else "")


def _clean(raw: str) -> str:
    return " ".join(html.unescape(raw).split())


def attributes_of(text: str) -> dict[str, str]:
    """The attributes of a tag by their names, in lower case; the first of a name counts, as in browsers."""
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), double or single or bare)
    return found


def is_hidden(attributes: dict[str, str]) -> bool:
    """Whether an element isn't shown: by the attribute hidden, by aria-hidden or by its style. Values that merely hold such words tell nothing."""
    return "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true" or bool(UNSEEN.search(attributes.get("style", "")))


def _named(names: str, inside: bool, section: bool) -> tuple[bool, bool, bool]:
    """Whether names (of classes, ids and roles) tell a part of the site: surely, perhaps, outside articles. Within an article a name made of many words is a text's, and topics tell only perhaps."""
    sure = weak = top = False
    for name in names.lower().split():
        parts = [x for x in re.split(r"[_-]+", name) if x]
        if not parts or (inside and len(parts) > 3):
            continue
        told = {parts[0], parts[-1]} & SITE_PARTS
        about = inside and told <= TOPICS and (len(parts) > 1 or section)
        sure |= bool(told) and not about
        weak |= bool(told) and about
        weak |= name in WEAK_PARTS or (parts[0] in WEAK_PARTS and parts[-1] in LISTS)
        top |= parts[0] in TOP_PARTS or parts[-1] in TOP_PARTS
    return sure, weak, top


def parse(page: str) -> list[Node]:
    """The page's nodes in page order, its root first. Leaves are text blocks: runs of text and inline markup."""
    root = Node("html")
    nodes, stack, opened = [root], [root], Counter()
    raw: list[str] = []
    anchors, linked, skipping = 0, 0, []

    def close_block() -> None:
        nonlocal linked
        if raw:
            text = _clean("".join(raw))
            if text:
                leaf = Node("#", stack[-1])
                leaf.text, leaf.chars, leaf.linked = text, len(text), min(linked, len(text))
                nodes.append(leaf)
            raw.clear()
        linked = 0

    def close_to(i: int) -> None:
        for x in stack[i:]:
            opened[x.tag] -= 1
        del stack[i:]

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece and not skipping:
            raw.append(piece)
            if anchors:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name, attributes = name.lower(), m.group(3) or ""
        if m.group(1):  # an end tag
            if skipping:
                if name == skipping[-1]:
                    skipping.pop()
                continue
            if name in INLINE:
                anchors = max(0, anchors - (name == "a"))
                continue
            close_block()
            if opened[name] and name != "br":
                close_to(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name))
                anchors = 0
            continue
        if skipping:
            if name == skipping[-1] and name not in OPAQUE and not attributes.rstrip().endswith("/"):
                skipping.append(name)
            continue
        if name == "br":
            raw.append("\n")
            continue
        if name in VOID:
            if name == "hr":
                close_block()
            continue
        given = attributes_of(attributes) if attributes.strip(" /") else {}
        if name in RAW or is_hidden(given):
            if attributes.rstrip().endswith("/") and name not in OPAQUE:
                continue
            if name in OPAQUE:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            else:
                if name not in INLINE:
                    close_block()
                skipping.append(name)
            continue
        if name in INLINE:
            anchors += name == "a"
            continue
        close_block()
        anchors = 0
        if name in ENDS_P and stack[-1].tag == "p":
            close_to(len(stack) - 1)
        elif name in ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ENDS[name]:
                    close_to(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        if name in ("html", "body") and opened[name]:
            continue
        names = " ".join(v for k, v in given.items() if k in NAMES)
        above = stack[-1]
        inside = above.inside or bool(above.kind)
        # an article's headings are named after their words
        sure, weak, top = _named(names, inside, name == "section") if names and name not in ("body", "article", "main") and not (inside and name in HEADINGS) else (False, False, False)
        # a quotation's footer names who said it
        quoted = name in ("header", "footer") and opened["blockquote"] > 0
        site = (name in SITE and not (name == "header" and inside) and not quoted) or sure or (not inside and (weak or top))
        node = Node(name, above, site, weak and inside, "article" if name in ("article", "main") or (names and ARTICLE_NAME.search(names)) else "")
        nodes.append(node)
        stack.append(node)
        opened[name] += 1
    close_block()
    for x in reversed(nodes[1:]):
        x.parent.chars += x.chars
        x.parent.linked += x.linked
        x.parent.has_article |= x.has_article or (x.tag == "article" and not x.site)
        x.parent.has_main |= x.has_main or (bool(x.kind) and not x.site)
    for x in nodes[1:]:
        # a form around the page is no form to fill in
        if x.tag == "form" and x.site and (x.has_main or x.chars * 10 >= nodes[0].chars * 8):
            x.site = False
        if x.weak and x.linked * 2 >= x.chars:
            x.site = True
    for x in nodes[1:]:
        x.hidden = x.site or x.parent.hidden
    return nodes


class Shapes:
    """Trees of labels without texts, interned: equal ones have one number. A run of equal children counts as one that repeats."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.matches: dict[tuple[int, int], int] = {}
        self.alignments: dict[tuple[int, int], dict[int, int]] = {}

    def of(self, label: str, kids: tuple[int, ...]) -> int:
        key = (label, kids)
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.label)
            self.label.append(label)
            self.kids.append(kids)
            self.size.append(1 + sum(self.size[k] for k in kids))
        return found

    def take(self, nodes: list[Node]) -> int:
        """The root's shape; every node's is set."""
        for x in reversed(nodes):
            kids: list[int] = []
            for c in x.children:
                if not kids or kids[-1] != c.shape:
                    kids.append(c.shape)
            x.shape = self.of(x.label(), tuple(kids))
        return nodes[0].shape

    def _table(self, a: int, b: int) -> list[list[int]]:
        """The best matches of the first children of a with the first of b."""
        table = [[0] * (len(self.kids[b]) + 1)]
        for x in self.kids[a]:
            above, row = table[-1], [0]
            for j, y in enumerate(self.kids[b], 1):
                m = self.matches[x, y] if self.label[x] == self.label[y] else 0
                row.append(max(row[j - 1], above[j], above[j - 1] + m))
            table.append(row)
        return table

    def match(self, a: int, b: int) -> int:
        """The size of the largest order-preserving match of two trees (simple tree matching)."""
        if self.label[a] != self.label[b]:
            return 0
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            if (x, y) in self.matches:
                todo.pop()
            elif x == y:
                self.matches[x, y] = self.size[x]
            else:
                open_ = [(c, d) for c in set(self.kids[x]) for d in set(self.kids[y]) if self.label[c] == self.label[d] and (c, d) not in self.matches]
                todo += open_
                if not open_:
                    self.matches[x, y] = self._table(x, y)[-1][-1] + 1
        return self.matches[a, b]

    def aligned(self, a: int, b: int) -> dict[int, int]:
        """The children of b, by their place, that the best match of a and b puts together with children of a."""
        if (a, b) not in self.alignments:
            self.match(a, b)
            pairs: dict[int, int] = {}
            if a == b:
                pairs = {i: i for i in range(len(self.kids[a]))}
            elif self.label[a] == self.label[b]:
                for c in self.kids[a]:
                    for d in self.kids[b]:
                        self.match(c, d)
                table, i, j = self._table(a, b), len(self.kids[a]), len(self.kids[b])
                while i and j:
                    if table[i][j] == table[i - 1][j]:
                        i -= 1
                    elif table[i][j] == table[i][j - 1]:
                        j -= 1
                    else:
                        i, j = i - 1, j - 1
                        pairs[j] = i
            self.alignments[a, b] = pairs
        return self.alignments[a, b]

    def union(self, a: int, b: int) -> int:
        """A tree that holds both: matched children once, the others in between."""
        done: dict[tuple[int, int], int] = {}
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            if (x, y) in done:
                todo.pop()
                continue
            if x == y:
                done[x, y] = x
                continue
            pairs = sorted((i, j) for j, i in self.aligned(x, y).items())
            open_ = [p for p in ((self.kids[x][i], self.kids[y][j]) for i, j in pairs) if p not in done]
            todo += open_
            if open_:
                continue
            out: list[int] = []
            i = j = 0
            for p, q in [*pairs, (len(self.kids[x]), len(self.kids[y]))]:
                out += [*self.kids[x][i:p], *self.kids[y][j:q]]
                if p < len(self.kids[x]):
                    out.append(done[self.kids[x][p], self.kids[y][q]])
                i, j = p + 1, q + 1
            done[x, y] = self.of(self.label[x], tuple(out))
        return done[a, b]

    def encode(self, s: int) -> str:
        out, todo = [], [s]
        while todo:
            x = todo.pop()
            if x < 0:
                out.append(")")
            else:
                out.append("(" + self.label[x])
                todo += [-1, *reversed(self.kids[x])]
        return "".join(out)

    def decode(self, text: str) -> int:
        labels: list[str] = []
        stack: list[list[int]] = [[]]
        for label, end in re.findall(r"\(([^()]*)|(\))", text):
            if end:
                kids = stack.pop()
                stack[-1].append(self.of(labels.pop(), tuple(kids)))
            else:
                labels.append(label)
                stack.append([])
        return stack[0][0]


#: Shapes that a worker remembers before it forgets all.
REMEMBERED = 200_000
MASK = (1 << 64) - 1


def _step(path: int, to: int) -> int:
    """The hash of a path that goes one further."""
    x = ((path ^ (to + 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & MASK
    return x ^ (x >> 29)


def _label_hash(label: str) -> int:
    return xxhash.xxh3_64_intdigest(label)


def signed(x: int) -> int:
    return x - (1 << 63)


def text_hash(text: str) -> int:
    return signed(xxhash.xxh3_64_intdigest(text))


class Worker:
    """What a task remembers: shapes, references and what was read from them."""

    def __init__(self):
        self.shapes, self.references, self.wrappers = Shapes(), {}, {}

    def tidy(self) -> None:
        if len(self.shapes.label) > REMEMBERED or len(self.shapes.matches) > 5 * REMEMBERED:
            self.__init__()

    def reference(self, text: str) -> int:
        if text not in self.references:
            self.references[text] = self.shapes.decode(text)
        return self.references[text]

    def align(self, nodes: list[Node], reference: int) -> list[tuple[Node, int, bool]]:
        """Every node but the root, the hash of its path in the reference, and True; where the match leaves it out, the hash of its place, the labels from the root on, and False."""
        shapes, found = self.shapes, []
        root = shapes.take(nodes)
        todo = [(nodes[0], reference if shapes.label[reference] == shapes.label[root] else None, 0, 1)]
        while todo:
            node, r, path, place = todo.pop()
            of = shapes.aligned(r, node.shape) if r is not None else {}
            k, last = -1, -1
            for c in node.children:
                if c.shape != last:
                    k, last = k + 1, c.shape
                i = of.get(k)
                there = _step(place, _label_hash(c.label()))
                here = there if i is None else _step(path, i)
                found.append((c, signed(here), i is not None))
                if c.children:
                    todo.append((c, None if i is None else shapes.kids[r][i], here, there))
        return found

    def wrapper(self, reference: str, constant: tuple[str, ...], varying: tuple[str, ...]) -> tuple[set[tuple[int, int]], int | None]:
        """(path, text) that are template, also by place, and the path where the content lies unless the reference has marked articles."""
        key = (reference, constant, varying)
        if key not in self.wrappers:
            if len(self.wrappers) > 200:
                self.wrappers.clear()
            fixed = {(int(p), int(h)) for p, h in (c.split(":") for c in constant)}
            chars = {int(p): int(n) for p, n in (v.split(":") for v in varying)}
            shapes, top = self.shapes, self.reference(reference)
            order, places, marked = [], {}, False
            todo = [(top, 0, 1, -1, False)]
            while todo:
                s, path, place, up, hidden = todo.pop()
                hidden |= "!" in shapes.label[s]
                marked |= not hidden and "*" in shapes.label[s]
                at = len(order)
                order.append([up, signed(path), 0 if hidden else chars.get(signed(path), 0), hidden, shapes.label[s] != "#"])
                places[signed(path)] = signed(place)
                todo += [(k, _step(path, i), _step(place, _label_hash(shapes.label[k])), at, hidden) for i, k in enumerate(shapes.kids[s])]
            fixed |= {(places[p], h) for p, h in fixed if p in places}
            for up, _, n, *_ in reversed(order):
                if up >= 0:
                    order[up][2] += n
            region = None
            if order[0][2] and not marked:
                heavy = [x for x in order if x[4] and not x[3] and x[2] * 10 >= order[0][2] * 8]
                region = heavy[-1][1]  # each holds the next, as two can't hold four fifths
            self.wrappers[key] = (fixed, region)
        return self.wrappers[key]


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w = Worker()
    for b in batches:
        out = []
        for t in b.column(1):
            w.tidy()
            out.append(w.shapes.encode(w.shapes.take(parse(t.as_py() or ""))))
        yield pa.record_batch([b.column(0), pa.array(out, pa.string())], names=["host", "shape"])


def _fold_shapes(most: int):
    def run(table: pa.Table) -> pa.Table:
        """The union of a host's shapes, the common ones first; shapes that the union already holds whole add nothing."""
        rows = sorted(zip(table["pages"].to_pylist(), table["shape"].to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
        shapes, reference = Shapes(), None
        for _, text in rows:
            s = shapes.decode(text)
            reference = s if reference is None else shapes.union(reference, s)
            if len(shapes.encode(reference)) > most:
                break
        return pa.table({"host": table["host"].slice(0, 1), "reference": pa.array([shapes.encode(reference)], pa.string())})

    return run


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, path, aligned, hash of the text and plain characters of every text block, once a page; and once for each path that a page has, without a hash."""
    w = Worker()
    for b in batches:
        rows: list[tuple] = []
        for host, text, reference in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
            w.tidy()
            seen: dict[tuple, int] = {}
            for node, path, there in w.align(parse(text.as_py() or ""), w.reference(reference)):
                if node.tag == "#":
                    seen[path, there, None] = 0
                    key = (path, there, text_hash(node.text))
                    seen[key] = seen.get(key, 0) + node.chars - node.linked
            rows += [(host, *key, chars) for key, chars in seen.items()]
        columns = zip(*rows, strict=True) if rows else ([],) * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()), strict=True)], names=["host", "path", "aligned", "hash", "chars"])


def _articles(nodes: list[Node], region: list[Node]) -> list[Node]:
    """Marked articles outside the site's parts; else the wrapper's region; else the smallest subtree with most of the plain text."""
    found: list[Node] = []
    within: set[int] = set()
    for x in nodes[1:]:
        if id(x.parent) in within:
            within.add(id(x))
        elif x.kind and not x.hidden and not (x.tag == "main" and x.has_article):
            found.append(x)
            within.add(id(x))
    found = found or [x for x in region if not x.hidden]
    if found:
        return found
    plain = {id(x): x.chars - x.linked if x.tag == "#" and not x.hidden else 0 for x in nodes}
    for x in reversed(nodes[1:]):
        plain[id(x.parent)] += plain[id(x)]
    whole = plain[id(nodes[0])]
    return [[x for x in nodes if x.tag != "#" and not x.hidden and plain[id(x)] * 10 >= whole * 8][-1]] if whole else []


def main_text(nodes: list[Node], template: frozenset[int] | set[int] = frozenset(), region: list[Node] = ()) -> str:
    """The texts of the articles' blocks that are neither template nor in a part of the site. template: ids of nodes; region: where the host's content lies on this page."""
    chosen = {id(x) for x in _articles(nodes, region)}
    blocks: list[str] = []
    if id(nodes[0]) not in chosen or not nodes[0].hidden:
        for x in nodes[1:]:
            if id(x.parent) in chosen:
                chosen.add(id(x))
            if x.tag == "#" and id(x) in chosen and not x.hidden and id(x) not in template:
                blocks.append(x.text)
    return "\n\n".join(blocks)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w = Worker()
    for b in batches:
        out = []
        for text, reference, constant, varying in zip(b.column(2), *(b.column(i).to_pylist() for i in (3, 4, 5)), strict=True):
            w.tidy()
            nodes = parse(text.as_py() or "")
            fixed, region = w.wrapper(reference, tuple(constant or ()), tuple(varying or ()))
            template, there = set(), []
            if fixed or region is not None:
                if region == signed(0):
                    there.append(nodes[0])
                for node, path, _ in w.align(nodes, w.reference(reference)):
                    if path == region:
                        there.append(node)
                    if node.tag == "#" and fixed and (path, text_hash(node.text)) in fixed:
                        template.add(id(node))
            out.append(main_text(nodes, template, there))
        yield pa.record_batch([b.column(0), b.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, *, least_pages: int = 5, constant_share: float = 0.5, reference_chars: int = 20_000, reference_shapes: int = 200, broadcast_rows: int = 20_000) -> DataFrame:
    """page_id, url, text of every row.

    A text in a slot is template if at least least_pages pages of its host, and more than constant_share of those
    that have the slot, have it there. The reference tree of a host is made of its reference_shapes most frequent
    shapes and stops growing at reference_chars characters of its written form, so that it stays small whatever its pages are
    like; what it lacks is counted by place.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    shapes = rows.select("host", "html").mapInArrow(_shapes, "host string, shape string").groupBy("host", "shape").agg(F.count("*").alias("pages"))
    nth = F.row_number().over(Window.partitionBy("host").orderBy(F.col("pages").desc(), "shape"))
    top = shapes.withColumn("_nth", nth).filter(F.col("_nth") <= reference_shapes).drop("_nth")
    references = C.materialise(top.groupBy("host").applyInArrow(_fold_shapes(reference_chars), "host string, reference string"), "references")
    small = references.limit(broadcast_rows + 1).count() <= broadcast_rows
    hint = F.broadcast if small else (lambda df: df)
    seen, copied = _distinct(rows.select("host", "html"), broadcast_rows)
    slots = seen.join(hint(references), "host").mapInArrow(_slots, "host string, path long, aligned boolean, hash long, chars long").groupBy("host", "path", "aligned", "hash").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    # once written, as the sums below read it twice; texts in places that too few pages share tell nothing
    slots = C.materialise(slots.filter((F.col("n") >= least_pages) | F.col("aligned")), "slots")
    slot = ["host", "path", "aligned"]
    per = slots.groupBy(*slot).agg(F.max(F.when(F.col("hash").isNull(), F.col("n"))).alias("pages"), F.sum("chars").alias("chars")).filter(F.col("pages") >= least_pages)
    # fewer than 1 / constant_share times a page's blocks for each path
    fixed = slots.filter(F.col("hash").isNotNull() & (F.col("n") >= least_pages)).join(per.drop("chars"), slot).filter(F.col("n") > F.col("pages") * constant_share)
    fixed = fixed.groupBy(*slot).agg(F.collect_list("hash").alias("hashes"), F.sum("chars").alias("fixed"))
    varying = F.col("chars") - F.coalesce("fixed", F.lit(0))
    paths = per.join(fixed, slot, "left").select("host", F.transform("hashes", lambda h: F.concat_ws(":", "path", h)).alias("constant"), F.when(F.col("aligned") & (varying > 0), F.concat_ws(":", "path", varying)).alias("varying"))
    # one entry for each node of the bounded reference and each place
    found = paths.groupBy("host").agg(F.flatten(F.collect_list("constant")).alias("constant"), F.collect_list("varying").alias("varying"))
    wrappers = C.materialise(references.join(found, "host", "left"), "wrappers")
    C.discard(slots, references, *copied)
    return rows.join(hint(wrappers), "host").select("page_id", "url", "html", "reference", "constant", "varying").mapInArrow(_read, "page_id long, url string, text string")


def _distinct(pages: DataFrame, broadcast_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """host, html with equal pages once, and the tables it reads. Only pages that have copies, told by a hash first, are shuffled."""
    hashed = pages.withColumn("_hash", F.xxhash64("html"))
    copied = C.materialise(hashed.groupBy("host", "_hash").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n"), "copied")
    n = copied.limit(broadcast_rows + 1).count()
    if not n:
        return pages, [copied]
    found = F.broadcast(copied) if n <= broadcast_rows else copied
    copies = hashed.join(found, ["host", "_hash"], "left_semi").select("host", "html").distinct()
    return hashed.join(found, ["host", "_hash"], "left_anti").select("host", "html").unionByName(copies), [copied]
