"""Main text of web pages by wrapper induction over pages of one host.

Pages of a host are dealt to groups of a few dozen (a host with a third of
all pages makes many groups), and every page takes part. In a group

1. each page becomes a tree of elements;
2. simple tree matching aligns each page with the page that has most places in
   common with the others: the largest number of node pairs that keeps order
   and ancestry, sibling by sibling;
3. a node that is the same on nearly all aligned pages is template, a slot that
   varies is content. Pages that are mostly copies of each other count once, so
   that copied articles are not taken as template;
4. content slots in the main region are the main text: main, else the articles,
   else the body. What is never part of an article (menus, headers, footers,
   sidebars, forms, notices, adverts, comments) goes even where it varies, by
   its element; class words only decide about elements that don't hold most of
   the page or an article.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, light_task, materialize
from .url_filter import host_of

#: Pages that a group holds, about.
GROUP_PAGES = 32
#: A node is template if it is the same on this share of the other pages, and on at least so many; paragraphs of an article need more.
CONSTANT_SHARE, CONSTANT_PAGES, PROSE_PAGES = 0.8, 2, 4
#: Pages that share this part of their blocks are copies of one page to the vote.
COPIED_SHARE = 0.5
#: Cells of an alignment table that are kept at once; larger ones are halved until they fit.
TABLE_CELLS = 4_000_000

#: Elements of the HTML standard by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPE = frozenset("ul ol dl table select body html article section div main".split())
NEVER = frozenset("nav footer aside form script style noscript template iframe svg canvas button select textarea input head title object embed audio video dialog menu fieldset label".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
LISTED = frozenset("li dt dd td th".split())
#: Words in class, id or role that mark what is not part of an article, and words that say that it has or lacks such.
NOT_CONTENT = frozenset(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar aside rail widget "
    "footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond reply replies "
    "share sharing social related recommended pagination pager toolbar complementary contentinfo search".split()
)
MODIFIERS = frozenset("no has with without is not".split())

OPENING = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile(r"""[>"']""")
CLOSING = {tag: re.compile(rf"</{tag}(?![^\s/>])[^>]*>?", re.I) for tag in RAW}
HINT = re.compile(r"""(?<![^\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")


class Node:
    """An element.

    ``names``: the words of each of its class, id and role values; ``shape`` and
    ``print``: equal for equal trees without and with their texts; ``length`` of
    its text; does it hold ``prose`` (is it any), or a ``region``; on how many
    other pages it is the ``same``, and on how many ``apart`` from each other.
    """

    __slots__ = ("tag", "names", "children", "label", "elements", "shape", "print", "length", "prose", "region", "same", "apart")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.elements, self.length, self.same, self.apart = tag, [], (), 0, 0, 0
        found = HINT.findall(attributes) if "=" in attributes else ()
        values = " ".join(a or b or c for a, b, c in found).split()
        self.label = f"{tag} {' '.join(values)}" if values else tag
        self.names = [tuple(w.lower() for w in CAMEL.split(v) if w) for v in values]


def _tag_end(html: str, at: int) -> int:
    """Where a tag that is open at ``at`` ends: behind the next ">" outside quoted values; -1 if there is none.

    A quote that is never closed is no quote. Nothing is looked at twice.
    """
    while m := STOP.search(html, at):
        at = m.end()
        if m[0] == ">":
            return at
        if html[: m.start()].endswith("=") if m.start() < 64 else html[m.start() - 64 : m.start()].rstrip().endswith("="):
            close = html.find(m[0], at)
            if close < 0:
                end = html.find(">", at)
                return end + 1 if end >= 0 else -1
            at = close + 1
    return -1


def parse(html: str) -> Node:
    """A forgiving parser, in time that grows with the page: what is never closed ends with its parent, an unfinished tag at the end is left out."""
    root = Node("#root")
    stack = [root]
    opened: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]  # open elements since each element that bounds implied ends

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            tag = stack.pop().tag
            opened[tag] -= 1
            if tag in SCOPE:
                scopes.pop()
            scopes[-1][tag] -= 1

    def close_one_of(tags: set[str]) -> None:
        """End the nearest open element of these, if no scope begins after it."""
        if any(scopes[-1][t] > 0 for t in tags):
            depth = len(stack) - 1
            while stack[depth].tag not in tags:
                depth -= 1
            close_to(depth)

    at, end = 0, len(html)
    while at < end:
        m = OPENING.search(html, at)
        start = m.start() if m else end
        if start > at:
            stack[-1].children.append(html[at:start])
        if not m:
            break
        if m[0] == "<!--":
            stop = html.find("-->", m.end() - 2)
            at = stop + 3 if stop >= 0 else end
        elif m[0] in ("<!", "<?"):
            stop = html.find(">", m.end())
            at = stop + 1 if stop >= 0 else end
        elif m[0][1] == "/":
            tag = NAME.match(html, m.end() - 1)[0].lower()
            stop = html.find(">", m.end())
            at = stop + 1 if stop >= 0 else end
            if opened[tag] > 0 and (tag in SCOPE or scopes[-1][tag] > 0 or tag not in CLOSED_BY and tag != "p"):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close_to(depth)
        else:
            name = NAME.match(html, m.end() - 1)
            tag, stop = name[0].lower(), _tag_end(html, name.end())
            if stop < 0:
                break
            attributes, at = html[name.end() : stop - 1], stop
            if tag in BLOCK:
                close_one_of({"p"})
            if tag in CLOSED_BY:
                close_one_of(CLOSED_BY[tag])
            node = Node(tag, attributes)
            stack[-1].children.append(node)
            if tag in RAW:
                raw = CLOSING[tag].search(html, at)
                at = raw.end() if raw else end
            elif tag not in VOID and not attributes.endswith("/"):
                scopes[-1][tag] += 1
                stack.append(node)
                opened[tag] += 1
                if tag in SCOPE:
                    scopes.append(Counter())
    return root


def post_order(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo.extend(c for c in x.children if type(c) is not str)
    return out[::-1]


class Aligner:
    """Simple tree matching of the trees of one group. Trees of equal shape have one number, and what is known of two shapes is kept."""

    def __init__(self):
        self.shapes: dict[tuple, int] = {}
        self.sizes: list[int] = []
        self.labels: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.known: dict[tuple[int, int], int] = {}

    def measure(self, root: Node) -> None:
        """Number the shapes, and note prints and text lengths, from the leaves up."""
        for x in post_order(root):
            x.elements = tuple(c for c in x.children if type(c) is not str and (c.tag in BLOCK or c.elements))
            key = (x.label, *(c.shape for c in x.elements))
            if key not in self.shapes:
                self.shapes[key] = len(self.sizes)
                self.sizes.append(1 + sum(self.sizes[s] for s in key[1:]))
                self.labels.append(x.label)
                self.kids.append(key[1:])
            x.shape = self.shapes[key]
            parts = [x.label, *(" ".join(c.split()) if type(c) is str else c.print for c in x.children)]
            x.print = xxhash.xxh3_128_hexdigest("\x00".join(p for p in parts if p))
            x.length = sum(len(c.strip()) if type(c) is str else c.length for c in x.children)
            x.prose = x.tag in PROSE or any(c.prose for c in x.elements)
            x.region = any(c.region or c.tag in ("article", "main") for c in x.elements)

    def weights(self, a: tuple[int, ...], b: tuple[int, ...]) -> np.ndarray:
        """Pairs that each two children would give; each two shapes are looked at once."""
        rows, row_of = np.unique(np.array(a), return_inverse=True)
        columns, column_of = np.unique(np.array(b), return_inverse=True)
        by_label = defaultdict(list)
        for k, s in enumerate(columns.tolist()):
            by_label[self.labels[s]].append((k, s))
        table = np.zeros((len(rows), len(columns)), np.int64)
        for i, s in enumerate(rows.tolist()):
            for k, t in by_label.get(self.labels[s], ()):
                table[i, k] = self.pairs(s, t)
        return table[row_of][:, column_of]

    def pairs(self, a: int, b: int) -> int:
        """The largest number of node pairs of two shapes."""
        if self.labels[a] != self.labels[b]:
            return 0
        if a == b:
            return self.sizes[a]
        if not self.kids[a] or not self.kids[b]:
            return 1
        if (a, b) not in self.known:
            self.known[a, b] = 1 + int(_last_row(self.weights(self.kids[a], self.kids[b]))[-1])
        return self.known[a, b]

    def align(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """The aligned nodes of two trees, those given included."""
        out, todo = [], [(a, b)]
        while todo:
            x, y = todo.pop()
            if x.label != y.label:
                continue
            out.append((x, y))
            if x.elements and y.elements:
                if x.shape == y.shape:
                    todo.extend(zip(x.elements, y.elements, strict=True))
                else:
                    w = self.weights(self.kids[x.shape], self.kids[y.shape])
                    todo.extend((x.elements[i], y.elements[j]) for i, j in best_pairs(w))
        return out


def _last_row(w: np.ndarray) -> np.ndarray:
    """The last row of the alignment table of a matrix of weights: the best sum for each number of columns."""
    row = np.zeros(w.shape[1] + 1, np.int64)
    for own in w:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + own))
    return row


def best_pairs(w: np.ndarray, cells: int = TABLE_CELLS) -> list[tuple[int, int]]:
    """Pairs of rows and columns in order with the greatest sum of weights, none of them 0.

    A table of more than ``cells`` is halved by rows where the two halves fit
    best, which gives the same sum in memory that grows with its edges.
    """
    m, n = w.shape
    if not m or not n:
        return []
    if m * n > cells and m > 1:
        half = m // 2
        cut = int((_last_row(w[:half]) + _last_row(w[half:][::-1, ::-1])[::-1]).argmax())
        return best_pairs(w[:half, :cut], cells) + [(i + half, j + cut) for i, j in best_pairs(w[half:, cut:], cells)]
    table = np.zeros((m + 1, n + 1), np.int64)
    for i in range(m):
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + w[i]))
    out, i, j = [], m, n
    while i and j:
        if table[i, j] == table[i, j - 1]:
            j -= 1
        elif table[i, j] == table[i - 1, j]:
            i -= 1
        else:
            out.append((i - 1, j - 1))
            i, j = i - 1, j - 1
    return out[::-1]


def _blocks_of(root: Node) -> set[str]:
    """The prints of the lowest blocks of prose, or of all lowest blocks if there is no prose."""
    low = [x for x in post_order(root) if x.length and x.tag in BLOCK and not x.elements and x.tag not in NEVER]
    return {x.print for x in low if x.prose or not root.prose}


def _places(root: Node) -> set[str]:
    """The paths of a tree's upper elements."""
    out, todo = set(), [(root, "", 0)]
    while todo:
        x, path, depth = todo.pop()
        path = f"{path}/{x.label}"
        out.add(path)
        if depth < 6:
            todo.extend((c, path, depth + 1) for c in x.elements)
    return out


def induce(trees: list[Node], aligner: Aligner) -> None:
    """Note on each node on how many other pages it is the same, if those are nearly all.

    ``same`` counts pages that differ at all; ``apart`` only pages whose prose
    is not mostly that of another one, so that copies have one vote.
    """
    distinct = list({t.print: t for t in reversed(trees)}.values())
    if len(distinct) < 2:
        return
    apart: list[set[str]] = []
    voters = set()
    for tree in distinct:
        own = _blocks_of(tree)
        if not any(len(own & other) > COPIED_SHARE * min(len(own), len(other)) for other in apart):
            apart.append(own)
            voters.add(id(tree))
    places = Counter(p for t in distinct for p in _places(t))
    middle = max(distinct, key=lambda t: sum(places[p] - 1 for p in _places(t)) / max(1, len(_places(t))))
    all_votes: dict[int, Counter[str]] = defaultdict(Counter)
    own_votes: dict[int, Counter[str]] = defaultdict(Counter)
    ids, aligned = {id(t) for t in distinct}, []
    for tree in trees:
        pairs = aligner.align(middle, tree)
        aligned.append((id(tree) in voters, pairs))
        for mine, its in pairs if id(tree) in ids else ():
            all_votes[id(mine)][its.print] += 1
            if id(tree) in voters:
                own_votes[id(mine)][its.print] += 1
    for votes_itself, pairs in aligned:
        for mine, its in pairs:
            if its.length:
                same, others = all_votes[id(mine)][its.print] - 1, own_votes[id(mine)][its.print] - votes_itself
                its.same = same if same >= CONSTANT_SHARE * (len(distinct) - 1) else 0
                its.apart = others if others >= CONSTANT_SHARE * (len(voters) - votes_itself) else 0


def _named(node: Node, every: bool) -> bool:
    """Do its names mark it as no content: by all words of a name, or by any of them?"""
    for words in node.names:
        if words and words[0] not in MODIFIERS and (all if every else any)(w in NOT_CONTENT for w in words):
            return True
    return False


def left_out(node: Node, root: Node) -> bool:
    """Is the element no part of an article, whatever its text?

    Names don't count for what holds an article or main element or, on a page
    without one, most of the text; paragraphs go only by a name that says
    nothing else.
    """
    most = not root.region and 2 * node.length > root.length
    if node.tag in NEVER:
        return not (node.tag == "form" and (node.region or most))
    if node.tag in ("html", "body", "main", "article", "#root") or node.region or most:
        return False
    return _named(node, node.tag in PROSE or node.tag in LISTED)


def regions(root: Node) -> list[Node]:
    """The main element, else the outermost articles, else the whole tree; parts that are left out don't count."""
    found: dict[str, list[Node]] = {"main": [], "article": []}
    todo = [(root, False)]
    while todo:
        x, inside = todo.pop()
        if x is not root and left_out(x, root):
            continue
        kind = "main" if x.tag == "main" or any(n == ("main",) for n in x.names) and x.tag == "div" else x.tag
        named = x.tag == "article" and _named(x, False)
        if kind == "main" and x.length:
            found["main"].append(x)
        elif kind == "article" and x.length and not inside and not named:
            found["article"].append(x)
            inside = True
        todo.extend((c, inside) for c in reversed(x.children) if type(c) is not str and c.tag not in RAW)
    if found["main"]:
        return [max(found["main"], key=lambda x: x.length)]
    return found["article"] or [root]


def main_text(root: Node) -> str:
    """The content blocks of the main region, in page order, joined by line feeds."""
    blocks: list[str] = []
    buffer: list[str] = []
    state = {"link": 0, "all": 0, "prose": False}

    def flush(stated: bool) -> None:
        text = " ".join(unescape("".join(buffer)).split()) if buffer else ""
        # outside an article, a block that is nothing but links is a menu's, unless it is a paragraph
        if text and (stated or state["prose"] or not state["link"] or state["link"] < state["all"]):
            blocks.append(text)
        buffer.clear()
        state.update(link=0, all=0, prose=False)

    for region in regions(root):
        stated = region is not root
        # an explicit stack, as pages may nest deeper than Python calls may
        todo: list = [(region, False, region.tag == "article")]
        while todo:
            x, linked, article = todo.pop()
            if x is None:
                flush(stated)
            elif type(x) is str:
                buffer.append(x)
                size = len(x.strip(" \t\r\n\f|·•>/-"))
                state["all"] += size
                state["link"] += size * linked
            else:
                article = article or x.tag == "article"
                if x is not region and (left_out(x, root) or x.tag == "article" and _named(x, False) or x.tag == "header" and not article):
                    continue
                prose = x.prose or stated and (x.tag in LISTED or not region.prose)
                if x is not region and (x.apart >= PROSE_PAGES if prose else x.same >= CONSTANT_PAGES):
                    continue
                if x.tag == "br":
                    buffer.append(" ")
                    continue
                if x.tag in BLOCK:
                    flush(stated)
                    todo.append((None, False, article))
                    state["prose"] = x.tag in PROSE
                todo.extend((c, linked or x.tag == "a", article) for c in reversed(x.children))
        flush(stated)
    return "\n".join(blocks)


def extract_group(pages: list[str | None]) -> list[str]:
    """Main texts of the pages of one group; a null page has none. The order of the pages plays no part."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))  # trees may be deep; calls of Python by Python take no C stack
    trees, aligner = [parse(p or "") for p in pages], Aligner()
    for tree in trees:
        aligner.measure(tree)
    full = [t for t in trees if t.length]
    induce(full, aligner)
    return [main_text(t) if t.length else "" for t in trees]


def extract(pages: DataFrame, *, group_pages: int = GROUP_PAGES) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Null and empty pages give an empty text; whole pages are read, however
    long. Pages without a host are one host of their own. Equal rows each give
    a row, count once in a group, and are dealt to several groups if they are
    many. A page alone on its host has nothing to be aligned with and is judged
    by its elements. Other columns are ignored, an empty table gives no rows.
    """
    bound_batches(pages.sparkSession)
    pages = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    sizes = pages.groupBy("host").agg(F.ceil(F.count("*") / group_pages).alias("groups")).where("groups > 1")
    sizes = sizes.select(F.col("host").alias("of_host"), "groups")
    few = sizes.limit(100_001).count() <= 100_000
    dealt = pages.join(F.broadcast(sizes) if few else sizes, F.col("host") == F.col("of_host"), "left")
    slot = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("groups", F.lit(1)))
    dealt = dealt.select("page_id", "url", "html", "host", slot.alias("slot"))
    often = pages.groupBy(F.col("page_id").alias("of_page"), F.col("url").alias("of_url")).agg(F.count("*").alias("times")).where(F.col("times") > group_pages)
    often = materialize(often, "often")
    if often.isEmpty():
        dealt = dealt.withColumn("part", F.lit(0).cast("bigint"))
    else:
        rows = dealt.join(often, F.col("page_id").eqNullSafe(F.col("of_page")) & F.col("url").eqNullSafe(F.col("of_url")), "left")
        part = F.when(F.col("times").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.ceil(F.col("times") / group_pages))).otherwise(0)
        dealt = rows.select("page_id", "url", "html", "host", "slot", part.cast("bigint").alias("part"))
    kinds = dict(pages.dtypes)

    def run(table: pa.Table) -> pa.Table:
        with light_task():
            order = table.sort_by([("page_id", "ascending"), ("url", "ascending")])
            texts = extract_group(order.column("html").to_pylist())
        columns = [order.column("page_id"), order.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
        return pa.table(columns, names=["page_id", "url", "text", "n_chars"])

    return dealt.groupBy("host", "slot", "part").applyInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars bigint")
