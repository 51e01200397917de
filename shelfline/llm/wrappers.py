"""Main text of web pages by wrapper induction: pages of a host are aligned, and what most of them share is template."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import join_groups, schema_with
from shelfline.session import materialize

# Pages with differing content that a text must be the same on to count as template.
MIN_PAGES = 5
# The share of the host's pages with its place that a template text stands on.
SHARE = 0.5
_ROWS = 256
_SALTS = 256

# HTML elements by what they do to a text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
RAW = set("script style title textarea noscript template iframe noembed noframes xmp svg math object canvas audio video".split())
DROPPED = RAW | set("head nav header footer aside form menu dialog select button input datalist fieldset".split())
MAIN = {"article", "main"}
# Start tags that end an open element of the same group.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = set("ul ol dl table article main section div body html".split())
# Elements that stand in a row as items, whatever they hold.
ITEMS = set("p li dt dd tr td th option h1 h2 h3 h4 h5 h6 pre blockquote hr".split())
# Whole classes, ids and roles that mark what is around an article.
AROUND = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert sidebar nav navigation navbar menu breadcrumb breadcrumbs footer header masthead comment comments "
    "respond replies disqus related recommended share sharing social newsletter subscribe signup login popup modal overlay "
    "widget pagination pager toolbar complementary contentinfo search".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*>|<[!?][^>]*>",
    re.S,
)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PLAIN = re.compile(r"[^a-z0-9:-]")
_ENDS = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


class Shape:
    """An element without its texts: label and children, each run of repeated siblings as one.

    Pages may be nested to any depth, so shapes are built from the leaves up, and
    compared by a 128-bit digest in place of a walk.
    """

    __slots__ = ("label", "children", "count", "digest")

    def __init__(self, label: str, children: tuple[Shape, ...] = ()):
        self.label, self.children = label, children
        self.count = 1 + sum([child.count for child in children])
        self.digest = xxhash.xxh3_128_digest(b"".join([label.encode(), b"(", *[child.digest for child in children]]))

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Shape) and self.digest == other.digest

    def __hash__(self) -> int:
        return hash(self.digest)


@dataclass
class Node:
    """An element of the page, with its pieces of text and its child elements in order.

    ``around`` is said by its element name, ``marked`` by its class, id or role;
    ``heading`` is set on a header that holds a heading.
    """

    label: str
    around: bool
    main: bool
    marked: bool = False
    heading: bool = False
    items: list = field(default_factory=list)
    runs: list = field(default_factory=list)
    shape: Shape | None = None


def _names(attrs: str) -> tuple[list[str], set[str], bool]:
    """The words in class, id and role, their whole tokens, and whether the role is main."""
    lowered = attrs.lower()
    words, tokens, main = [], set(), False
    if "class" in lowered or "id" in lowered or "role" in lowered:
        for found in _ATTR.finditer(attrs):
            name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if value and name in ("class", "id", "role"):
                words += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
                tokens.update(value.lower().split())
                main |= name == "role" and "main" in value.lower().split()
    return words, tokens, main


def _unmark_around_article(root: Node) -> None:
    """What holds the article isn't around it, whatever its class, id or role says.

    The article is the main or article element with the most text that no
    element name puts aside, and within it the one that holds more than half of that, if any.
    """
    order: list[tuple[Node, int, bool]] = [(root, -1, False)]
    for at, (node, _, aside) in enumerate(order):  # grows while it is read: parents come first
        order += [(item, at, aside or item.around) for item in node.items if isinstance(item, Node)]
    sizes = [sum(len(item) for item in node.items if isinstance(item, str)) for node, _, _ in order]
    for at in range(len(order) - 1, 0, -1):
        sizes[order[at][1]] += sizes[at]
    nearest, inner, mains = [-1] * len(order), {}, []
    for at, (node, parent, aside) in enumerate(order):
        outer = nearest[at] = nearest[parent] if at else -1
        if node.main and not aside:
            if outer >= 0 and 2 * sizes[at] > sizes[outer]:
                inner[outer] = at
            nearest[at] = at
            mains.append(at)
    article = max(mains, key=lambda at: (sizes[at], -at), default=-1)
    while article in inner:
        article = inner[article]
    while article >= 0:
        order[article][0].marked = False
        article = order[article][1]


def parse(html: str) -> Node:
    """The page as a tree of block elements.

    Inline elements belong to the text around them, and a line break in it is white
    space.  Missing end tags are supplied; stray ones are ignored.
    """
    root = Node("html", False, False)
    stack = [("html", root)]
    # where the elements of each name, the scopes and the marked elements stand in the stack, below the root
    opened: dict[str, list[int]] = {}
    scopes, marks = [], []
    # headers that hold the body, which the stack has lost
    beyond: list[Node] = []

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag, node = stack.pop()
            opened[tag].pop()
            if tag in SCOPES:
                scopes.pop()
            if node.marked:
                marks.pop()

    at, held = 0, False
    while True:
        found = _TOKEN.search(html, at)
        upto = found.start() if found else len(html)
        if upto > at:
            stack[-1][1].items.append(html[at:upto])
        if not found:
            if held:
                _unmark_around_article(root)
            return root
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        top = stack[-1][1].items
        if tag in INLINE:
            if tag in ("br", "img"):
                top.append(" ")
            continue
        if found["end"]:
            if opened.get(tag):
                close(opened[tag][-1])
            continue
        if tag in RAW:
            end = _ENDS[tag].search(html, at)
            if end or tag in ("script", "style", "title", "textarea"):
                # a raw element ends what a block holds only where it stands between blocks
                at = end.end() if end else len(html)
                top.append(" ")
                continue
        scope = scopes[-1] if scopes else 0
        for name in (*CLOSES.get(tag, ()), "p"):
            places = opened.get(name)
            if places and places[-1] > scope:
                close(places[bisect_right(places, scope)])
        attrs = found["attrs"] or ""
        words, tokens, main = _names(attrs)
        main |= tag in MAIN
        marked = not main and tag not in ("html", "body") and not tokens.isdisjoint(AROUND)
        node = Node(".".join([_PLAIN.sub("", tag), *sorted(set(words))]), tag in DROPPED, main, marked)
        held = held or main and bool(marks)
        stack[-1][1].items.append(node)
        if tag in _HEADINGS:
            for depth in reversed(opened.get("header", ())):
                if stack[depth][1].heading:
                    break
                stack[depth][1].heading = True
            if len(stack) > 1 and stack[1][0] == "body":
                for header in beyond:
                    header.heading = True
                beyond.clear()
        if tag == "body":
            held = held or bool(marks)
            beyond += [stack[depth][1] for depth in opened.get("header", ())]
            close(1)
        if tag == "body" or tag not in VOID and not attrs.endswith("/"):
            opened.setdefault(tag, []).append(len(stack))
            if tag in SCOPES:
                scopes.append(len(stack))
            if marked:
                marks.append(len(stack))
            stack.append((tag, node))


# Scores of pairs of subtrees are kept from this size on: of small ones there are many, and they are soon found again.
_KEPT = 32


def _run(steps: Generator):
    """The result of a recursive function written as a generator that yields its calls, at any depth."""
    stack, value = [steps], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def _known(left: Shape, right: Shape, scores: dict) -> int | None:
    """The score of a pair, where it needs no search."""
    if left.label != right.label:
        return 0
    if not left.children or not right.children:
        return 1
    if left == right:
        return left.count
    return scores.get((left.digest, right.digest))


def _scoring(left: Shape, right: Shape, scores: dict) -> Generator:
    score, _ = yield _pairing(left, right, scores, False)
    return score


def _pairing(left: Shape, right: Shape, scores: dict, pairs_too: bool = True) -> Generator:
    if left.label != right.label:
        return 0, []
    a, b = left.children, right.children
    if left == right:
        return left.count, [(i, i) for i in range(len(a))]
    if [x.label for x in a] == [y.label for y in b]:
        # alike in a row: the diagonal is the best there is
        total = 1
        for x, y in zip(a, b):
            both = _known(x, y, scores)
            total += (yield _scoring(x, y, scores)) if both is None else both
        pairs = [(i, i) for i in range(len(a))]
    else:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                both = 0
                if x.label == y.label:
                    both = _known(x, y, scores)
                    both = best[i - 1][j - 1] + ((yield _scoring(x, y, scores)) if both is None else both)
                best[i][j] = max(best[i - 1][j], best[i][j - 1], both)
        total, pairs, i, j = 1 + best[-1][-1], [], len(a), len(b)
        while pairs_too and i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, j))
        pairs.reverse()
    if min(left.count, right.count) >= _KEPT:
        scores[left.digest, right.digest] = total
    return total, pairs


def matching(left: Shape, right: Shape, scores: dict | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: most pairs of equal elements in order, and which children pair."""
    return _run(_pairing(left, right, {} if scores is None else scores))


def _merging(left: Shape, right: Shape, scores: dict) -> Generator:
    if left == right:
        return left
    _, pairs = yield _pairing(left, right, scores)
    a, b = left.children, right.children
    children, i, j = [], 0, 0
    for p, q in [*pairs, (len(a), len(b))]:
        children += [*a[i:p], *b[j:q]]
        if p < len(a):
            children.append(a[p] if a[p] == b[q] else (yield _merging(a[p], b[q], scores)))
        i, j = p + 1, q + 1
    out: list[Shape] = []
    for child in children:
        if out and _repeats(out[-1], child):
            if out[-1] != child:
                out[-1] = yield _merging(out[-1], child, scores)
        else:
            out.append(child)
    return Shape(left.label, tuple(out))


def merged(left: Shape, right: Shape, scores: dict | None = None) -> Shape:
    """Both shapes as one: matched children become one, others stand in order."""
    return _run(_merging(left, right, {} if scores is None else scores))


def _repeats(left: Shape, right: Shape) -> bool:
    """Whether neighbours are one repeated element: alike, or items of one list or running text."""
    return left == right or left.label == right.label and left.label.split(".")[0] in ITEMS


def shape_of(root: Node) -> Shape:
    """The shape of the page; the runs of repeated child elements stay with each element."""
    order, scores = [root], {}
    for node in order:  # grows while it is read: parents come first
        order += [item for item in node.items if isinstance(item, Node)]
    for node in reversed(order):
        runs: list[tuple[Shape, list[Node]]] = []
        for item in node.items:
            if isinstance(item, Node):
                if runs and _repeats(runs[-1][0], item.shape):
                    runs[-1][1].append(item)
                    if runs[-1][0] != item.shape:
                        runs[-1] = (merged(runs[-1][0], item.shape, scores), runs[-1][1])
                else:
                    runs.append((item.shape, [item]))
        node.runs, node.shape = runs, Shape(node.label, tuple([shape for shape, _ in runs]))
    return root.shape


def place(root: Node, whole: Shape, first: int, places: dict[int, int]) -> None:
    """Numbers each element by the preorder place in ``whole``, the shape of the page, that it falls into."""
    todo, scores = [(root, whole, first)], {}
    while todo:
        node, shape, number = todo.pop()
        places[id(node)] = number
        pairs = {j: i for i, j in matching(node.shape, shape, scores)[1]}
        number += 1
        for j, child in enumerate(shape.children):
            if j in pairs:
                todo += [(element, child, number) for element in node.runs[pairs[j]][1]]
            number += child.count


def written(shape: Shape) -> str:
    parts, todo = [], [shape]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
            continue
        parts.append(item.label)
        if item.children:
            todo.append(")")
            for child in reversed(item.children):
                todo += [child, ","]
            todo[-1] = "("
    return "".join(parts)


@lru_cache(maxsize=4096)
def read(text: str) -> Shape:
    label = ""
    nodes: list[tuple[str, list]] = [("", [])]
    for token in re.findall(r"[^(),]+|[(),]", text):
        if token == "(":
            nodes.append((label, []))
            label = ""
        elif token in ",)":
            if label:
                nodes[-1][1].append(Shape(label))
                label = ""
            if token == ")":
                name, children = nodes.pop()
                nodes[-1][1].append(Shape(name, tuple(children)))
        else:
            label = token
    if label:
        nodes[-1][1].append(Shape(label))
    return nodes[0][1][0]


def numbered(whole: Shape, wrapper: Shape, places: dict[int, int]) -> None:
    """Maps the preorder numbers of ``whole`` to those of the wrapper's elements that they match."""
    todo, scores = [(whole, wrapper, 0, 0)], {}
    while todo:
        shape, other, at, to = todo.pop()
        pairs = dict(matching(shape, other, scores)[1])
        places[at] = to
        starts, to = [], to + 1
        for child in other.children:
            starts.append(to)
            to += child.count
        at += 1
        for i, child in enumerate(shape.children):
            if i in pairs:
                todo.append((child, other.children[pairs[i]], at, starts[pairs[i]]))
            at += child.count


@lru_cache(maxsize=4096)
def _places(shape: str, wrapper: str) -> dict:
    places: dict = {}
    numbered(read(shape), read(wrapper), places)
    return places


def _tidy(parts: list[str]) -> str:
    return " ".join(unescape("".join(parts)).split())


def blocks(root: Node) -> Iterator[tuple[Node, str, bool, bool]]:
    """(element, text, around, in main) of each run of text between block boundaries, in page order."""
    def entered(node: Node, around: bool, main: bool) -> tuple:
        around |= (node.around or node.marked) and not (main and node.heading)
        return node, iter(node.items), around, main or node.main and not around

    stack = [entered(root, False, False)]
    run: list[str] = []
    while stack:
        node, items, around, main = stack[-1]
        child = None
        for item in items:
            if not isinstance(item, str):
                child = item
                break
            run.append(item)
        if run and (text := _tidy(run)):
            yield node, text, around, main
        run = []
        if child is None:
            stack.pop()
        else:
            stack.append(entered(child, around, main))


def _in_main(found: list[tuple[Node, str, bool, bool]]) -> list[tuple[Node, str, bool, bool]]:
    """The blocks in the page's article or main element, or all where it has none."""
    if any(main and not around for _, _, around, main in found):
        return [b for b in found if b[3]]
    return found


def _text_hash(text: str) -> int:
    return _signed(xxhash.xxh3_64_intdigest(text.encode()))


def main_text(html: str, wrapper: str | None, template: set[tuple[int, int]]) -> str:
    """The blocks of a page that are content: not around the article, and not a template text of their place on the host.

    A page with an article or main element is read there, any other in its body.
    ``template`` has (place in the wrapper, text hash).
    """
    root = parse(html)
    found = _in_main(list(blocks(root)))
    if template and wrapper:
        shape, own = shape_of(root), {}
        place(root, shape, 0, own)
        places = _places(written(shape), wrapper)
        found = [b for b in found if (places.get(own[id(b[0])]), _text_hash(b[1])) not in template]
    return "\n".join(text for _, text, around, _ in found if not around)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _outlines(pages: DataFrame) -> DataFrame:
    """host, shape, the places of the page with their text hashes, and a hash of the whole content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                shapes, places, texts, wholes = [], [], [], []
                for html in part.column(1):
                    root = parse(html.as_py())
                    shape, own = shape_of(root), {}
                    place(root, shape, 0, own)
                    found = list(blocks(root))
                    held = sorted({(own[id(element)], _text_hash(text)) for element, text, _, _ in found})
                    whole = "\n".join(text for _, text, around, _ in _in_main(found) if not around)
                    shapes.append(written(shape))
                    places.append([number for number, _ in held])
                    texts.append([text for _, text in held])
                    wholes.append(_text_hash(whole))
                yield pa.record_batch(
                    [part.column(0), pa.array(shapes), pa.array(places, pa.list_(pa.int32())),
                     pa.array(texts, pa.list_(pa.int64())), pa.array(wholes, pa.int64())],
                    ["host", "shape", "places", "texts", "whole"])

    return pages.select("host", "html").mapInArrow(
        run, "host string, shape string, places array<int>, texts array<long>, whole long")


def _folded_by_host(shapes: DataFrame, *salt: str) -> DataFrame:
    """(host, shape): the shapes of each host, or host and salt, as one.

    Rows reach a task in order and are folded as they come, so it holds one
    folded shape and one batch, however many shapes a host has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole = None, None
        for batch in batches:
            hosts, done = [], []
            for *row, text in zip(*(c.to_pylist() for c in batch.columns)):
                if row != key:
                    if key is not None:
                        hosts.append(key[0])
                        done.append(written(whole))
                    key, whole = row, read(text)
                else:
                    whole = merged(whole, read(text))
            yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(done, pa.string())], ["host", "shape"])
        if key is not None:
            yield pa.record_batch([pa.array([key[0]]), pa.array([written(whole)])], ["host", "shape"])

    keys = ["host", *salt]
    ordered = shapes.select(*keys, "shape").repartition(*keys).sortWithinPartitions(*keys, "shape")
    return ordered.mapInArrow(run, "host string, shape string")


def _aligned(outlines: DataFrame) -> DataFrame:
    """(host, number, text) once per page for each text in a place of its host's wrapper, and with a null text for each place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                hosts, numbers, texts = [], [], []
                for host, shape, wrapper, own, held in zip(*(c.to_pylist() for c in batch.slice(at, _ROWS).columns)):
                    places = _places(shape, wrapper)
                    found = {(places[p], text) for p, text in zip(own, held) if p in places}
                    found |= {(number, None) for number, _ in found}
                    hosts += [host] * len(found)
                    numbers += [number for number, _ in found]
                    texts += [text for _, text in found]
                yield pa.record_batch(
                    [pa.array(hosts, pa.string()), pa.array(numbers, pa.int32()), pa.array(texts, pa.int64())],
                    ["host", "number", "text"])

    return outlines.select("host", "shape", "wrapper", "places", "texts").mapInArrow(run, "host string, number int, text long")


def induce(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """One row per host: host, pages (how many it has), wrapper, template ((number of a place, text hash) each, or null).

    Distinct shapes of a host are aligned by simple tree matching, first in
    ``_SALTS`` groups that are folded row by row, then the groups' wrappers.  Each place
    of the wrapper counts its pages, and the pages of each of its texts; list items and
    paragraphs that share a place are counted one by one.  A text is template in its place when at least
    ``min_pages`` pages with differing content hold it there, and these are at least
    ``share`` of the pages with that place; pages of equal content count once.  A host with a third of all pages is
    many rows only while its shapes differ, and those are spread over the groups; texts come as hashes.
    """
    outlines = materialize(_outlines(pages))
    shapes = outlines.select("host", "shape").distinct()
    salted = shapes.withColumn("salt", F.pmod(F.xxhash64("shape"), F.lit(_SALTS)))
    wrappers = _folded_by_host(_folded_by_host(salted, "salt")).withColumnRenamed("shape", "wrapper")
    wrappers = materialize(wrappers.join(outlines.groupBy("host").agg(F.count("*").alias("pages")), "host"))
    once = outlines.groupBy("host", "whole").agg(F.min(F.struct("shape", "places", "texts")).alias("page")).select("host", "page.*")
    counts = _aligned(join_groups(once, wrappers, ["host"], "pages")).groupBy("host", "number", "text").agg(F.count("*").alias("n"))
    # what too few pages hold is no template, and neither is any text of a place that too few pages have
    counts = materialize(counts.filter(F.col("n") >= min_pages))
    held = counts.filter("text IS NULL").select("host", "number", F.col("n").alias("held"))
    constant = counts.filter("text IS NOT NULL").join(held, ["host", "number"]).filter(F.col("n") >= F.col("held") * share)
    template = constant.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("number", "text"))).alias("template"))
    return materialize(wrappers.join(template, "host", "left"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text: the main text of every page.

    The host comes from the url; wrappers are induced over all its pages, and a page's
    blocks are kept unless they are around the article (by element, class, id or
    role) or a text that most pages of the host have in the same place of its wrapper.  White space within a block is
    one space, blocks are joined by line feeds, character references are decoded.

    Null html is the empty page with an empty text.  Pages without a host share one
    wrapper.  Rows that repeat are extracted each, and identical pages alone make
    nothing template; no rows give no rows.
    """
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    rows = pages.select("page_id", "url", F.lower(host).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    found = induce(rows, min_pages)
    joined = join_groups(rows, found, ["host"], "pages").select("page_id", "url", "html", "wrapper", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                texts = [
                    main_text(html.as_py(), wrapper.as_py(), {(t["number"], t["text"]) for t in template.as_py() or ()})
                    for html, wrapper, template in zip(part.column(2), part.column(3), part.column(4))
                ]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return joined.mapInArrow(run, schema_with(pages.select("page_id", "url"), text="string"))
