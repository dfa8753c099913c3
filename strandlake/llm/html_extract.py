"""Main text of web pages by wrapper induction.

Pages of one host are taken in small groups. In a group, every page's DOM tree is aligned with a reference page by
simple tree matching (the largest order-keeping match of equal-labelled nodes, top down). Text that stays the same in
most pages of the group is the host's template; text in slots that vary is content. The main part of all pages is the
innermost aligned element that holds most of the varying text, with the article or main element around it; what varies
outside it (teasers, adverts, page numbers) is left out. Inside, what nearly all pages share goes, and what a page marks
as navigation, footer, advert, notice, form, comment or script by its element or a whole name in its class, unless a form,
a header or what is marked by name alone holds an article or main element or most of the varying text.

Where too few pages can be aligned, or a page has no part in the alignment, its article or main elements are its main
part, or else all that isn't marked.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import record, table, trimmed

#: Pages aligned with one reference, and the largest share of all pages that one (host, salt) may hold, as 1 / SHARES.
GROUP, SHARES = 32, 100_000
#: Groups of distinct pages that a salt of a large host has at least on average, and copies of a page that it makes up for.
DEALT, COPIES = 2, 16
#: Of a group's distinct pages, the share with equal text in a slot from which it is template, and the least number.
CONSTANT, LEAST = 0.5, 3
#: The same inside an article or main element, where only what nearly all pages share is not the author's.
CONSTANT_INSIDE, LEAST_INSIDE = 0.9, 8

#: The least share of the varying text of a group of LEAST_INSIDE pages or more that its main part holds.
MAIN = 0.8
#: Cells of a match from which rows are whole numpy rows, and above which a traceback is halved; neither changes a best match's size.
LONG, CELLS = 256, 1 << 21
#: Elements nested deeper than this become siblings, as in browsers.
DEPTH = 256

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_REST = re.compile(r"(?>[^>=]++|=\s*+(?>\"[^\"]*+\"|'[^']*+'|))*+>")  # attributes; a quote counts where a value begins
_MARKED = re.compile(r"(?<![\w\-])(class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

# Element names of HTML by their part in this.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "html body head address article aside blockquote caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("html body head caption tbody td tfoot th thead tr option legend".split())
_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}}
_AROUND = frozenset("nav header footer aside form menu button select input head dialog".split())
_WRAPS = frozenset("form header".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math".split())
_RAW_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I) for tag in _RAW}
_PARTS = frozenset("html body main article section div center table tbody tr td form header".split())
_WORD = (
    r"(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|"
    r"footer|header|masthead|cookie|cookies|consent|notice|notices|alert|popup|modal|newsletter|subscribe|subscription|signup|login|form|comment|comments|disqus|replies|"
    r"share|sharing|social|related|recommended|widget|toolbar|skip|copyright|legal|disclaimer|complementary|contentinfo)s?"
)
_WORDS = re.compile(rf"{_WORD}(?:[\s_\-]+{_WORD})*", re.I)
#: An element's mark: out whatever it holds, or out unless it holds the page's main part.
CERTAIN, NAMED = 1, 2


class Node:
    __slots__ = ("tag", "text", "kids", "out", "shape", "constant")

    def __init__(self, tag: str, text: str = "", out: int = 0):
        self.tag, self.text, self.out = tag, text, out
        self.kids: list[Node] = []
        self.shape = 0
        self.constant = 0


def _named(attributes: str) -> bool:
    """Whether a class, id, role or itemprop has a token made of listed words alone, or a label is made of them."""
    for name, value in _MARKED.findall(attributes):
        value = value.strip("\"' \t\r\n")
        if any(_WORDS.fullmatch(v) for v in ([value] if name.lower() == "aria-label" else value.split())):
            return True
    return False


def _tags(page: str):
    """(start, end, closing, tag, attributes) of each tag and comment of a page, in time linear in its length; tag is '' for comments and raw elements."""
    at, quotes = 0, True
    while (start := page.find("<", at)) >= 0:
        opened = _OPEN.match(page, start)
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            yield start, at, False, "", ""
        elif opened:
            rest = _REST.match(page, opened.end()) if quotes else None
            quotes = rest is not None  # once a tag has no end, quotes can't be trusted any more
            at = rest.end() if rest else page.find(">", opened.end()) + 1
            if not at:
                return
            tag, attributes = opened[2].lower(), page[opened.end() : at - 1]
            if tag in _RAW and not opened[1]:
                if not attributes.endswith("/"):
                    close = _RAW_ENDS[tag].search(page, at)
                    at = close.end() if close else len(page)
                tag = ""
            yield start, at, bool(opened[1]), tag, attributes
        elif page.startswith(("<!", "<?"), start):
            at = page.find(">", start) + 1
            if not at:
                return
            yield start, at, False, "", ""
        else:
            at = start + 1


def parse(page: str) -> Node:
    """The DOM tree, tolerant of unclosed and stray tags. Text nodes have tag ''; out marks boilerplate elements."""
    root = Node("#")
    stack = [root]
    opened: Counter = Counter()
    beyond: Counter = Counter()  # open elements that are too deep to hold anything
    at = 0

    def pop(k: int) -> None:
        opened.subtract(n.tag for n in stack[k:])
        del stack[k:]

    def above():
        return range(len(stack) - 1, max(0, len(stack) - DEPTH), -1)

    for start, end, closing, tag, rest in _tags(page):
        if start > at:
            stack[-1].kids.append(Node("", page[at:start]))
        at = end
        if not tag:
            continue
        if closing:
            if beyond[tag]:
                beyond[tag] -= 1
                if tag in _BLOCK:
                    stack[-1].kids.append(Node(tag))  # what follows is another block
            elif opened[tag] > 0:
                for k in above():
                    if stack[k].tag == tag:
                        pop(k)
                        break
                    if tag not in _BLOCK and stack[k].tag in _BLOCK:
                        break  # a stray end of an inline element closes no block
            continue
        if tag in _CLOSES_P and opened["p"] > 0:
            for k in above():
                if stack[k].tag == "p":
                    pop(k)
                    break
                if stack[k].tag in _BLOCK:
                    break
        if tag in _SIBLING:
            for k in above():
                if stack[k].tag in _SIBLING[tag]:
                    pop(k)
                    if tag not in ("tr", "tbody"):
                        break
                elif stack[k].tag in _HOLDS[tag]:
                    break
        node = Node(tag)
        if rest:
            if _HIDDEN.search(rest):
                node.out = CERTAIN
            elif tag not in ("html", "body", "article", "main") and _named(rest):
                node.out = NAMED
            if rest.endswith("/") and tag not in _BLOCK:
                stack[-1].kids.append(node)
                continue
        if tag in _AROUND:
            node.out = node.out or NAMED if tag in _WRAPS else CERTAIN
        stack[-1].kids.append(node)
        if tag in _VOID:
            continue
        if len(stack) <= DEPTH:
            stack.append(node)
            opened[tag] += 1
        else:
            beyond[tag] += 1
    if at < len(page):
        stack[-1].kids.append(Node("", page[at:]))
    return root


class Shapes:
    """Numbers for equal tree shapes (tags alone), and the sizes of the best matches between two of them."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.size: list[int] = []
        self.kids: list[tuple] = []
        self.tag: list[str] = []
        self.best: dict[tuple[int, int], int] = {}

    def name(self, node: Node) -> int:
        kids = tuple([self.name(k) for k in node.kids])
        key = (node.tag, kids)
        n = self.numbers.get(key)
        if n is None:
            n = self.numbers[key] = len(self.size)
            self.size.append(1 + sum(self.size[k] for k in kids))
            self.kids.append(kids)
            self.tag.append(node.tag)
        node.shape = n
        return n

    def match(self, a: int, b: int) -> int:
        """Nodes in the best match of two shapes whose roots are matched; 0 if their tags differ."""
        if a == b:
            return self.size[a]
        if self.tag[a] != self.tag[b]:
            return 0
        got = self.best.get((a, b))
        if got is None:
            got = self.best[a, b] = 1 + int(self._last(self.kids[a], self.kids[b])[-1])
        return got

    def _sweep(self, x, y) -> Iterator:
        """The best matches of each beginning of x with all beginnings of y, one row for each; long ones by whole rows in numpy."""
        if len(x) * len(y) < LONG:
            row = [0] * (len(y) + 1)
            yield row
            for a in x:
                last, row = row, [0]
                for j, b in enumerate(y):
                    row.append(max(last[j + 1], row[j], last[j] + self.match(a, b)))
                yield row
            return
        kinds, at = np.unique(np.array(y), return_inverse=True)
        worth = {a: np.array([self.match(a, b) for b in kinds.tolist()]) for a in set(x)}
        row = np.zeros(len(y) + 1, np.int64)
        yield row
        for a in x:
            last, row = row, np.zeros(len(y) + 1, np.int64)
            row[1:] = np.maximum.accumulate(np.maximum(last[1:], last[:-1] + worth[a][at]))
            yield row

    def _last(self, x, y) -> np.ndarray:
        for row in self._sweep(x, y):
            pass
        return np.asarray(row)

    def _pairs(self, x, y) -> list[tuple[int, int]]:
        """Places in x and y of a best match. Beyond ``CELLS`` x is halved where a best match crosses y, so that memory stays bounded."""
        if len(x) > 1 and len(x) * len(y) > CELLS:
            half = len(x) // 2
            cut = int(np.argmax(self._last(x[:half], y) + self._last(x[half:][::-1], y[::-1])[::-1]))
            return self._pairs(x[:half], y[:cut]) + [(i + half, j + cut) for i, j in self._pairs(x[half:], y[cut:])]
        rows, i, j, out = list(self._sweep(x, y)), len(x), len(y), []
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((i, j))
        return out[::-1]

    def aligned(self, x: list[Node], y: list[Node]) -> list[tuple[Node, Node]]:
        """Pairs of children in the best match. Equal shapes at either end are matched at once, which loses nothing."""
        head = 0
        while head < min(len(x), len(y)) and x[head].shape == y[head].shape:
            head += 1
        tail = 0
        while tail < min(len(x), len(y)) - head and x[-1 - tail].shape == y[-1 - tail].shape:
            tail += 1
        out = list(zip(x[:head], y[:head], strict=True))
        u, v = x[head : len(x) - tail], y[head : len(y) - tail]
        out += [(u[i], v[j]) for i, j in self._pairs([n.shape for n in u], [n.shape for n in v])]
        return out + list(zip(x[len(x) - tail :], y[len(y) - tail :], strict=True))


def induce(pages: list[Node]) -> list[list[Node]]:
    """Sets ``constant`` on the text nodes that belong to the group's template: 1, or 2 if nearly all pages share them.

    Returns the main part of each page, in page order; an empty list where alignment doesn't tell it.
    """
    if len(pages) < LEAST:
        return [[] for _ in pages]
    shapes = Shapes()
    for p in pages:
        shapes.name(p)
    reference = pages[0]
    slots: dict[int, list[Node]] = {}
    mates: dict[int, list[tuple[int, Node]]] = {}
    for number, p in enumerate(pages):
        todo = [(reference, p)]
        while todo:
            a, b = todo.pop()
            if a.tag == "":
                slots.setdefault(id(a), []).append(b)
                continue
            mates.setdefault(id(a), []).append((number, b))
            if a.kids and b.kids:
                todo += zip(a.kids, b.kids, strict=True) if a is b else shapes.aligned(a.kids, b.kids)
    need = max(LEAST, CONSTANT * len(pages))
    nearly_all = max(LEAST_INSIDE, CONSTANT_INSIDE * len(pages))
    for nodes in slots.values():
        if len(nodes) < need:
            continue
        texts = Counter(n.text.strip() for n in nodes)
        for text, n in texts.items():
            if n >= need and text:
                for node in nodes:
                    if node.text.strip() == text:
                        node.constant = 2 if n >= nearly_all else 1
    mass: dict[int, int] = {}
    for p in pages:
        _varying(p, mass)
    of = {a: sum(mass[id(b)] for _, b in found) for a, found in mates.items() if len(found) >= max(LEAST_INSIDE, need)}
    at, way = reference, []
    while id(reference) in of:
        inner = max((k for k in at.kids if k.tag in _PARTS and id(k) in of and k.out != CERTAIN), key=lambda k: of[id(k)], default=None)
        if inner is None or of[id(inner)] < MAIN * of[id(reference)] or not any(k.tag in _BLOCK for k in inner.kids):
            break
        way.append((at, inner))
        at = inner
    semantic = [n for _, n in way if n.tag == "article"] or [n for _, n in way if n.tag == "main"]
    chosen = semantic[-1:]
    if not chosen and at.tag not in ("#", "html", "body"):
        heads = [k for up, n in way for k in up.kids[: next(i for i, k in enumerate(up.kids) if k is n)] if k.tag in ("h1", "h2", "h3") and not k.out]
        chosen = [*heads, at]
    parts: list[list[Node]] = [[] for _ in pages]
    if chosen:
        held = {number for number, b in mates[id(chosen[-1])] if mass[id(b)]}
        for node in chosen:
            for number, b in mates.get(id(node), ()):
                if number in held:
                    parts[number].append(b)
    return parts


def _varying(page: Node, into: dict[int, int]) -> None:
    """Characters of varying text outside links, for each element of a page."""
    order: list[tuple[Node, int]] = [(page, -1)]
    for at, (node, _) in enumerate(order):  # grows on the way: parents before children
        order += [(k, at) for k in node.kids]
    size = [0] * len(order)
    for at in range(len(order) - 1, -1, -1):
        node, up = order[at]
        if node.tag == "" and not node.constant:
            size[at] = len(node.text.strip())
        into[id(node)] = size[at]
        if up >= 0 and node.tag != "a" and node.out != CERTAIN:
            size[up] += size[at]


def release(page: Node) -> None:
    """Unmarks NAMED elements that hold an article or main element, or over half of the varying text outside links."""
    order: list[tuple[Node, int]] = [(page, -1)]
    for at, (node, _) in enumerate(order):  # grows on the way: parents before children
        order += [(k, at) for k in node.kids if k.out != CERTAIN and k.tag != "a"]
    size, holds = [0] * len(order), [False] * len(order)
    for at in range(len(order) - 1, 0, -1):
        node, up = order[at]
        if node.tag == "" and not node.constant:
            size[at] = len(node.text.strip())
        size[up] += size[at]
        holds[up] |= holds[at] or node.tag in ("article", "main")
    for at, (node, _) in enumerate(order):
        if node.out and (holds[at] or 2 * size[at] > size[0]):
            node.out = 0


def _find(node: Node, tags: tuple, into: list) -> list:
    for k in node.kids:
        if k.out:
            continue
        if k.tag in tags:
            into.append(k)
        else:
            _find(k, tags, into)
    return into


def content(page: Node, main: list[Node] = ()) -> str:
    """Blocks of a page's main part that hold a varying slot, joined by newlines. A block goes only if all of it is template.

    The main part is ``main``, or else the article or main elements.
    """
    parts = main or _find(page, ("article",), []) or _find(page, ("main",), [])
    template = 2 if any(p.tag in ("article", "main") for p in parts) else 1
    blocks: list[str] = []
    run: list[str] = []
    varies = False

    def close() -> None:
        nonlocal varies
        if varies:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                blocks.append(text)
        run.clear()
        varies = False

    def walk(node: Node) -> None:
        nonlocal varies
        for k in node.kids:
            if k.tag == "":
                run.append(k.text)
                varies = varies or k.constant < template
            elif k.tag == "br":
                run.append(" ")
            elif k.out:
                if k.tag in _BLOCK:
                    close()
            elif k.tag in _BLOCK:
                close()
                walk(k)
                close()
            else:
                walk(k)

    for p in parts or [page]:
        walk(p)
        close()
    return "\n".join(blocks)


def group_texts(pages: list[str]) -> list[str]:
    """Main texts of pages of one host. Pages that are equal count once for the template."""
    trees: dict[str, Node] = {}
    for p in pages:
        if p not in trees:
            trees[p] = parse(p)
    main = induce(list(trees.values()))
    for t in trees.values():
        release(t)
    texts = {p: content(t, m) for (p, t), m in zip(trees.items(), main, strict=True)}
    return [texts[p] for p in pages]


def cut(pages: list[str], last: bool) -> list[int]:
    """Ends of the groups that can be cut from pages, equal ones side by side; if these are the last, the ends of all.

    A group has GROUP distinct pages; the last up to half as many more, or two share the rest. So if there are half of
    GROUP, no group has less.
    """
    starts = [i for i, p in enumerate(pages) if not i or p != pages[i - 1]]
    sizes, left = [], len(starts)
    while left > 2 * GROUP:
        sizes.append(GROUP)
        left -= GROUP
    if last and left:
        sizes += [left] if left <= GROUP + GROUP // 2 else [left - left // 2, left // 2]
    ends, at = [], 0
    for n in sizes:
        at += n
        ends.append(starts[at] if at < len(starts) else len(pages))
    return ends


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row; text is empty for null, empty or content-free pages.

    Repeated rows each give a row; pages with a null or odd URL form groups of their own; other columns are ignored;
    an empty table gives an empty result.
    """
    pages = df.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)).alias("host"),
    )
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("html")).alias("distinct"))
    total = pages.count()
    most = max(DEALT * GROUP, total // SHARES)
    salts = {r.host: max(1, min(r.distinct, r.n) // most, r.n // (most * COPIES)) for r in hosts.where(F.col("n") > most).collect()}  # at most SHARES hosts
    sent = df.sparkSession.sparkContext.broadcast(salts)

    def salt(batches):
        for batch in batches:
            ids, urls, hosts, mixed = (batch.column(k).to_pylist() for k in (0, 1, 3, 4))
            drawn = [zlib.crc32(f"{i} {u} {m}".encode("utf-8", "replace")) % n if (n := sent.value.get(h, 1)) > 1 else 0 for i, u, h, m in zip(ids, urls, hosts, mixed, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.int64())], names=["page_id", "url", "html", "host", "mixed", "salt"])

    ddl = "page_id long,url string,text string,n_chars long"

    def run(batches):
        held: list[tuple] = []
        distinct, key = 0, None

        def flush(last):
            begin = 0
            for end in cut([g[2] for g in held], last):
                group, begin = held[begin:end], end
                texts = group_texts([g[2] for g in group])
                yield record(ddl, [g[0] for g in group], [g[1] for g in group], texts, [len(t) for t in texts])
            del held[:begin]

        for batch in batches:
            for i, url, page, host, _, drawn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and key != (host, drawn):
                    yield from flush(True)
                    distinct = 0
                key = host, drawn
                if held and held[-1][2] == page:
                    page = held[-1][2]  # copies are held once
                else:
                    distinct += 1
                    if distinct > 3 * GROUP:
                        yield from flush(False)
                        distinct = 1 + sum(a[2] != b[2] for a, b in zip(held, held[1:])) + 1
                held.append((i, url, page))
        yield from flush(True)

    mixed = pages.withColumn("mixed", F.xxhash64("html"))  # copies are side by side, others in no order of their own
    dealt = mixed.mapInArrow(trimmed(salt), "page_id long,url string,html string,host string,mixed long,salt long").repartition("host", "salt")
    return dealt.sortWithinPartitions("host", "salt", "mixed", "html", "page_id").mapInArrow(trimmed(run), ddl)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
