"""HTML extraction: wrappers by union-free regular-expression inference.

A page is a token stream of tags and texts.  Nested elements make it a tree, and a *wrapper* is such
a tree with three marks: optional parts, repeated groups, and text slots.  It stands for a
union-free regular expression (:func:`expression` spells it).  Pages of one host are aligned with the
host's wrapper one after the other; a mismatch is resolved

* between two texts into a *text slot*;
* between equal neighbours (up to three elements long) into a *repeated group*, whose members are
  aligned with each other in turn;
* otherwise into an *optional* part, found by the longest common sequence of elements.

Aligning is a merge of two wrappers, so it needs no host in one place: tasks fold their own pages by
host, equal results meet in a distinct, and only the few different wrappers of a host come together,
in salted groups first.  Wrappers hold structure and text digests, never page text.

Extraction walks each page along its host's wrapper: texts in navigation, notices, forms and the
like are left out by element and class; texts that the wrapper found equal on all pages are template,
inside and outside of articles; and the remaining, own texts choose the main region: the articles, if
they hold at least half of the page's own text, otherwise the whole page.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
import sys
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffrank.llm.url_filter import host_of
from staffrank.llm.words import fresh
from staffrank.session import ensure_checkpoint_dir

MIN_TEMPLATE_PAGES = 3       # pages that must share a text before it counts as template
BROADCAST_BYTES = 32 << 20   # wrappers up to this size are broadcast; more are joined by host
HELD_HOSTS = 2000            # wrappers a task holds before it passes them on
MAX_PERIOD = 3
WHOLE_TABLE = 1 << 20        # cells of an alignment that are held at once; of longer lists every so many rows
SALTS = 32

_TOKEN = re.compile(r"""(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>])*)(?:>|\Z)""")
_CLASS = re.compile(r"""(?is)\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
LEFT_OUT = frozenset("head nav footer aside form menu button select option label dialog".split())
ARTICLE = frozenset(("article", "main"))
NEVER_BY_WORD = ARTICLE | {"html", "body"}
LAYOUT_WORDS = frozenset("no without has with".split())  # "no-sidebar", "has-sidebar" say how a page is laid out
LEFT_OUT_WORDS = frozenset("ad ads advert adverts advertisement banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header notice notices cookie cookies consent comment comments reply replies promo sponsor sponsored share social related newsletter subscribe popup modal login search form toolbar pagination".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


class Node:
    """``key``: element name with its classes, '#' for a text, '()' for a group.  ``text``: the text
    itself in a page; its digest, or None for a slot, in a wrapper."""

    __slots__ = ("key", "children", "text", "optional", "repeated")

    def __init__(self, key: str, children=None, text=None, optional: bool = False, repeated: bool = False):
        self.key, self.children, self.text, self.optional, self.repeated = key, children if children is not None else [], text, optional, repeated

    def pack(self) -> list:
        """Key, flags, text and number of children of each node, parents first."""
        out, ahead = [], [self]
        while ahead:
            node = ahead.pop()
            out += (node.key, int(node.optional) | 2 * node.repeated, node.text, len(node.children))
            ahead += reversed(node.children)
        return out

    @staticmethod
    def unpack(x: list) -> Node:
        _allow_depth()
        root = Node("")
        ahead = [root]
        for k in range(0, len(x), 4):
            parent, node = ahead.pop(), Node(x[k], None, x[k + 2], bool(x[k + 1] & 1), bool(x[k + 1] & 2))
            parent.children.append(node)
            ahead += [node] * x[k + 3]
        return root.children[0]


def _allow_depth() -> None:
    """Elements may be nested as deep as a page likes: plain function calls take no stack but the heap's."""
    sys.setrecursionlimit(1 << 30)


def parse(page: str | None) -> Node:
    """Tree of a page; unclosed elements end where HTML lets them, at the latest with their parent."""
    _allow_depth()
    root = Node("")
    open_nodes, names, page = [root], [""], page or ""
    n_open: Counter[str] = Counter()

    def add_text(text: str) -> None:
        text = entities.unescape(text)
        if not text:
            return
        here = open_nodes[-1].children
        if here and here[-1].key == "#":
            here[-1].text += text
        else:
            here.append(Node("#", text=text))

    def close_from(k: int) -> None:
        n_open.subtract(names[k:])
        del open_nodes[k:], names[k:]

    end = 0
    for m in _TOKEN.finditer(page):
        if m.start() > end:
            add_text(page[end: m.start()])
        end = m.end()
        if m[3] is None:
            continue
        name = m[3].lower()
        if m[2]:
            if n_open[name]:
                k = len(names) - 1
                while names[k] != name:
                    k -= 1
                close_from(k)
            continue
        if name in CLOSES_P and n_open["p"]:
            k = len(names) - 1
            while names[k] in INLINE:
                k -= 1
            if names[k] == "p":
                close_from(k)
        for sibling in _SIBLINGS.get(name, ()):
            k = len(names) - 1
            while k > 0 and (names[k] in INLINE or names[k] == "p"):
                k -= 1
            if k > 0 and names[k] == sibling:
                close_from(k)
        words = sorted({w for c in _CLASS.findall(m[4] or "") for w in re.split(r"[^a-z]+", "".join(c).lower()) if w}) if m[4] and "=" in m[4] else ()
        node = Node(".".join([name, *words]))
        open_nodes[-1].children.append(node)
        if name not in VOID and not (m[4] or "").endswith("/"):
            open_nodes.append(node)
            names.append(name)
            n_open[name] += 1
    if end < len(page):
        add_text(page[end:])
    return root


def wrapper_of(node: Node) -> Node:
    """The wrapper of a single page: texts become digests, equal neighbours repeated groups."""
    if node.key == "#":
        return Node("#", text=zlib.crc32(" ".join(node.text.split()).encode("utf-8", "surrogatepass")))
    return Node(node.key, fold([wrapper_of(c) for c in node.children if c.key != "#" or not c.text.isspace()]))


def _absorb(groups: list[Node], period: int, k: int) -> list[Node] | None:
    """Merge the ``period`` nodes at k with the equal-keyed ones that follow."""
    first, second = groups[k: k + period], groups[k + period: k + 2 * period]
    if len(second) < period or any(a.key != b.key for a, b in zip(first, second, strict=True)):
        return None
    merged = [merge(a, b) for a, b in zip(first, second, strict=True)]
    if period == 1:
        merged[0].repeated = True
        merged[0].optional = first[0].optional and second[0].optional
    return merged


def fold(nodes: list[Node]) -> list[Node]:
    """Resolve repeats among neighbours: equal single elements, then groups of two and three."""
    out: list[Node] = []
    for node in nodes:
        out.append(node)
        while len(out) > 1 and out[-1].key == out[-2].key and node.key not in ("#", "()"):
            out[-2:] = _absorb(out[-2:], 1, 0)
    for period in range(2, MAX_PERIOD + 1):
        k = 0
        while k + 2 * period <= len(out):
            keys = [n.key for n in out[k: k + period]]
            if "()" in keys or keys == ["#"] * period:
                k += 1
                continue
            group = None
            while (merged := _absorb(out, period, k)) is not None:
                out[k: k + 2 * period] = merged
                group = merged
            if group is not None:
                out[k: k + period] = [Node("()", group, repeated=True)]
            k += 1
    return out


def merge(a: Node, b: Node) -> Node:
    """Wrapper of everything that a or b stands for (equal keys)."""
    node = Node(a.key, None, a.text if a.text == b.text else None, a.optional or b.optional, a.repeated or b.repeated)
    node.children = a.children if not b.children and not a.children else align(a.children, b.children)
    return node


def _grouped(nodes: list[Node], others: list[Node]) -> list[Node]:
    """``nodes`` with runs that spell a group of ``others`` made into such a group."""
    out = list(nodes)
    for spelling in {tuple(c.key for c in o.children) for o in others if o.key == "()"}:
        n, k = len(spelling), 0
        while k + n <= len(out):
            if tuple(c.key for c in out[k: k + n]) == spelling:
                while (merged := _absorb(out, n, k)) is not None:
                    out[k: k + 2 * n] = merged
                out[k: k + n] = [Node("()", out[k: k + n], repeated=True)]
            k += 1
    return out


def align(xs: list[Node], ys: list[Node]) -> list[Node]:
    xs, ys = _grouped(xs, ys), _grouped(ys, xs)
    if len(xs) == len(ys) and all(x.key == y.key for x, y in zip(xs, ys, strict=True)):
        return [merge(x, y) for x, y in zip(xs, ys, strict=True)]
    n, m = len(xs), len(ys)
    best = _most_equal(xs, ys)
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and xs[i].key == ys[j].key:
            out.append(merge(xs[i], ys[j]))
            i, j = i + 1, j + 1
        else:
            if j == m or (i < n and best(i + 1)[j] >= best(i)[j + 1]):
                lone, i = xs[i], i + 1
            else:
                lone, j = ys[j], j + 1
            out.append(Node(lone.key, lone.children, lone.text, True, lone.repeated))
    return fold(out)


def _most_equal(xs: list[Node], ys: list[Node]) -> Callable[[int], list[int] | np.ndarray]:
    """Row i of a table: how many equal keys can be paired, in order, of xs[i:] and ys[j:] for each j.

    Rows are asked for in rising order.  A small table is kept whole; of a larger one every so many
    rows, from which the rows between are made again: the same values in little memory.
    """
    n, m = len(xs), len(ys)
    if n * m <= WHOLE_TABLE:
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(m - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if xs[i].key == ys[j].key else max(best[i + 1][j], best[i][j + 1])
        return best.__getitem__
    number: dict[str, int] = {}
    mine = [number.setdefault(x.key, len(number)) for x in xs]
    theirs = np.array([number.setdefault(y.key, len(number)) for y in ys])

    def before(row: np.ndarray, key: int) -> np.ndarray:
        found = row.copy()
        np.maximum(found[:-1], (row[1:] + 1) * (theirs == key), out=found[:-1])
        return np.maximum.accumulate(found[::-1])[::-1]

    stride = math.isqrt(n) + 1
    row = np.zeros(m + 1, dtype=np.int32)
    kept, near = {n: row}, {}
    for i in range(n - 1, -1, -1):
        row = before(row, mine[i])
        if i % stride == 0:
            kept[i] = row

    def ask(i: int) -> np.ndarray:
        if i not in near:
            low = i - i % stride
            high = min(low + stride, n)
            near.clear()
            near[high] = kept[high]
            for k in range(high - 1, low - 1, -1):
                near[k] = before(near[k + 1], mine[k])
        return near[i]

    return ask


def expression(node: Node) -> str:
    """The wrapper as a union-free regular expression."""
    if node.key == "#":
        inner = "#text" if node.text is None else f"#{node.text}"
    else:
        body = "".join([expression(c) for c in node.children])
        inner = body if node.key in ("", "()") else f"<{node.key}>{body}"
    mark = "*" if node.optional and node.repeated else "?" if node.optional else "+" if node.repeated else ""
    return f"({inner}){mark}" if mark else inner


def _left_out(key: str, in_article: bool) -> bool:
    name, *words = key.split(".")
    if name in LEFT_OUT or (name == "header" and not in_article):
        return True
    return name not in NEVER_BY_WORD and any(w in LEFT_OUT_WORDS for w in words) and LAYOUT_WORDS.isdisjoint(words)


def _is_article(key: str) -> bool:
    name, *words = key.split(".")
    return name in ARTICLE or "main" in words


def content(page: Node, wrapper: Node | None, pages: int) -> str:
    """Main text of a parsed page along its host's wrapper (None: by the page's own structure)."""
    blocks: list[list[tuple[str, bool, bool]]] = [[]]  # (text, template, in an article)

    def known(at: Node | None) -> dict[str, list[tuple[Node, bool]]]:
        found: dict[str, list[tuple[Node, bool]]] = {}
        for c in at.children if at is not None else ():
            for g in c.children if c.key == "()" else (c,):
                found.setdefault(g.key, []).append((g, c.optional or g.optional))
        return found

    def walk(node: Node, at: Node | None, always: bool, in_article: bool) -> None:
        slots = known(at)
        for c in node.children:
            spots = slots.get(c.key)
            if c.key == "#":
                # what stands on some pages only was not compared with all of them
                template = always and spots is not None and len(spots) == 1 and spots[0][0].text is not None and not spots[0][1]
                blocks[-1].append((c.text, template, in_article))
                continue
            if _left_out(c.key, in_article):
                blocks.append([])
                continue
            name = c.key.partition(".")[0]
            block = name not in INLINE
            if block:
                blocks.append([])
            elif name == "br":
                blocks[-1].append((" ", False, in_article))
            spot, optional = (spots.pop(0) if len(spots) > 1 else spots[0]) if spots else (None, True)
            walk(c, spot, always and not optional, in_article or _is_article(c.key))
            if block:
                blocks.append([])

    walk(page, wrapper, pages >= MIN_TEMPLATE_PAGES, False)
    own = [0, 0]
    marked = False
    for text, template, here in (t for b in blocks for t in b):
        size = sum(map(len, text.split()))
        own[here] += 0 if template else size
        marked = marked or (here and size > 0)
    only_article = marked and own[True] >= own[False]
    # an article that all pages of a host share has no own text: it is read whole
    whole = only_article and not own[True]
    kept = (" ".join("".join(t for t, template, here in b if (here or not only_article) and (whole or not template)).split()) for b in blocks)
    return "\n".join(t for t in kept if t)


def _dump(node: Node) -> str:
    return json.dumps(node.pack(), separators=(",", ":"))


def _fold_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, html) -> (host, wrapper, pages), one row per host that a task has met."""
    held: dict[str, list] = {}

    def rows() -> pd.DataFrame:
        out = pd.DataFrame([(h, _dump(w), n) for h, (w, n) in held.items()], columns=["host", "wrapper", "pages"])
        held.clear()
        return out

    for batch in batches:
        for host, page in zip(batch["host"], batch["html"], strict=True):
            one = wrapper_of(parse(page))
            if host in held:
                held[host] = [merge(held[host][0], one), held[host][1] + 1]
            else:
                held[host] = [one, 1]
        if len(held) > HELD_HOSTS:
            yield rows()
    if held:
        yield rows()


def _merge_wrappers(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("wrapper")
    found = None
    for w in pdf["wrapper"]:
        one = Node.unpack(json.loads(w))
        found = one if found is None else merge(found, one)
    return pd.DataFrame([(pdf["host"].iloc[0], _dump(found), int(pdf["pages"].sum()))], columns=["host", "wrapper", "pages"])


def infer_wrappers(pages: DataFrame, host: Column) -> DataFrame:
    """(host, wrapper, pages): one wrapper per host, over all of its pages (html)."""
    schema = "host string, wrapper string, pages long"
    parts = pages.select(host.alias("host"), F.col("html").cast("string").alias("html")).mapInPandas(_fold_pages, schema)
    for salt in (F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)), F.lit(0)):
        parts = parts.groupBy("host", "wrapper").agg(F.sum("pages").alias("pages")).groupBy("host", salt.alias("salt")).applyInPandas(_merge_wrappers, schema)
    return parts


def _extractor():
    @F.pandas_udf("string")
    def extract(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        last: dict[str, Node] = {}
        for html, wrappers, counts in batches:
            out = []
            for page, packed, n in zip(html, wrappers, counts, strict=True):
                if packed is not None and packed not in last:
                    if len(last) >= HELD_HOSTS:
                        last.clear()
                    last[packed] = Node.unpack(json.loads(packed))
                out.append(content(parse(page), last.get(packed), 0 if n is None or n != n else int(n)))
            yield pd.Series(out, dtype=object)

    return extract


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html, any other columns) with ``text``: the article's blocks, one a line.

    A column ``text`` in ``pages`` is replaced.  Defined cases: a null or empty html has an empty
    text; a null url, or one without a host, belongs to the host ''; pages cut off in a tag, comment
    or element end there; elements may be nested to any depth; character references are decoded as browsers do, also without a semicolon;
    equal rows get equal texts; a host with one page is read by that page's own structure; an empty
    table gives an empty table.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    pages = pages.drop("text")
    host = host_of(F.col("url").cast("string"))
    of_host, wrapper, count = (fresh(n, pages.columns) for n in ("_host", "_wrapper", "_pages"))
    wrappers = infer_wrappers(pages, host).toDF(of_host, wrapper, count).checkpoint()
    size = wrappers.agg(F.sum(F.length(wrapper) + F.length(of_host) + 32)).first()[0] or 0
    side = F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers
    joined = pages.join(side, host == F.col(of_host), "left")
    return joined.withColumn("text", F.coalesce(_extractor()(F.col("html").cast("string"), wrapper, count), F.lit(""))).drop(of_host, wrapper, count)
