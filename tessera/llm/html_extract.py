"""HTML extraction by equivalence-class template deduction over the pages of each host.

A page is a sequence of tokens: elements, told apart by their place (the elements around them, and which one of their
kind each is in there), and text blocks, told apart by element and text. The template of a host comes in three steps.

1. Tokens are counted over the distinct pages of the host; those on at least ``SUPPORT`` of them are candidates.
2. Every page tells, of each candidate on it, its part of the token's occurrence vector (a sum of hashes of page and
   number, so that Spark can add vectors up in parallel) and the gap it stands in: the nearest candidate before it in the
   same element that has as much support.
3. Candidates with equal vectors form an equivalence class. A class counts if it has ``LEAST_SIZE`` tokens (an element
   has two, its beginning and its end), and a token stays in it only if it is in the same gap on every page, so that the
   order of a class never changes and classes nest, each in one gap of those around it.

Valid classes are the template, and what lies between its tokens are slots. Slots inside navigation, forms, notices,
adverts and the like don't count. The article is the deepest template element that holds at least ``MASS`` of all slots'
text, without the template's text before its first and after its last part that has a slot, and with the headline before
it if it has none; template text between slots is kept. Tags decide where the template can't: on pages of hosts without a
template or without that element, and where it holds no slot or none of the page's ``article`` and ``main`` elements, the
article is what is in those elements or, without any, all that isn't set aside.

A host's template has at most ``1 / SUPPORT`` tokens for each token of an average page. Templates are broadcast only if
they have at most ``BROADCAST_TOKENS`` tokens in all; else they are joined to the pages by host.

Edge cases: null html is empty, and empty html gives empty text; null urls share a host; repeated rows and copies of a
page count once in a template; hosts of fewer than ``LEAST_PAGES`` distinct pages have no template; a tag that never
ends is text; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import cut, prepare

SUPPORT = 0.8
LEAST_PAGES = 5
LEAST_SIZE = 2
MASS = 0.6
BROADCAST_TOKENS = 200_000
#: Tokens gathered in a partition before they are handed on.
FLUSH = 100_000

#: A tag to its end; quoted values may hold ">". Nothing is given back, so that a tag is read once.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
CLASS = re.compile(r"""\bclass\s*=\s*["']?([^"'>]*)""")

#: Fixed values of HTML: elements without content, with content that isn't text of the page, and that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPAQUE = frozenset("script style noscript template textarea title select option svg math canvas iframe object audio video map head".split())
RAW = {name: re.compile(rf"</{name}\s*+>", re.I) for name in "script style textarea title noscript iframe".split()}
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul caption".split()
)
#: Elements of a page that aren't its article, and words of class, id and role that say the same.
ASIDE = frozenset("nav footer aside form menu dialog button search fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner promo promotion sponsor sponsored sidebar menu nav navbar navigation navigationbar breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist disqus respond reply replies widget complementary contentinfo search skip hidden".split()
)
TRACKED = BLOCK | OPAQUE | ASIDE
CLOSES = {"li": {"p", "li"}, "dd": {"p", "dd", "dt"}, "dt": {"p", "dd", "dt"}, "tr": {"p", "tr"}}
SPLIT_WORDS = re.compile(r"[^a-z0-9]+")


def is_aside(name: str, attributes: str, inside_article: bool) -> bool:
    if name in ASIDE or (name == "header" and not inside_article):
        return True
    if not attributes:
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id", "role"):
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
            words = SPLIT_WORDS.split(spaced.lower())
            if name not in ("html", "body", "main", "article") or (name == "article" and ("comment" in words or "comments" in words)):
                if not ASIDE_WORDS.isdisjoint(words):
                    return True
        elif key == "hidden" and name != "body":
            return True
        elif key == "aria-hidden" and "true" in value.lower():
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return True
    return False


def _key(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - 2**63


class Page:
    """A page's elements (ids, parents; the first is the page itself) and blocks (element, text, in an article, aside)."""

    def __init__(self, source: str | None, root: int = 0):
        self.ids, self.parents, self.depths, self.names = [root], [-1], [0], [""]
        self.blocks: list[tuple[int, str, bool, bool]] = []
        #: Elements (0 and up) and blocks (-1 and down), in page order.
        self.order: list[int] = []
        self._read(source or "")

    def _read(self, page: str) -> None:
        # name, element, whether inside an article or main, aside, opaque, and its children by label
        stack: list[tuple[str, int, bool, bool, bool, Counter]] = [("", 0, False, False, False, Counter())]
        depth: Counter = Counter()
        parts: list[str] = []

        def flush() -> None:
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    _, at, inside, aside, _, _ = stack[-1]
                    self.blocks.append((at, text, inside, aside))
                    self.order.append(-len(self.blocks))
                parts.clear()

        at, end, last = 0, len(page), page.rfind(">")
        quotes = True
        while at < end:
            begin = page.find("<", at)
            begin = end if begin < 0 or begin > last else begin
            if begin > at:
                if not stack[-1][4]:
                    parts.append(page[at:begin])
                at = begin
                if at == end:
                    break
            following = page[at + 1 : at + 2]
            if following in ("!", "?"):
                if page.startswith("<!--", at):
                    at = page.find("-->", at + 4) + 3
                elif page.startswith("<![CDATA[", at):
                    at = page.find("]]>", at) + 3
                else:
                    at = page.find(">", at) + 1
                # what is opened and never closed takes the rest along
                at = at if at > begin else end
                continue
            tag = TAG.match(page, at) if quotes else None
            if tag is None:
                if not following.isalpha() and following != "/":
                    if not stack[-1][4]:
                        parts.append("<")
                    at += 1
                    continue
                # from the first quote that never ends on, quotes are taken for plain characters
                close = page.find(">", at)
                quotes = quotes and not re.match(r"</?[a-zA-Z]", page[at : at + 3])
                found = re.match(r"<(/?)([a-zA-Z][^\s/>]*)(.*)>", page[at : close + 1], re.S)
                if found is None:
                    if following != "/" and not stack[-1][4]:
                        parts.append("<")
                    at = at + 1 if following != "/" else close + 1
                    continue
                tag, at = found, close + 1
            else:
                at = tag.end()
            name, attributes = tag.group(2).lower(), tag.group(3)
            if tag.group(1):
                if name in ("td", "th"):
                    parts.append(" ")
                if depth[name]:
                    flush()
                    while True:
                        gone = stack.pop()[0]
                        depth[gone] -= 1
                        if gone == name:
                            break
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                elif name == "br":
                    parts.append(" ")
                continue
            if name in BLOCK:
                flush()
                closes = CLOSES.get(name, ("p",))
                while stack[-1][0] in closes:
                    depth[stack.pop()[0]] -= 1
            elif name in ("td", "th"):
                parts.append(" ")
            if name in TRACKED and not (name == "svg" and attributes.endswith("/")):
                if name in ASIDE:
                    flush()
                _, above, inside, aside, opaque, children = stack[-1]
                mark = CLASS.search(attributes) if attributes else None
                label = f"{name}.{' '.join(w for w in mark.group(1).split() if w.isalpha())}" if mark else name
                children[label] += 1
                off = is_aside(name, attributes, inside)
                self.order.append(len(self.ids))
                stack.append((name, len(self.ids), inside or name in ("article", "main"), aside or off, opaque or name in OPAQUE, Counter()))
                depth[name] += 1
                self.ids.append(_key(f"{self.ids[above]}/{label}#{children[label]}"))
                self.parents.append(above)
                self.names.append(name)
                self.depths.append(self.depths[above] + 1)
            if name in RAW:
                close = RAW[name].search(page, at)
                at = close.end() if close else end
                depth[stack.pop()[0]] -= 1
        flush()

    def text_ids(self) -> list[int]:
        return [_key(f"{self.ids[at]}\0{text}") for at, text, _, _ in self.blocks]

    def sums(self, weights: list[int]) -> list[int]:
        """Of each element, the weights of all blocks inside it."""
        total = [0] * len(self.ids)
        for (at, _, _, _), w in zip(self.blocks, weights, strict=True):
            total[at] += w
        for i in range(len(total) - 1, 0, -1):
            total[self.parents[i]] += total[i]
        return total


def _root() -> Column:
    """A hash of the host, which stands for the page itself in the tokens of its template."""
    host = F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.xxhash64(F.coalesce(F.lower(host), F.lit("")))


def page_tokens(pages: DataFrame) -> DataFrame:
    """(root, token, page) of each token of each page; page is a hash of the html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, tokens, keys = [], [], []
            for root, source in zip(batch.column("root").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = Page(source, root)
                found = {*page.ids, *page.text_ids()}
                tokens.extend(found)
                roots.append((root, len(found)))
                keys.append(_key(source or ""))
            sizes = [n for _, n in roots]
            columns = [np.repeat(np.array([r for r, _ in roots], np.int64), sizes), np.array(tokens, np.int64), np.repeat(np.array(keys, np.int64), sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["root", "token", "page"])

    return pages.select(_root().alias("root"), "html").mapInArrow(run, "root long, token long, page long")


def candidates(pages: DataFrame, support: float, least_pages: int) -> DataFrame:
    """(root, token, pages) of the tokens on most distinct pages of their host."""
    tokens = page_tokens(pages).distinct().groupBy("root", "token").agg(F.count("*").alias("pages"))
    tokens = cut(tokens.filter(F.col("pages") >= support * least_pages))
    # the page itself is a token of every page
    hosts = tokens.filter("root = token").select(F.col("root").alias("_root"), F.col("pages").alias("_pages")).filter(F.col("_pages") >= least_pages)
    return tokens.join(hosts, (F.col("root") == F.col("_root")) & (F.col("pages") >= support * F.col("_pages"))).select("root", "token", "pages")


def _with_tables(pages: DataFrame, rows: DataFrame, marks: list[str], read: Callable[[dict | None, pa.RecordBatch, list], Iterator[pa.RecordBatch]], schema: str, broadcast_tokens: int) -> DataFrame:
    """Runs ``read`` on each batch of pages (with root) and, for each page, what its host has in ``rows``: marks by token, or None."""
    if rows.count() <= broadcast_tokens:
        tables: dict[int, dict[int, tuple]] = {}
        for r in rows.toLocalIterator():
            tables.setdefault(r["root"], {})[r["token"]] = tuple(r[m] for m in marks)
        held = pages.sparkSession.sparkContext.broadcast(tables)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state: dict = {}
            for batch in batches:
                yield from read(state, batch, [held.value.get(r) for r in batch.column("root").to_pylist()])
            yield from read(state, None, [])

        return pages.mapInArrow(run, schema)
    lists = rows.groupBy("root").agg(F.collect_list(F.struct("token", *marks)).alias("_marks"))

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            found = batch.column("_marks").to_pylist()
            yield from read(state, batch, [m and {x["token"]: tuple(x[k] for k in marks) for x in m} for m in found])
        yield from read(state, None, [])

    return pages.join(lists, "root", "left").mapInArrow(run_joined, schema)


VECTORS = "root long, token long, element boolean, depth int, mass long, low long, high long, v1 long, v2 long"


def occurrences(pages: DataFrame, found: DataFrame, broadcast_tokens: int) -> DataFrame:
    """Of each candidate: its occurrence vector (two sums of hashes), least and greatest gap, and the mass of slots inside it."""

    def read(state: dict, batch: pa.RecordBatch | None, tables: list) -> Iterator[pa.RecordBatch]:
        if batch is not None:
            for root, source, table in zip(batch.column("root").to_pylist(), batch.column("html").to_pylist(), tables, strict=True):
                if table:
                    _observe(state, root, Page(source, root), _key(source or ""), table)
        if state and (batch is None or len(state) > FLUSH):
            rows = [(root, token, *known) for (root, token), known in state.items()]
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), *[pa.int64()] * 5]
            names = [c.split()[0] for c in VECTORS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            state.clear()

    rows = _with_tables(pages.select(_root().alias("root"), "html"), found, ["pages"], read, VECTORS, broadcast_tokens)
    return rows.groupBy("root", "token").agg(
        F.first("element").alias("element"), F.first("depth").alias("depth"), F.sum("mass").alias("mass"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("v1").alias("v1"), F.sum("v2").alias("v2"),
    )


def _observe(state: dict, root: int, page: Page, key: int, table: dict[int, tuple]) -> None:
    texts = page.text_ids()
    often = Counter(texts)
    mass = page.sums([0 if aside or t in table else len(text) for t, (_, text, _, aside) in zip(texts, page.blocks, strict=True)])
    # the open gaps of each element: its candidates so far, by falling support
    gaps: dict[int, list[tuple[int, int]]] = {}
    seen: set[int] = set()
    for x in (0, *page.order):
        token = page.ids[x] if x >= 0 else texts[-x - 1]
        if token not in table or token in seen:
            continue
        seen.add(token)
        support = table[token][0]
        before = gaps.setdefault(page.parents[x] if x >= 0 else page.blocks[-x - 1][0], [])
        while before and before[-1][0] < support:
            before.pop()
        gap = before[-1][1] if before else 0
        before.append((support, token))
        n = 1 if x >= 0 else often[token]
        h = ((key ^ (n * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        h ^= h >> 29
        one, two = h & 0x7FFFFFFF, (h >> 31) & 0x7FFFFFFF
        known = state.get((root, token))
        if known is None:
            depth = page.depths[x] if x >= 0 else page.depths[page.blocks[-x - 1][0]] + 1
            state[root, token] = (x >= 0, depth, mass[x] if x >= 0 else 0, gap, gap, one, two)
        else:
            element, depth, held, low, high, v1, v2 = known
            state[root, token] = (element, depth, held + (mass[x] if x >= 0 else 0), min(low, gap), max(high, gap), v1 + one, v2 + two)


def templates(pages: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """(root, token, element, mass, main): the template tokens of each host; main is set for the element that holds the article."""
    found = cut(candidates(pages, support, least_pages))
    seen = cut(occurrences(pages, found, broadcast_tokens))
    classes = seen.groupBy("root", "v1", "v2").agg(F.sum(F.when(F.col("element"), 2).otherwise(1)).alias("size")).filter(F.col("size") >= LEAST_SIZE)
    valid = seen.join(classes, ["root", "v1", "v2"]).filter("low = high").select("root", "token", "element", "depth", "mass")
    whole = valid.filter("root = token").select("root", F.col("mass").alias("whole"))
    inner = valid.join(whole, "root").filter(F.col("element") & (F.col("mass") >= MASS * F.col("whole")) & (F.col("mass") > 0))
    inner = inner.groupBy("root").agg(F.max(F.struct("depth", "mass", "token"))["token"].alias("inner"))
    return cut(valid.join(inner, "root", "left").select("root", "token", "element", "mass", F.coalesce(F.col("token") == F.col("inner"), F.lit(False)).alias("main")))


def article(page: Page, table: dict[int, tuple[bool, int, bool]] | None) -> str:
    """The article's text: blocks joined by an empty line. ``table`` has, for each template token, element, mass and main."""
    left = [i for i, (_, _, _, aside) in enumerate(page.blocks) if not aside]
    named = [i for i in left if page.blocks[i][2]]
    main = next((i for i, token in enumerate(page.ids) if token in table and table[token][2]), None) if table else None
    if main is None:
        return "\n\n".join(page.blocks[i][1] for i in named or left)
    # of each element, the one right below the main element that it is in: itself 0 if not inside, main if it's the main one
    part = [0] * len(page.ids)
    part[main] = main
    for i in range(main + 1, len(page.ids)):
        above = page.parents[i]
        part[i] = i if above == main else part[above] if above > main else 0
    inside = [i for i in left if part[page.blocks[i][0]] or page.blocks[i][0] == main]
    texts = page.text_ids()

    def is_slot(i: int) -> bool:
        at = part[page.blocks[i][0]]
        # what isn't in the template is slot; a part of the template is if any page has a slot there
        return texts[i] not in table or (at != main and (page.ids[at] not in table or table[page.ids[at]][1] > 0))

    slots = [k for k, i in enumerate(inside) if is_slot(i)]
    if not slots or (named and set(named).isdisjoint(inside)):
        return "\n\n".join(page.blocks[i][1] for i in named)
    inside = inside[slots[0] : slots[-1] + 1]
    # a text without its headline: the last one before it, with what stands between
    for heading in ("h1", "h2"):
        heads = [i for i in left if page.names[page.blocks[i][0]] == heading]
        if heads:
            before = [i for i in heads if i < inside[0] and texts[i] not in table]
            if before and not set(heads) & set(inside):
                inside = [i for i in left if before[-1] <= i < inside[0]] + inside
            break
    return "\n\n".join(page.blocks[i][1] for i in inside)


def extract(pages: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    prepare(pages.sparkSession)
    found = templates(pages, support, least_pages, broadcast_tokens)

    def read(_: dict, batch: pa.RecordBatch | None, tables: list) -> Iterator[pa.RecordBatch]:
        if batch is not None:
            roots, sources = batch.column("root").to_pylist(), batch.column("html").to_pylist()
            texts = [article(Page(s, r), t) for s, r, t in zip(sources, roots, tables, strict=True)]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", _root().alias("root"))
    return _with_tables(rows, found, ["element", "mass", "main"], read, "page_id long, url string, text string, n_chars long", broadcast_tokens)
