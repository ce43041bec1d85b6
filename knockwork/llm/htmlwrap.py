"""Main text of web pages through wrappers: union-free regular expressions inferred for each host.

A page is a stream of tags and texts. Runs that repeat are folded into repeated groups;
two streams of a host are aligned by a longest common subsequence, a single occurrence of
what the other side repeats counts as a group of one, what only one of them has becomes an
optional group, and texts that differ become slots. A wrapper is what remains when all pages
of a host have been aligned. Optional groups are kept as gaps; a wrapper is at most about
twice as long as the shortest page of its host.

The slots of the wrapper decide what is main text, for all pages of the host alike. Each
collects from all pages how many characters stood in it inside an article, outside one (in an
element whose tag, role or class names a menu, header, footer, sidebar, notice, advert, form
or reader comment), in prose and in blocks of links only. A slot that mostly stood in articles
is main text; one that mostly stood outside isn't; of the others, those are that vary from page
to page and aren't mostly links. So a page with broken markup, or one that lacks the marks
which the host's other pages have, is read as these are.

Tag rules alone decide texts that stand in no slot (in an optional group), and all texts of
hosts whose pages have fewer than ``LEAST_PAGES`` different main texts; copies count as one.

Pages of one shape are joined slot by slot, in any order; shapes are aligned in an order
that their content gives, so partitions and the order of rows don't change a text. A host's
shapes are aligned ``FAN`` at a time, level by level, whatever their number.

A null or empty page has the text ''. Pages without a host share one wrapper. Repeated
rows are extracted one by one; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwork.llm.scratch import Scratch

#: Main texts of a host that differ (as the tag rules alone give them) before its slots decide.
LEAST_PAGES = 4
#: Tokens of a repeated group and bytes of the hash by which a wrapper remembers a text.
PERIOD, REMEMBERED = 12, 16
#: Nodes of shapes that a task holds before it hands them on; parts in which pages of one shape are joined first; shapes aligned at once.
NODES, SALTS, FAN = 1 << 17, 64, 256
#: Wrappers and nodes that a task holds, and nodes of pages whose decisions are remembered.
HOSTS, KNOWN = 2000, 1 << 14
#: Bytes of wrappers that are broadcast; more are joined by host, where Spark splits a large one.
BROADCAST_BYTES = 16 << 20

#: Fixed values of HTML: elements by the way they are laid out or closed.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BOXES = set("article aside blockquote body center dd details dialog div dl dt fieldset figure footer form header html li main menu nav ol section summary table tbody td tfoot th thead tr ul button".split())
IMPLIED = set("/p /li /dt /dd /td /th /tr /thead /tbody /tfoot /body /html /head".split())
#: Elements, roles and words in class or id that aren't part of an article.
OUTSIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button"}
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
OUTSIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription "
    "tags toolbar topbar widget widgets".split()
)
#: Words that change nothing beside those in a name such as page-footer or ad-box-2.
FILLER = set("area bar block box button buttons bottom col column container div group holder inner item items left link links list outer page panel right row section site slot text top unit wrap wrapper".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<raw>script|style|textarea|noscript|template|svg|iframe|select|title|math|object|canvas)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Page:
    """``shape[i]`` is the tag of token i or '#'; texts hold the decoded text of each '#', else ''."""

    shape: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)


def tokens(source: str) -> Page:
    page = Page()
    for m in _TOKEN.finditer(source):
        text = m["text"]
        if text is not None:
            text = html.unescape(text)
            if page.shape and page.shape[-1] == "#":
                page.texts[-1] += text
                continue
            page.shape.append("#")
            page.texts.append(text)
            page.attributes.append("")
        elif tag := m["tag"] or m["tag2"]:
            page.shape.append((m["close"] or m["close2"] or "") + tag.lower())
            page.texts.append("")
            page.attributes.append(m["attributes"] or m["attributes2"] or "")
    return page


@dataclass
class Node:
    """A token, a repeated group or (``sign`` None) a gap of optional ones.

    ``slots`` hold the tokens of its texts in a page; in a wrapper (what was said, None once
    pages differ; characters in articles, outside, in prose, in links).
    """

    sign: object
    slots: list


def fold(nodes: list[Node]) -> list[Node]:
    """Tandem repeats as repeated groups, shortest first."""
    for period in range(1, PERIOD + 1):
        out: list[Node] = []
        i, n = 0, len(nodes)
        signs = [x.sign for x in nodes]
        while i < n:
            unit = signs[i : i + period]
            j = i + period
            while signs[j : j + period] == unit and j + period <= n:
                j += period
            if j == i + period or (period == 1 and unit == ["#"]):
                out.append(nodes[i])
                i += 1
                continue
            slots = [s for x in nodes[i : i + period] for s in x.slots]
            for k in range(i + period, j, period):
                slots = [_joined(a, b) for a, b in zip(slots, (s for x in nodes[k : k + period] for s in x.slots), strict=True)]
            sign = unit[0] if period == 1 and isinstance(unit[0], tuple) else ("+", *unit)
            out.append(Node(sign, slots))
            i = j
        nodes = out
    return nodes


def _joined(a: list | tuple, b: list | tuple) -> list | tuple:
    if isinstance(a, list):
        return a + b
    return (a[0] if a[0] == b[0] else None, *(x + y for x, y in zip(a[1:], b[1:], strict=True)))


def units_of(nodes: list[Node]) -> set[tuple]:
    """What the repeated groups repeat."""
    return {x.sign[1:] for x in nodes if isinstance(x.sign, tuple)}


def regrouped(nodes: list[Node], units: set[tuple]) -> list[Node]:
    """Single occurrences of ``units`` as groups of one, neighbouring groups of the same unit as one."""
    for unit in sorted(units, key=lambda u: (len(u), repr(u))):
        out: list[Node] = []
        i, size, group = 0, len(unit), ("+", *unit)
        while i < len(nodes):
            if nodes[i].sign == group:
                node, step = nodes[i], 1
            elif nodes[i].sign == unit[0] and tuple(x.sign for x in nodes[i : i + size]) == unit:
                node, step = Node(group, [s for x in nodes[i : i + size] for s in x.slots]), size
            else:
                out.append(nodes[i])
                i += 1
                continue
            if out and out[-1].sign == group:
                out[-1] = Node(group, [_joined(a, b) for a, b in zip(out[-1].slots, node.slots, strict=True)])
            else:
                out.append(node)
            i += step
        nodes = out
    return nodes


def nodes_of(page: Page) -> list[Node]:
    """The folded page; blank texts, inline tags and end tags that may be left out are no structure."""
    out = []
    for i, sign in enumerate(page.shape):
        if sign == "#":
            if page.texts[i].isspace() or not page.texts[i]:
                continue
            if out and out[-1].sign == "#":
                out[-1].slots[0].append(i)
                continue
            out.append(Node("#", [[i]]))
        elif sign.lstrip("/") not in INLINE and sign not in IMPLIED and sign != "br":
            out.append(Node(sign, []))
    return fold(out)


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence.

    A row of its table is the bits of one number; every few rows are kept, those between are made again on the way back.
    """
    low, high, end = 0, min(len(a), len(b)), 0
    while low < high and a[low] == b[low]:
        low += 1
    while end < high - low and a[-1 - end] == b[-1 - end]:
        end += 1
    n, m = len(a) - low - end, len(b) - low - end
    where: dict = {}
    for j in range(m):
        where[b[low + j]] = where.get(b[low + j], 0) | 1 << j
    full, step = (1 << m) - 1, isqrt(n) + 1

    def rows(begin: int, row: int) -> list[int]:
        """Bit j of row i is 0 where one more of a[:i] is found in b[: j + 1] than in b[:j]."""
        out = [row]
        for sign in a[low + begin : low + min(n, begin + step)]:
            met = row & where.get(sign, 0)
            row = (row + met | row - met) & full
            out.append(row)
        return out

    middle, kept = [], [full]
    for begin in range(0, n if m else 0, step):
        kept.append(rows(begin, kept[-1])[-1])
    j = m
    for begin in reversed(range(0, n if m else 0, step)):
        table = rows(begin, kept[begin // step])
        for i in reversed(range(len(table) - 1)):
            below = (1 << j) - 1
            found = ~table[i + 1] & below
            if found.bit_count() > (~table[i] & below).bit_count():
                j = found.bit_length() - 1
                middle.append((low + begin + i, low + j))
    return [(i, i) for i in range(low)] + middle[::-1] + [(len(a) - i, len(b) - i) for i in range(end, 0, -1)]


@dataclass
class Wrapper:
    """Nodes of a host's pages, how many rows they come from and hashes of their different main texts, LEAST_PAGES at most."""

    nodes: list[Node]
    pages: int
    articles: set[bytes]

    def take(self, nodes: list[Node], pages: int, articles: set[bytes]) -> None:
        """Align other nodes with these."""
        self.pages += pages
        self.articles = _few(self.articles | articles)
        own, other = units_of(self.nodes), units_of(nodes)
        mine, nodes = regrouped(self.nodes, own | other), regrouped(nodes, own | other)
        known = [i for i, y in enumerate(nodes) if y.sign is not None]
        places = {known[b]: a for a, b in common([x.sign if x.sign is not None else object() for x in mine], [nodes[i].sign for i in known])}
        merged, at, left = [], 0, []  # left: nodes of either side since the last that both have
        for i, y in enumerate(nodes):
            place = places.get(i)
            if place is None:
                left.append(y)
                continue
            left += mine[at:place]
            merged += _gap(left)
            merged.append(Node(y.sign, [_joined(a, b) for a, b in zip(mine[place].slots, y.slots, strict=True)]))
            at, left = place + 1, []
        self.nodes = merged + _gap(left + mine[at:])

    def plain(self) -> bytes:
        return pickle.dumps((self.pages, sorted(self.articles), [(x.sign, x.slots) for x in self.nodes]))

    def judged(self) -> Judge:
        """What extraction needs; a wrapper of too few different pages decides nothing."""
        if len(self.articles) < LEAST_PAGES:
            return Judge([], [])
        nodes = [x for x in self.nodes if x.sign is not None]
        return Judge([x.sign for x in nodes], [[is_main(*s) for s in x.slots] for x in nodes])


def is_main(said: bytes | None, article: int, outside: int, prose: int, links: int) -> bool:
    """Whether a slot holds main text: what was said (None where pages differ) and the characters of it in four kinds of places."""
    if article >= max(1, outside, prose + links):
        return True
    return outside <= article + prose + links and said is None and prose >= links


@dataclass
class Judge:
    """Signs of a host's wrapper and, for the slots of each, whether they hold main text."""

    signs: list
    main: list[list[bool]]
    known: dict = field(default_factory=dict, repr=False)
    held: int = 0

    def decisions(self, nodes: list[Node]) -> list[bool | None]:
        """Of every slot of a page, in order: whether it is main text, None where the wrapper doesn't have it."""
        signs = tuple(x.sign for x in nodes)
        if signs not in self.known:
            if self.held > KNOWN:
                self.known.clear()
                self.held = 0
            count, numbered = 0, []
            for x in nodes:
                numbered.append(Node(x.sign, [[count + k] for k in range(len(x.slots))]))
                count += len(x.slots)
            out: list[bool | None] = [None] * count
            own = {s[1:] for s in self.signs if isinstance(s, tuple)}
            mine = regrouped(numbered, own)
            for a, b in common(self.signs, [x.sign for x in mine]):
                for slots, main in zip(mine[b].slots, self.main[a], strict=True):
                    for i in slots:
                        out[i] = main
            self.known[signs] = out
            self.held += len(signs)
        return self.known[signs]

    def plain(self) -> bytes:
        return pickle.dumps((self.signs, self.main))


def _few(articles: set[bytes]) -> set[bytes]:
    return set(sorted(articles)[:LEAST_PAGES])


def _gap(nodes: list[Node]) -> list[Node]:
    """What stands for optional nodes."""
    return [Node(None, [])] if nodes else []


def opened(data: bytes) -> Wrapper:
    pages, articles, nodes = pickle.loads(data)
    return Wrapper([Node(*x) for x in nodes], pages, set(articles))


def _hashed(text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=REMEMBERED).digest()


def _outside(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in OUTSIDE or (tag == "header" and not inside_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes.lower()):
        value = a or b or c
        if name in ("class", "id") and any(_names_outside(token) for token in value.split()):
            return True
        if (name == "role" and value in OUTSIDE_ROLES) or (name == "hidden" and not value) or (name == "style" and "display:none" in value.replace(" ", "")):
            return True
    return False


@lru_cache(1 << 14)
def _names_outside(token: str) -> bool:
    """Whether a class or id is made of words for what isn't an article: cookie-notice is, social-history isn't."""
    words = {w for w in _WORD.findall(token) if len(w) > 1}
    return not words.isdisjoint(OUTSIDE_WORDS) and words <= OUTSIDE_WORDS | FILLER


ARTICLE, ASIDE, PROSE, LINKS = range(4)


def places_of(page: Page) -> tuple[list[int], list[int]]:
    """(kind, block) of every token: where tag rules place a text, and which block of the page it belongs to."""
    has_article = any(s in ("article", "main") for s in page.shape)
    kinds, blocks = [PROSE] * len(page.shape), [0] * len(page.shape)
    stack: list[tuple[str, bool, bool]] = []  # tag, whether outside, whether an article
    outside = inside = links = paragraph = number = 0
    block: list[int] = []
    plain = False  # whether any text of this block stands outside a link, or in a paragraph
    for i, sign in enumerate(page.shape):
        blocks[i] = number
        if sign == "#":
            if outside or (has_article and not inside):
                kinds[i] = ASIDE
            elif inside:
                kinds[i] = ARTICLE
            else:
                block.append(i)
                plain |= (not links or paragraph) and not page.texts[i].isspace()
        elif sign == "a":
            links = 1
        elif sign == "/a":
            links = 0
        elif sign.lstrip("/") in INLINE and not _outside(sign, page.attributes[i], True):
            continue
        else:
            if not plain:  # a block of links only is a menu
                for k in block:
                    kinds[k] = LINKS
            block, plain, number = [], False, number + 1
            tag = sign.lstrip("/")
            paragraph = sign == "p" or (paragraph and tag == "br")
            if tag not in BOXES and tag not in INLINE:
                continue
            if sign[0] != "/":
                out, article = _outside(tag, page.attributes[i], inside > 0), tag in ("article", "main")
                stack.append((tag, out, article))
                outside, inside = outside + out, inside + article
            elif any(t == tag for t, _, _ in stack):
                while True:
                    t, out, article = stack.pop()
                    outside, inside = outside - out, inside - article
                    if t == tag:
                        break
    if not plain:
        for k in block:
            kinds[k] = LINKS
    return kinds, blocks


def said(page: Page, nodes: list[Node], kinds: list[int]) -> list[Node]:
    """The nodes of a page with what its slots say and where, in place of the tokens."""
    out = []
    for x in nodes:
        slots = []
        for tokens_ in x.slots:
            texts = [_SPACE.sub(" ", page.texts[i]) for i in tokens_]
            chars = [0] * 4
            for i, t in zip(tokens_, texts, strict=True):
                chars[kinds[i]] += len(t)
            slots.append((_hashed(texts[0]) if all(t == texts[0] for t in texts) else None, *chars))
        out.append(Node(x.sign, slots))
    return out


def _joined_texts(page: Page, kept: Iterable[int], blocks: list[int]) -> str:
    parts, last = [], None
    for i in kept:
        if blocks[i] != last:
            parts.append(" ")
            last = blocks[i]
        parts.append(page.texts[i])
    return _SPACE.sub(" ", "".join(parts)).strip()


def by_tags(page: Page, kinds: list[int], blocks: list[int]) -> str:
    """The main text by tag rules alone."""
    return _joined_texts(page, (i for i, s in enumerate(page.shape) if s == "#" and kinds[i] in (ARTICLE, PROSE)), blocks)


def extract(page: Page, judge: Judge | None) -> str:
    """The main text: blocks in page order, joined by one space."""
    kinds, blocks = places_of(page)
    if judge is None or not judge.signs:
        return by_tags(page, kinds, blocks)
    nodes = nodes_of(page)
    slots = [s for x in nodes for s in x.slots]
    main = [k in (ARTICLE, PROSE) for k in kinds]
    for tokens_, decision in zip(slots, judge.decisions(nodes), strict=True):
        if decision is not None:
            for i in tokens_:
                main[i] = decision
    return _joined_texts(page, (i for i, s in enumerate(page.shape) if s == "#" and main[i]), blocks)


def shape_of(page: Page) -> tuple[list[Node], set[bytes]]:
    """A page's nodes with what it says, and the hash of its main text by tag rules; none where there is no such text."""
    kinds, blocks = places_of(page)
    text = by_tags(page, kinds, blocks)
    return said(page, nodes_of(page), kinds), {_hashed(text)} if text else set()


def aligned(shapes: Iterable[Wrapper]) -> Wrapper:
    """One wrapper of many, aligned in the order of how many pages they have and what they hold."""
    first, *rest = sorted(shapes, key=lambda w: (-w.pages, w.plain()))
    out = Wrapper(first.nodes, first.pages, set(first.articles))
    for w in rest:
        out.take(w.nodes, w.pages, w.articles)
    return out


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _flush(found: dict[tuple[str, bytes], Wrapper], salt: int) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([h for h, _ in found], pa.string()), pa.array([s for _, s in found], pa.binary()), pa.array([salt % SALTS] * len(found), pa.int64()), pa.array([w.plain() for w in found.values()], pa.binary())],
        ["host", "shape", "salt", "wrapper"],
    )


def _meet(ours: Wrapper, nodes: list[Node], pages: int, articles: set[bytes]) -> None:
    """Join pages of one shape, slot by slot."""
    for x, y in zip(ours.nodes, nodes, strict=True):
        if x.slots:
            x.slots = [_joined(a, b) for a, b in zip(x.slots, y.slots, strict=True)]
    ours.pages += pages
    if len(ours.articles) < LEAST_PAGES:
        ours.articles = _few(ours.articles | articles)


def _with_wrapper(table: pa.Table, data: bytes) -> pa.Table:
    return table.slice(0, 1).set_column(table.schema.get_field_index("wrapper"), "wrapper", pa.array([data], pa.binary()))


def infer(pages: DataFrame, scratch: Scratch, source: str = "html", url: str = "url") -> DataFrame:
    """(host, wrapper) of all pages: what ``Judge`` is made of."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, bytes], Wrapper] = {}
        held = flushed = 0
        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                nodes, articles = shape_of(tokens(text))
                key = host, _hashed(repr([x.sign for x in nodes]))
                if key in found:
                    _meet(found[key], nodes, 1, articles)
                else:
                    found[key] = Wrapper(nodes, 1, articles)
                    held += len(nodes) + 1
                if held >= NODES:
                    yield _flush(found, zlib.crc32(text.encode("utf-8", "surrogatepass")) + flushed)
                    found, held, flushed = {}, 0, flushed + 1
        if found:
            yield _flush(found, zlib.crc32(text.encode("utf-8", "surrogatepass")) + flushed)

    def same_shape(table: pa.Table) -> pa.Table:
        first, *rest = map(opened, table.column("wrapper").to_pylist())
        for w in rest:
            _meet(first, w.nodes, w.pages, w.articles)
        return _with_wrapper(table, first.plain())

    def align(table: pa.Table) -> pa.Table:
        return _with_wrapper(table, aligned(map(opened, table.column("wrapper").to_pylist())).plain())

    def conclude(table: pa.Table) -> pa.Table:
        return _with_wrapper(table, aligned(map(opened, table.column("wrapper").to_pylist())).judged().plain())

    kind = "host string, shape binary, salt long, wrapper binary"
    given = pages.filter(F.length(source) > 0).select(host_of(F.col(url)).alias("host"), F.col(source).alias("t"))
    joined = given.mapInArrow(partial, kind).groupBy("host", "shape", "salt").applyInArrow(same_shape, kind).groupBy("host", "shape").applyInArrow(same_shape, kind)
    shapes = scratch.keep(joined.select("host", "shape", "wrapper"), "shapes")
    kind = "host string, shape binary, wrapper binary"
    most = shapes_left(shapes)
    while most > FAN:
        parts = -(-most // (FAN // 2))
        level = shapes.withColumn("part", F.pmod(F.xxhash64("shape"), F.lit(parts)))
        following = scratch.keep(level.groupBy("host", "part").applyInArrow(lambda t: align(t.drop_columns("part")), kind), "level")
        scratch.drop(shapes)
        shapes, most = following, shapes_left(following)
    out = scratch.keep(shapes.groupBy("host").applyInArrow(conclude, kind).select("host", "wrapper"), "wrappers")
    scratch.drop(shapes)
    return out


def shapes_left(shapes: DataFrame) -> int:
    """The most that any host has."""
    return shapes.groupBy("host").count().agg(F.max("count")).first()[0] or 0


def main_text(pages: DataFrame, source: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """``key``, url, text and n_chars of every row."""
    wrappers = infer(pages, Scratch(pages.sparkSession, "wrappers"), source, url)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, Judge] = {}
        held = 0
        for batch in batches:
            out = []
            for text, data in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if data is not None and data not in known:
                    if len(known) > HOSTS or held > NODES:
                        known.clear()
                        held = 0
                    known[data] = Judge(*pickle.loads(data))
                    held += len(known[data].signs)
                out.append(extract(tokens(text), known.get(data)) if text else "")
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["k", "u", "text"])

    kind = pages.schema[key].dataType.simpleString()
    given = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(source).alias("t"), host_of(F.col(url)).alias("host"))
    held = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    out = given.join(F.broadcast(wrappers) if held <= BROADCAST_BYTES else wrappers, "host", "left").select("k", "u", "t", "wrapper").mapInArrow(run, f"k {kind}, u string, text string")
    return out.select(F.col("k").alias(key), F.col("u").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))
