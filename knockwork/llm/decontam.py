"""Benchmark decontamination over a distributed positional inverted index, in SQL functions.

The words of benchmark windows are counted over all documents, so that each window's posting
lists can be taken from its rarest word on. The index of the two rarest words of every window
covers all documents: a posting is a word's number, document and position. Windows meet the
list of their rarest word; a place stays if the list of the second rarest has the document
within a window's length of it. For the documents that still have a place, and the few others
that a sieve lets through, the lists of all words of all windows are made, document by
document, and intersected at the offsets that the window gives them, in order of rarity.

A place that all lists have at their offsets is an exact phrase. A proximity match is a place of
the rarest word that has the second rarest and at least a share ``near`` of all the window's
different words within a window's length on either side, in any order.

What is broadcast are blocks of at most ``BLOCK_TERMS`` words, of which long ones are named by a
hash, and of at most ``BLOCK_WINDOWS`` windows; one block does for most benchmarks.

Null and empty texts have no words. Items without words have no windows; repeated items and
windows that several items share are searched for once. Documents are named by id and
content: repeated rows get the same result each, rows that share an id but not a text
their own. Of words that are equally rare, the first of a window counts as the rarer one. Empty
tables give no hits or no rows. Extra columns stay in ``keep_clean`` and are left out of
``contamination``.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwork.llm.scratch import Scratch
from knockwork.llm.sieve import Sieve, free

#: Fixed values of the contract.
WINDOW = 13
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_SHARE = 20
#: Share of a window's different words that makes a proximity match.
NEAR = 0.8

#: Words and windows that are broadcast at once, and characters beyond which a word is named by its hash.
BLOCK_TERMS, BLOCK_WINDOWS, LONG_WORD = 200_000, 100_000, 64

#: Stands after the last word of every document, so that the index knows documents without hits; no word holds it, nor what a long word is named by.
LAST, HASHED = "\x00", "\x01"


def _split(text: Column) -> Column:
    """Words with A-Z in lower case; an empty string stands first or last where the text starts or ends between words."""
    plain = F.octet_length(text) == F.char_length(text)
    small = F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.split(F.coalesce(small, F.lit("")), BETWEEN)


def words(text: Column) -> Column:
    """Words with A-Z in lower case; an empty array for a null text."""
    return F.array_remove(_split(text), "")


def _name(word: Column) -> Column:
    return F.when(F.octet_length(word) <= LONG_WORD, word).otherwise(F.concat(F.lit(HASHED), F.sha2(word, 256)))


def windows(benchmark: DataFrame, text: str = "text", item: str = "item_id", size: int = WINDOW) -> DataFrame:
    """(item, w, id): every window of each item, its words by name; a shorter item is one window."""
    said = benchmark.select(F.col(item).alias("item"), F.transform(words(F.col(text)), _name).alias("ws")).filter("size(ws) > 0")
    cut = F.expr(f"transform(sequence(1, greatest(1, size(ws) - {size - 1})), i -> slice(ws, i, {size}))")
    return said.select("item", F.explode(cut).alias("w")).withColumn("id", F.concat_ws(" ", "w")).distinct()


def _blocks(table: DataFrame, by: str, most: int) -> list[DataFrame]:
    n = -(-table.count() // most)
    return [table.filter(F.pmod(F.xxhash64(by), F.lit(n)) == i) for i in range(n)] if n != 1 else [table]


def _tokens(docs: DataFrame, terms: DataFrame, *columns: str | Column) -> DataFrame:
    """Places ``pos`` of some words (term, tid) in documents ``ws``; ``terms`` is one of ``_blocks``."""
    spread = docs.select(*docs.columns, F.posexplode("ws").alias("pos", "word"))
    return spread.withColumn("term", _name(F.col("word"))).join(F.broadcast(terms), "term").select("tid", *columns)


@dataclass
class Queries:
    """What is searched for: ``terms`` (term, tid), ``items`` (wid, item) and ``windows``, as ``planned`` makes them."""

    terms: DataFrame
    items: DataFrame
    windows: DataFrame


def planned(docs: DataFrame, found: DataFrame, scratch: Scratch, block_terms: int = BLOCK_TERMS) -> Queries:
    """Windows (wid, size, places, tid1, off1, tid2, different): places (n, off, tid) in order of rarity over all documents ``ws``."""
    terms = scratch.keep(found.select(F.explode("w").alias("term")).distinct().select("term", F.monotonically_increasing_id().alias("tid")), "terms")
    named = scratch.keep(found.groupBy("id", "w").agg(F.collect_set("item").alias("item")).select("w", "item", F.monotonically_increasing_id().alias("wid")), "named")
    counted = terms.select("tid", F.lit(0).cast("long").alias("n"))
    for block in _blocks(terms, "term", block_terms):
        counted = counted.unionByName(_tokens(docs.select("ws"), block).groupBy("tid").agg(F.count("*").alias("n")))
    frequency = scratch.keep(counted.groupBy("tid").agg(F.sum("n").alias("n")), "frequencies")
    spread = named.select("wid", F.posexplode("w").alias("off", "term")).join(terms, "term").join(frequency, "tid")
    places = F.sort_array(F.collect_list(F.struct("n", "off", "tid"))).alias("places")
    second = F.expr("coalesce(get(filter(places, x -> x.tid != places[0].tid), 0), places[0]).tid")
    table = spread.groupBy("wid").agg(places).select(
        "wid", F.size("places").alias("size"), "places", F.expr("places[0].tid").alias("tid1"), F.expr("places[0].off").alias("off1"), second.alias("tid2"),
        F.array_distinct(F.transform("places", lambda x: x["tid"])).alias("different"),
    )
    return Queries(terms, named.select("wid", F.explode("item").alias("item")), scratch.keep(table, "windows"))


def index(docs: DataFrame, queries: Queries, scratch: Scratch, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Postings (tid, doc, tag, pos, n) of the two rarest words of each window; n counts the document's words.

    Every document has one more posting for each of its rows, of no word (tid -1).
    """
    rare = queries.windows.select(F.explode(F.array("tid1", "tid2")).alias("tid")).distinct().join(queries.terms, "tid").select("term", "tid")
    n = F.expr("size(ws) - int(ws[0] = '') - int(size(ws) > 1 and element_at(ws, -1) = '')").cast("long")
    ended = docs.select("doc", "tag", n.alias("n"), F.array_append("ws", F.lit(LAST)).alias("ws"))
    last = docs.sparkSession.range(1).select(F.lit(LAST).alias("term"), F.lit(-1).cast("long").alias("tid"))
    out = None
    for block in _blocks(rare, "term", block_terms) or [rare]:
        found = _tokens(ended, block.unionByName(last) if out is None else block, "doc", "tag", "pos", "n")
        out = found if out is None else out.unionByName(found)
    return scratch.keep(out, "postings")


def places(postings: DataFrame, queries: Queries, scratch: Scratch, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(wid, doc, tag, pos): where a window's rarest word has its second rarest within a window's length; a list has a place once."""
    lists = scratch.keep(postings.filter("tid >= 0").select("tid", "doc", "tag", "pos").distinct(), "lists")
    out = None
    for block in _blocks(queries.windows.select("wid", "tid1", "tid2"), "wid", block_windows):
        first = lists.join(F.broadcast(block), F.col("tid") == F.col("tid1")).select("wid", "tid2", "doc", "tag", "pos")
        out = first if out is None else out.unionByName(first)
    if out is None:
        out = lists.limit(0).select(F.col("tid").alias("wid"), F.col("tid").alias("tid2"), "doc", "tag", "pos")
    a, b = out.alias("a"), lists.alias("b")
    same = F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.tag") == F.col("b.tag")) & (F.col("a.tid2") == F.col("b.tid"))
    return scratch.keep(a.join(b, same & (F.abs(F.col("a.pos") - F.col("b.pos")) < size), "left_semi").select("wid", "doc", "tag", "pos"), "places")


def matches(docs: DataFrame, found: DataFrame, queries: Queries, scratch: Scratch, size: int = WINDOW, near: float = NEAR, block_terms: int = BLOCK_TERMS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(wid, doc, tag, start, size, exact): places at which the lists of all of a window's words meet, at their offsets or in proximity."""
    sieve = Sieve(found.select("doc", "tag").distinct(), F.xxhash64("doc", "tag"), scratch)
    some, _ = sieve.split(docs, F.xxhash64("doc", "tag"))
    tokens = None
    for block in _blocks(queries.terms, "term", block_terms):
        part = _tokens(some, block, "doc", "tag", "pos")
        tokens = part if tokens is None else tokens.unionByName(part)
    if tokens is None:
        tokens = docs.limit(0).select(F.lit(0).cast("long").alias("tid"), "doc", "tag", F.lit(0).alias("pos"))
    by_word = tokens.groupBy("doc", "tag", "tid").agg(F.collect_set("pos").alias("at"))
    lists = by_word.groupBy("doc", "tag").agg(F.map_from_entries(F.collect_list(F.struct("tid", "at"))).alias("lists")).withColumnsRenamed({"doc": "doc_", "tag": "tag_"})
    lists = scratch.keep(lists, "documents")
    out = None
    for block in _blocks(queries.windows.drop("tid1", "tid2"), "wid", block_windows):
        part = found.join(F.broadcast(block), "wid")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = found.join(queries.windows.drop("tid1", "tid2"), "wid")
    met = out.join(lists, F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("tag") == F.col("tag_")))
    met = met.withColumn("start", F.col("pos") - F.col("off1"))
    exact = F.expr("forall(places, x -> coalesce(array_contains(try_element_at(lists, x.tid), start + x.off), false))")
    around = F.expr(f"size(filter(different, t -> coalesce(exists(try_element_at(lists, t), p -> abs(p - pos) < {size}), false)))")
    met = met.select("wid", "doc", "tag", "start", "size", exact.alias("exact"), (around >= F.lit(near) * F.size("different")).alias("close"))
    return scratch.keep(met.filter("exact or close").select("wid", "doc", "tag", "start", "size", "exact").distinct(), "matches")


def _judged(docs: DataFrame, benchmark: DataFrame, text: str, key: str, item: str, bench_text: str, size: int, near: float, block_terms: int, block_windows: int) -> DataFrame:
    """(doc, tag, n, n_hit, items, n_near) of every row."""
    scratch = Scratch(docs.sparkSession, "decontam")
    found = scratch.keep(windows(benchmark, bench_text, item, size), "items")
    given = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("tag"), _split(F.col(text)).alias("ws"))
    queries = planned(given, found, scratch, block_terms)
    postings = index(given, queries, scratch, block_terms)
    hit = matches(given, places(postings, queries, scratch, size, block_windows), queries, scratch, size, near, block_terms, block_windows)
    covered = hit.filter("exact").groupBy("doc", "tag").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans")).select(
        "doc", "tag",
        F.expr("aggregate(spans, named_struct('to', 0, 'n', 0L), (s, x) -> named_struct('to', greatest(s.to, x.start + x.size),"
               " 'n', s.n + greatest(0, x.start + x.size - greatest(s.to, x.start))), s -> s.n)").alias("n_hit"))
    by_item = hit.groupBy("wid", "doc", "tag").agg(F.max("exact").alias("exact")).join(queries.items, "wid").groupBy("doc", "tag", "item").agg(F.max("exact").alias("exact"))
    items = by_item.groupBy("doc", "tag").agg(F.collect_set(F.when(F.col("exact"), F.col("item").cast("string"))).alias("items"), F.count("*").alias("n_near"))

    def same(a: DataFrame, b: DataFrame) -> Column:
        return a.doc.eqNullSafe(b.doc) & (a.tag == b.tag)  # a null id meets itself, as every other one does

    hits = items.join(covered, same(items, covered), "left").select(items.doc, items.tag, "n_hit", F.array_sort("items").alias("items"), "n_near")
    rows = postings.filter("tid = -1").select("doc", "tag", "n")
    zero = F.lit(0).cast("long")
    return rows.join(hits, same(rows, hits), "left").select(
        rows.doc, rows.tag, "n", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("n_near", zero).alias("n_near"))


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (LEAST_SHARE * F.col("n_hit") >= F.col("n"))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", bench_text: str = "text", size: int = WINDOW, near: float = NEAR, block_terms: int = BLOCK_TERMS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``key``, n_words, n_hit, n_items, items_sha256, contaminated and n_near (items with exact or proximity matches) of every row."""
    return _judged(docs, benchmark, text, key, item, bench_text, size, near, block_terms, block_windows).select(
        F.col("doc").alias(key), F.col("n").alias("n_words"), "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"), "n_near",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", bench_text: str = "text", size: int = WINDOW, near: float = NEAR, block_terms: int = BLOCK_TERMS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows that aren't contaminated, with all their columns; only those that a sieve of contaminated ones lets through are moved."""
    scratch = Scratch(docs.sparkSession, "decontam-clean")
    judged = _judged(docs, benchmark, text, key, item, bench_text, size, near, block_terms, block_windows)
    a, b = (free(f"decon_{x}", docs.columns) for x in ("doc", "tag"))
    gone = scratch.keep(judged.filter(contaminated()).select(F.col("doc").alias(a), F.col("tag").alias(b)).distinct(), "gone")
    maybe, clean = Sieve(gone, F.xxhash64(a, b), scratch).split(docs, F.xxhash64(F.col(key), F.xxhash64(text)))
    return clean.unionByName(maybe.join(gone, F.col(key).eqNullSafe(F.col(a)) & (F.xxhash64(text) == F.col(b)), "left_anti"))
