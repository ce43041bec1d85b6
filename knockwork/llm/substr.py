"""Exact repeats of word windows across documents, found from fixed-block anchors.

Reference blocks of ``(window + 1) // 2`` words, end to end from each document's first
word, are the index; every rolling window of a block's length probes it. A repeat of
``window`` words holds a whole block of either document, so no repeat is missed. Hits are
extended: every window over a hit is compared with those over the hits of other
documents, and runs of windows that repeat are the maximal exact repeats.

What very many documents share is collapsed where it is read: a block of rows sends one
entry for a run of words that several of its documents hold, and decides for them itself; the
runs of the last blocks that were so are remembered, so a task sends few entries for what stands everywhere.
Entries are packed into one row for each bucket of hashes. Texts stay where they lie, but
for those a sieve of the documents with hits, then of those with repeats, lets through; they
travel compressed. Hashes of anchors only choose candidates; windows are compared by 96
bits, so among n windows that differ some two are taken for equal with a chance below
n * n / 2 ** 97 (0.003 for the 2e13 words of 100 TB).

A null text has no words; texts of fewer than ``window`` words lose none. Keys are whole
numbers (others are refused). Rows whose key
is null lose none and make no other row lose any. Repeated rows get the same result each;
rows that share a key but not a text are separate documents, neither of which is the
smaller. An empty table gives an empty result. Extra columns stay in ``remove_repeats``,
and ``digests`` leaves them out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knockwork.llm.scratch import Scratch, by_bucket
from knockwork.llm.sieve import Sieve, free
from knockwork.llm.textscan import U, Words, blocks, released, released_group, rolling, scan, xxh64

#: Fixed value of the contract: words of a window.
WINDOW = 50

#: Entries that a task holds at once on the far side of a shuffle.
BUCKET_ENTRIES = 1 << 21
#: Bytes of an anchor's hash that are sent, besides those its bucket tells.
ANCHOR_BYTES = 4
#: Bytes of text whose windows are collapsed at once, and windows that a task remembers from block to block.
BLOCK, REMEMBERED = 1 << 20, 1 << 16

_BASE, _BASE2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_SENT = "bucket long, hashes binary, docs binary, tags binary, places binary"
_NAMES = ["bucket", "hashes", "docs", "tags", "places"]


def _pack(x: np.ndarray, size: int) -> bytes:
    """Integers of ``size`` bytes, plane by plane: small differences compress well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _unpack(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.view("<u8").ravel().astype(U)


def _pack_steps(x: np.ndarray) -> bytes:
    return _pack(np.diff(x.astype(np.int64), prepend=0).view(U), 8)


def _unpack_steps(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, 8).view(np.int64))


def _bucket_bits(entries: int) -> int:
    return max(8, (max(entries, 1) // BUCKET_ENTRIES).bit_length())


def _send(bucket: np.ndarray, doc: np.ndarray, tag: np.ndarray, place: np.ndarray, hashes: tuple[tuple[np.ndarray, int], ...] = ()) -> pa.RecordBatch:
    """A row for each bucket, its entries in the order given."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1)) if len(bucket) else np.zeros(0, int)
    parts = np.split(order, edges[1:]) if len(order) else []
    return pa.record_batch(
        [
            pa.array(bucket[edges], pa.int64()),
            pa.array([b"".join(_pack(h[p], size) for h, size in hashes) for p in parts], pa.binary()),
            *(pa.array([_pack_steps(x[p]) for p in parts], pa.binary()) for x in (doc, tag, place)),
        ],
        _NAMES,
    )


def _received(table: pa.Table, sizes: tuple[int, ...] = ()) -> list[np.ndarray]:
    """doc, tag, place and the hashes of all rows of a bucket."""
    columns = [np.concatenate([_unpack_steps(x) for x in table.column(c).to_pylist()]) for c in ("docs", "tags", "places")]
    raw, n = table.column("hashes").to_pylist(), sum(sizes)
    for before, size in zip(np.cumsum((0, *sizes)).tolist(), sizes, strict=False):
        columns.append(np.concatenate([_unpack(x[len(x) // n * before : len(x) // n * (before + size)], size) for x in raw]))
    return columns


def _home(doc: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of a document, below zero to tell it from those of hashes."""
    with np.errstate(over="ignore"):
        return -1 - ((doc.view(U) * U(_BASE)) >> U(64 - bits)).astype(np.int64)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts of groups, group of each) of equal keys."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _runs_of(table: pa.Table) -> pa.Table:
    """A row for each document of a home bucket: its places as (first, last) of runs."""
    doc, tag, place = _received(table)
    order = np.lexsort((place, tag, doc))
    doc, tag, place = doc[order], tag[order], place[order]
    other = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    new = np.flatnonzero(np.concatenate(([True], other | (place[1:] > place[:-1] + 1))))
    runs = np.stack((place[new], place[np.append(new[1:], len(place)) - 1]), 1)
    edge = np.flatnonzero(np.concatenate(([True], (doc[new][1:] != doc[new][:-1]) | (tag[new][1:] != tag[new][:-1]))))
    return pa.table(
        [pa.array(doc[new][edge]), pa.array(tag[new][edge]), pa.array([x.tobytes() for x in np.split(runs, edge[1:])], pa.binary())],
        ["doc", "tag", "runs"],
    )


class Recent:
    """Windows that a task has met in several documents, each with a number; it forgets all when there are too many."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.h, self.more, self.value = most, np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64)

    def look(self, h: np.ndarray, more: np.ndarray, none: int) -> np.ndarray:
        """The number of each window, ``none`` for those that aren't known."""
        if not len(self.h):
            return np.full(len(h), none)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where((self.h[at] == h) & (self.more[at] == more), self.value[at], none)

    def meet(self, h: np.ndarray, more: np.ndarray, value: np.ndarray) -> None:
        """Remember windows, those known already with their new numbers."""
        if len(self.h) + len(h) > self.most:
            self.h, self.more, self.value = self.h[:0], self.more[:0], self.value[:0]
        h, more, value = (np.concatenate(x) for x in ((h[: self.most], self.h), (more[: self.most], self.more), (value[: self.most], self.value)))
        self.h, first = np.unique(h, return_index=True)  # the new ones come first; of windows with one hash, one is known
        self.more, self.value = more[first], value[first]


def _row_blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Columns doc, tag, text first: rows of about ``size`` bytes of text with their words."""
    for batch in batches:
        for a, b in blocks(np.asarray(pc.fill_null(pc.binary_length(batch.column(2)), 0)), size):
            part = batch.slice(a, b - a)
            yield part, scan(part.column(2))


def _word_hashes(words: Words) -> np.ndarray:
    return xxh64(words.data, words.start, words.end - words.start)


def _windows(words: Words, n: int) -> np.ndarray:
    """Positions in the block at which a window of n words of one text starts."""
    left = np.repeat(words.first[1:], words.counts()) - np.arange(len(words.start))
    return np.flatnonzero(left >= n)


def _packed(rows: DataFrame, columns: str) -> DataFrame:
    """(columns, z): the text, last of the columns of ``rows``, compressed; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            z = [None if t is None else squeeze(t) for t in batch.columns[-1].cast(pa.large_binary()).to_pylist()]
            yield pa.record_batch([*batch.columns[:-1], pa.array(z, pa.binary())], [*(c.split()[0] for c in columns.split(", ")), "z"])

    return rows.mapInArrow(run, f"{columns}, z binary")


def _unpacked(column: pa.Array) -> pa.Array:
    widen = zstandard.ZstdDecompressor().decompress
    return pa.array([None if z is None else widen(z) for z in column.to_pylist()], pa.large_binary()).cast(pa.large_string())


def _opened(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches of about BLOCK bytes whose column ``at`` is text again."""
    for batch in batches:
        for a, b in blocks(np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0)), BLOCK // 4):
            part = batch.slice(a, b - a)
            yield part.set_column(at, "t", _unpacked(part.column(at)))


def repeats(docs: DataFrame, scratch: Scratch, text: str = "text", key: str = "doc_id", window: int = WINDOW, block_bytes: int = BLOCK, remembered: int = REMEMBERED) -> DataFrame:
    """(doc, tag, runs): of each document that has any, the runs of windows that also start in a document with a smaller key.

    ``tag`` is xxhash64 of the text; ``runs`` holds (first, last) window starts as pairs of int64.
    """
    size = (window + 1) // 2
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be a whole number, as the smaller one keeps a passage")
    given = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("tag"), F.col(text).alias("t"))
    total = given.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    bits = _bucket_bits(total // 6)

    @released
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = Recent(remembered)
        for part, words in _row_blocks(batches, block_bytes):
            ids, row = np.asarray(part.column(0)), words.text_of()
            at = _windows(words, size)
            if not len(at):
                continue
            h = rolling(_word_hashes(words), size, _BASE)[at]
            doc, place = ids[row[at]], at - words.first[row[at]]
            block = place % size == 0
            order, new, group = _groups(h)
            low, high = np.minimum.reduceat(doc[order], new), np.maximum.reduceat(doc[order], new)
            blocked = np.logical_or.reduceat(block[order], new)
            known = recent.look(h[order[new]], h[order[new]], -1)  # 0, or 1 where a reference block of the task is sent
            several = (low != high) | (known >= 0)
            shared = np.empty(len(at), bool)
            shared[order] = several[group]
            yield _send(_home(doc[shared], bits), doc[shared], doc[shared] * 0, place[shared])
            # Of what several documents share one entry goes on, which waits for no answer, and none if it would say nothing new.
            recent.meet(h[order[new[several]]], h[order[new[several]]], np.maximum(known, blocked)[several])
            fresh = several & (blocked > known)
            first, blocked = order[new[fresh]], blocked[fresh]
            alone = np.flatnonzero(~shared)
            send = np.concatenate((alone, first))
            code = np.concatenate((place[alone] * 4 + block[alone] * 2, place[first] * 4 + blocked * 2 + 1))
            order = np.argsort(send, kind="stable")
            send, code = send[order], code[order]
            yield _send((h[send] >> U(64 - bits)).astype(np.int64), doc[send], doc[send] * 0, code, ((h[send], ANCHOR_BYTES),))

    @released_group
    def answer(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table
        doc, _, code, h = _received(table, (ANCHOR_BYTES,))
        order, new, group = _groups(h)
        doc, code = doc[order], code[order]
        several = (np.minimum.reduceat(doc, new) != np.maximum.reduceat(doc, new)) | (np.maximum.reduceat(code & 1, new) > 0)
        hit = (several & (np.maximum.reduceat(code & 2, new) > 0))[group] & (code & 1 == 0)
        doc, place = doc[hit], code[hit] >> 2
        order = np.lexsort((place, doc))
        return pa.Table.from_batches([_send(_home(doc[order], bits), doc[order], doc[order] * 0, place[order])])

    sent = given.mapInArrow(probe, _SENT)
    hits = scratch.keep(_by_document(sent, answer, bits), "hits")

    @released
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = Recent(remembered)
        for part, words in _row_blocks(_opened(batches, 2), block_bytes):
            ids, tags = np.asarray(part.column(0)), np.asarray(part.column(1))
            over = np.zeros(len(words.start) + 1, np.int64)
            for d, raw in enumerate(part.column(3).to_pylist()):
                runs = np.frombuffer(raw, np.int64).reshape(-1, 2)
                n = words.first[d + 1] - words.first[d]
                runs = runs[runs[:, 0] < n]
                np.add.at(over, words.first[d] + np.maximum(runs[:, 0] - (window - size), 0), 1)
                np.add.at(over, words.first[d] + np.minimum(runs[:, 1] + 1, n), -1)
            at = _windows(words, window)
            at = at[np.cumsum(over)[at] > 0]
            if not len(at):
                continue
            row = words.text_of()[at]
            one = _word_hashes(words)
            h, more = rolling(one, window, _BASE2)[at], rolling(one, window, _BASE)[at] >> U(32)
            doc, tag, place = ids[row], tags[row], at - words.first[row]
            order, new, group = _groups(h, more)
            one_of, low = order[new], np.minimum.reduceat(doc[order], new)
            before = recent.look(h[one_of], more[one_of], np.iinfo(np.int64).max)  # the smallest document that the task has sent
            several = (low != np.maximum.reduceat(doc[order], new)) | (before < np.iinfo(np.int64).max)
            low = np.minimum(low, before)
            recent.meet(h[one_of][several], more[one_of][several], low[several])
            least = np.empty(len(at), np.int64)
            least[order] = low[group]
            gone = doc > least
            yield _send(_home(doc[gone], bits), doc[gone], tag[gone], place[gone])
            wait = ~gone
            yield _send((h[wait] >> U(64 - bits)).astype(np.int64), doc[wait], tag[wait], place[wait], ((h[wait], 8), (more[wait], 4)))

    @released_group
    def compare(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table
        doc, tag, place, h, more = _received(table, (8, 4))
        order, new, group = _groups(h, more)
        doc, tag, place = doc[order], tag[order], place[order]
        gone = doc > np.minimum.reduceat(doc, new)[group]
        doc, tag, place = doc[gone], tag[gone], place[gone]
        order = np.lexsort((place, tag, doc))
        return pa.Table.from_batches([_send(_home(doc[order], bits), doc[order], tag[order], place[order])])

    maybe, _ = Sieve(hits, F.xxhash64("doc"), scratch).split(given, F.xxhash64("doc"))
    moved = _packed(maybe, "doc long, tag long").join(hits.select("doc", F.col("runs").alias("hits")), "doc")
    found = moved.select("doc", "tag", "z", "hits").mapInArrow(extend, _SENT)
    out = scratch.keep(_by_document(found, compare, bits), "repeats")
    scratch.drop(hits)
    return out


def _by_document(sent: DataFrame, judge: Callable[[pa.Table], pa.Table], bits: int) -> DataFrame:
    """What the buckets of hashes say of each document, brought home to it."""
    judged = by_bucket(sent, 2 << bits).groupBy("bucket").applyInArrow(judge, _SENT)
    return by_bucket(judged, 1 << bits).groupBy("bucket").applyInArrow(_runs_of, "doc long, tag long, runs binary")


def _kept_parts(words: Words, d: int, raw: bytes | None, window: int) -> tuple[int, int, bytes]:
    """Words of text d, how many go, and the rest joined by one space."""
    a, b = int(words.first[d]), int(words.first[d + 1])
    if a == b:
        return 0, 0, b""
    if raw is None:
        return b - a, 0, words.data[words.start[a] : words.end[b - 1]].tobytes()
    keep = np.ones(b - a, bool)
    for first, last in np.frombuffer(raw, np.int64).reshape(-1, 2).tolist():
        keep[first : last + window] = False
    turn = np.flatnonzero(np.diff(keep, prepend=False, append=False)).reshape(-1, 2) + a
    parts = [words.data[words.start[x] : words.end[y - 1]].tobytes() for x, y in turn.tolist()]
    return b - a, int((~keep).sum()), b" ".join(parts)


def _with_repeats(docs: DataFrame, text: str, key: str, window: int, **sizes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(found, maybe, clean): the repeats (doc, tag, runs) and the rows that may and that surely don't have any."""
    scratch = Scratch(docs.sparkSession, "substr")
    found = repeats(docs, scratch, text, key, window, **sizes)
    maybe, clean = Sieve(found, F.xxhash64("doc", "tag"), scratch).split(docs, F.xxhash64(F.col(key).cast("long"), F.xxhash64(text)))
    return found, maybe, clean


def digests(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, **sizes: int) -> DataFrame:
    """``key``, n_words, n_removed and kept_sha256 of every row."""
    kind = docs.schema[key].dataType.simpleString()
    result = f"k {kind}, n_words long, n_removed long, kept_sha256 string"

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words in _row_blocks(batches):
            rows = [_kept_parts(words, d, raw, window) for d, raw in enumerate(part.column(1).to_pylist())]
            yield pa.record_batch(
                [part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())],
                ["k", "n_words", "n_removed", "kept_sha256"],
            )

    def run_opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(_opened(batches, 2))

    given = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    found, maybe, clean = _with_repeats(given, "t", "k", window, **sizes)
    moved = _packed(maybe.select("k", F.xxhash64("t").alias("tag_"), "t"), f"k {kind}, tag_ long")
    joined = moved.join(found, (F.col("k").cast("long") == F.col("doc")) & (F.col("tag_") == F.col("tag")), "left").select("k", "runs", "z").mapInArrow(run_opened, result)
    out = clean.select("k", F.lit(None).cast("binary").alias("runs"), "t").mapInArrow(run, result)
    return out.unionByName(joined).withColumnRenamed("k", key)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, length: str | None = None) -> DataFrame:
    """All rows and columns; a text that has repeats keeps its other words, joined by one space, and others stay as they are.

    ``length`` names a column of text lengths, which follows the texts that get shorter.
    """
    found, maybe, clean = _with_repeats(docs, text, key, window)

    @F.pandas_udf("string")
    def cut(texts, runs):
        out = []
        for t, raw in zip(texts, runs, strict=True):
            out.append(t if raw is None else _kept_parts(scan(pa.array([t])), 0, raw, window)[2].decode())
        return type(texts)(out, dtype=object)

    doc, tag, runs = (free(f"substr_{x}", docs.columns) for x in ("doc", "tag", "runs"))
    named = found.select(F.col("doc").alias(doc), F.col("tag").alias(tag), F.col("runs").alias(runs))
    joined = maybe.join(named, (F.col(key).cast("long") == F.col(doc)) & (F.xxhash64(text) == F.col(tag)), "left")
    out = joined.withColumn(text, F.when(F.col(runs).isNull(), F.col(text)).otherwise(cut(F.col(text), F.col(runs))))
    if length in docs.columns:
        out = out.withColumn(length, F.when(F.col(runs).isNull(), F.col(length)).otherwise(F.char_length(text).cast(docs.schema[length].dataType)))
    return clean.unionByName(out.select(*docs.columns))
