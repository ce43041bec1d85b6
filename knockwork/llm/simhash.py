"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in three bits meet at one that differs from the
first in one bit and from the second in two. Every distinct fingerprint emits itself and
its 64 variants of one bit (so pairs at distance 1 and 2 meet); those of odd parity also
emit variants of two bits, which the one-bit variants of even ones meet (fingerprints at
an odd distance have different parity). Of three bits, two fall in the same half of the
word, so two-bit variants within either half suffice: 992 instead of 2,016, the fewest
that meet every triple.

Variants are shuffled, those that collide are checked by their distance, and linked
to one another by stars, never by all pairs; components of the links give the groups.

A null or empty text has no words and the fingerprint zero, linked like any other.
Rows of the same fingerprint, copies above all, are one node whatever their number.
Repeated rows keep their number; a null doc_id joins the group of its fingerprint and is
never its smallest. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.llm.components import components
from knockwork.llm.scratch import Scratch, by_bucket
from knockwork.llm.sieve import Sieve, free
from knockwork.llm.textscan import U, blocks, released, released_group, scan, xxh64

#: Fixed values of the contract.
SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64

#: Variants that a task holds at once, on either side of the shuffle.
BUCKET_VARIANTS = 1 << 20

_ONE = [0] + [1 << i for i in range(BITS)]
_HALF = BITS // 2
_TWO = [1 << i | 1 << j for side in (0, _HALF) for i in range(side, side + _HALF) for j in range(i + 1, side + _HALF)]
MASKS = np.array(_ONE + _TWO, U)
NEAR = len(_ONE)
#: Of each byte, its bits as eight bytes.
_SPREAD = np.array([sum((b >> i & 1) << 8 * i for i in range(8)) for b in range(256)], U)


def fingerprints_of(texts: pa.Array) -> np.ndarray:
    """The fingerprint of each text, unsigned."""
    words = scan(texts, lower=True)
    n = words.counts()
    shingles = np.where(n == 0, 0, np.maximum(n - SHINGLE + 1, 1))
    owner = np.repeat(np.arange(len(n)), shingles)
    begin = np.concatenate(([0], np.cumsum(shingles)))
    head = words.first[:-1][owner] + np.arange(len(owner)) - begin[:-1][owner]
    tail = np.minimum(head + SHINGLE, words.first[1:][owner]) - 1
    out = np.zeros(len(n), U)
    if not len(owner):
        return out
    start = words.start[head]
    hashed = xxh64(words.data, start, words.end[tail] - start, SEED)
    # Bits are summed a byte at a time in eight lanes, over at most 255 shingles.
    steps = [np.arange(a, b, 255) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True) if b > a]
    at, text = np.concatenate(steps), np.repeat(np.flatnonzero(n), [len(s) for s in steps])
    sums = np.zeros((len(n), BITS), np.int64)
    lanes = hashed.astype("<u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        part = np.add.reduceat(_SPREAD[lanes[:, k]], at).astype("<u8").view(np.uint8).reshape(-1, 8)
        np.add.at(sums[:, 8 * k : 8 * k + 8], text, part)
    bits = 2 * sums > shingles[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(U)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", also: list[str] | None = None) -> DataFrame:
    """``key``, fingerprint (a signed long of the same bits) and the columns ``also`` (longs) of every row."""
    also = also or []

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for a, b in blocks(np.array(pa.compute.fill_null(pa.compute.binary_length(column), 0))):
                found = fingerprints_of(column.slice(a, b - a)).view(np.int64)
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(found), *(c.slice(a, b - a) for c in batch.columns[2:])], ["k", "fp", *also])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), *also).mapInArrow(run, ", ".join([f"k {kind}, fp long", *(f"{c} long" for c in also)]))
    return out.select(F.col("k").alias(key), "fp", *also)


def links(distinct: DataFrame, count: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join all pairs at distance 3 or less."""
    per_print = NEAR + len(_TWO) // 2
    buckets = max(64, -(-count * per_print // BUCKET_VARIANTS))
    step = BUCKET_VARIANTS // len(MASKS)

    @released
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Variants by bucket: 8 bytes each and the number of the mask that made them."""
        for batch in batches:
            prints = np.asarray(batch.column(0)).view(U)
            for at in range(0, len(prints), step):
                some = prints[at : at + step]
                odd = some[np.bitwise_count(some) % 2 == 1]
                variant = np.concatenate(((some[:, None] ^ MASKS[:NEAR]).ravel(), (odd[:, None] ^ MASKS[NEAR:]).ravel()))
                mask = np.concatenate((np.tile(np.arange(NEAR, dtype=np.uint16), len(some)), np.tile(np.arange(NEAR, len(MASKS), dtype=np.uint16), len(odd))))
                bucket = _bucket(variant, buckets)
                order = np.argsort(bucket, kind="stable")
                bucket, variant, mask = bucket[order], variant[order], mask[order]
                edge = np.flatnonzero(np.diff(bucket, prepend=-1))
                yield pa.record_batch(
                    [pa.array(bucket[edge]), pa.array([x.tobytes() for x in np.split(variant, edge[1:])], pa.binary()), pa.array([x.tobytes() for x in np.split(mask, edge[1:])], pa.binary())],
                    ["bucket", "variants", "masks"],
                )

    @released_group
    def meet(table: pa.Table) -> pa.Table:
        """A star for every variant that two fingerprints share, around one at distance 0 or 1 from it."""
        variant = np.concatenate([np.frombuffer(x, U) for x in table.column("variants").to_pylist()])
        mask = np.concatenate([np.frombuffer(x, np.uint16) for x in table.column("masks").to_pylist()])
        order = np.lexsort((mask, variant))
        variant, mask = variant[order], mask[order]
        new = np.flatnonzero(np.concatenate(([True], variant[1:] != variant[:-1])))
        size = np.diff(np.append(new, len(variant)))
        shared = np.flatnonzero((size > 1) & (mask[new] < NEAR))
        member = np.repeat(shared, size[shared])
        at = np.concatenate([np.arange(a, a + s) for a, s in zip(new[shared].tolist(), size[shared].tolist(), strict=True)]) if len(shared) else np.zeros(0, int)
        other, centre = variant[at] ^ MASKS[mask[at]], variant[new[member]] ^ MASKS[mask[new[member]]]
        near = (other != centre) & (np.bitwise_count(other ^ centre) <= RADIUS)
        pairs = np.unique(np.stack((np.minimum(other, centre)[near], np.maximum(other, centre)[near]), 1), axis=0)
        return pa.table([pa.array(pairs[:, 0].view(np.int64) if len(pairs) else [], pa.int64()), pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64) if len(pairs) else [], pa.int64())], ["a", "b"])

    tasks = max(1, count * per_print // (4 * BUCKET_VARIANTS))
    emitted = distinct.select("fp").repartition(tasks, "fp").mapInArrow(emit, "bucket long, variants binary, masks binary")
    return by_bucket(emitted, buckets).groupBy("bucket").applyInArrow(meet, "a long, b long")


def _bucket(variant: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((variant * U(0x9E3779B97F4A7C15)) >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _grouped(prints: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(fp, least, root) of every fingerprint: its smallest ``key`` and the root of its group."""
    nodes = scratch.keep(prints.groupBy("fp").agg(F.min(key).alias("least")), "nodes")
    found = scratch.keep(links(nodes, nodes.count()), "links")
    roots = components(found, scratch)
    scratch.drop(found)
    return nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, fingerprint (16 hex digits) and component_id (the smallest ``key`` of its group) of every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.keep(fingerprints(docs, text, key), "prints")
    grouped = _grouped(prints, key, scratch)
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = scratch.keep(grouped.join(smallest, "root").select("fp", "component_id"), "groups")
    return prints.join(of_print, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group, with all its columns: that of the smallest ``key`` (null is the last), fingerprint and text hash.

    Rows of the same key and text count as one. A row is named by its key and the hash of its
    text; only rows that a sieve of the names that go lets through are moved.
    """
    scratch = Scratch(docs.sparkSession, "simhash-each")
    name = free("simhash_name", docs.columns)
    prints = scratch.keep(fingerprints(docs.withColumn(name, F.xxhash64(text)), text, key, [name]).withColumnsRenamed({name: "h", key: "k"}), "prints")
    grouped = _grouped(prints, "k", scratch)
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("m")
    chosen = grouped.groupBy("root").agg(first).select(F.col("m.fp").alias("fp_"), F.col("m.least").alias("k_"))
    rows = scratch.keep(prints.groupBy("k", "h", "fp").agg(F.count("*").alias("copies")), "rows")
    ours = rows.join(chosen, F.col("k").eqNullSafe(F.col("k_")) & (F.col("fp") == F.col("fp_")))
    stays = ours.groupBy("fp").agg(F.min("h").alias("h_"), F.first("k").alias("k_")).select("h_", "k_", F.lit(True).alias("s_"))
    judged = rows.join(stays, F.col("k").eqNullSafe(F.col("k_")) & (F.col("h") == F.col("h_")), "left").select("k", "h", "copies", F.coalesce("s_", F.lit(False)).alias("stays"))
    changed = scratch.keep(judged.filter("not stays or copies > 1").select(F.col("k").alias("k_"), F.col("h").alias("h_"), F.col("stays").alias("s_")), "changed")
    scratch.drop(prints, rows)
    maybe, out = Sieve(changed, F.xxhash64("k_", "h_"), scratch).split(docs, F.xxhash64(F.col(key), F.xxhash64(text)))
    columns = [f"c{i}" for i in range(len(docs.columns))]  # no clash with the names above
    k, t = (F.col(columns[docs.columns.index(c)]) for c in (key, text))
    maybe = maybe.toDF(*columns).withColumn("n_", F.xxhash64(t))
    told = maybe.join(changed, k.eqNullSafe(F.col("k_")) & (F.col("n_") == F.col("h_")), "left")
    out = out.unionByName(told.filter("s_ is null").select(*columns).toDF(*docs.columns))
    if changed.filter("s_").take(1):
        out = out.unionByName(told.filter("s_").dropDuplicates([columns[docs.columns.index(key)], "n_"]).select(*columns).toDF(*docs.columns))
    return out
