"""WARC fixity: Merkle trees over records and their offset ranges, compared between replicas.

A leaf is the hash of a record together with the range of bytes it fills; an inner node hashes the
nodes below it in order. Replicas whose roots agree are the same; where they differ, only
nodes under a differing node are compared, level by level, down to the damaged records.

A record whose length has changed moves those behind it: their leaves differ by offsets, and only
``compare_archives``, which looks at the differing leaves of both replicas, tells moved records from damaged ones.

Files (segments) are trees of their own below a common root, so hashing a file needs only
its own records, and no task holds more than one node's children. Records that repeat in
number, offset and content are one. A null payload is an empty one; records without a key share a
file for each of 4,096 hashes of their content; a record that only one
replica has is damaged, as is each of several that claim the same place. Empty tables
have no segments. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from knockwork.llm.scratch import Scratch

#: Children of a node, and pages of a file in ``archive``.
FANOUT = 16
SEGMENT = 1024


def record(url: Column, payload: Column, number: Column) -> Column:
    """The bytes of a WARC response record, as text."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:"), F.coalesce(number.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", segment: int = SEGMENT) -> DataFrame:
    """(segment, record_no, key, offset, n_bytes, sha256): pages as records of WARC files, ``segment`` keys to a file, in key order."""
    written = record(F.col(url), F.col(payload), F.col(key))
    rows = pages.select(F.coalesce(F.floor(F.col(key) / segment), -1 - F.pmod(F.xxhash64(written), F.lit(4096))).cast("long").alias("segment"), F.col(key).alias("key"), F.octet_length(written).cast("long").alias("n_bytes"), F.sha2(written, 256).alias("sha256")).distinct()
    order = W.partitionBy("segment").orderBy("key", "sha256")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    return rows.select(
        "segment", (F.row_number().over(order) - 1).cast("long").alias("record_no"), "key",
        F.coalesce(F.sum("n_bytes").over(before), F.lit(0).cast("long")).alias("offset"), "n_bytes", "sha256",
    )


_HEAD = re.compile(rb"WARC/\d\.\d\r\n(.*?)\r\n\r\n", re.S)
_RECORDS = "segment string, record_no long, key string, offset long, n_bytes long, sha256 string"


def _records_of(name: str, data: bytes) -> Iterator[tuple]:
    number, at = 0, 0
    while head := _HEAD.match(data, at):
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head[1].split(b"\r\n"))}
        past = head.end() + int(fields.get(b"content-length", b"0")) + 4
        yield name, number, fields.get(b"warc-record-id", b"").decode("utf-8", "replace"), at, past - at, hashlib.sha256(data[at:past]).hexdigest()
        number, at = number + 1, past


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(segment, record_no, key, offset, n_bytes, sha256) of plain WARC files; segment is a file's path, key a record's id."""
    names = [c.split()[0] for c in _RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if rows := list(_records_of(name, data)):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _RECORDS)


def depth(*replicas: DataFrame, fanout: int = FANOUT) -> int:
    """Levels above the leaves until each segment of every replica has one node."""
    most = max((r.agg(F.max("record_no")).first()[0] or 0) for r in replicas)
    levels = 0
    while most:
        most, levels = most // fanout, levels + 1
    return levels


def tree(records: DataFrame, scratch: Scratch, levels: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels (segment, node, first, past, hash) from the leaves to one node for each segment; first and past bound a node's bytes."""
    leaf = F.sha2(F.concat_ws("|", F.lit("leaf"), "sha256", "offset", "n_bytes"), 256)
    one = records.select("segment", F.col("record_no").alias("node"), F.col("offset").alias("first"), (F.col("offset") + F.col("n_bytes")).alias("past"), leaf.alias("hash")).distinct()
    span = (F.min("first").alias("first"), F.max("past").alias("past"))
    # Several records that claim one place make one leaf of all of them.
    out = [scratch.keep(one.groupBy("segment", "node").agg(*span, F.array_join(F.array_sort(F.collect_set("hash")), "+").alias("hash")), "leaves")]
    kids = F.array_sort(F.collect_list(F.struct("node", "hash")))
    inner = F.sha2(F.concat_ws("|", F.lit("node"), F.transform(kids, lambda k: k["hash"])), 256)
    for _ in range(levels):
        up = out[-1].withColumn("up", F.expr(f"node div {fanout}"))
        out.append(scratch.keep(up.groupBy("segment", F.col("up").alias("node")).agg(*span, inner.alias("hash")), "level"))
    return out


def root(levels: list[DataFrame]) -> str:
    """One hash of all segments, by way of 4,096 parts of them."""
    said = F.array_sort(F.collect_list(F.struct("part", "hash")))
    parts = levels[-1].select(F.concat_ws("|", "segment", "node").alias("part"), "hash").groupBy(F.pmod(F.xxhash64("part"), F.lit(4096)).alias("bucket")).agg(F.sha2(F.to_json(said), 256).alias("hash"))
    whole = F.array_sort(F.collect_list(F.struct("bucket", "hash")))
    return parts.agg(F.sha2(F.to_json(whole), 256)).first()[0]


def audit(first: list[DataFrame], second: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(segment, record_no, first, past, in_first, in_second) of the leaves in which two trees of equal depth differ."""

    def compare(a: DataFrame, b: DataFrame) -> DataFrame:
        a = a.select("segment", "node", F.col("first").alias("f1"), F.col("past").alias("p1"), F.col("hash").alias("h1"))
        b = b.select("segment", "node", F.col("first").alias("f2"), F.col("past").alias("p2"), F.col("hash").alias("h2"))
        return a.join(b, ["segment", "node"], "full").filter(~F.col("h1").eqNullSafe(F.col("h2")))

    if root(first) == root(second):
        differ = compare(first[0].limit(0), second[0].limit(0))
    else:
        differ = compare(first[-1], second[-1])
        for a, b in zip(first[-2::-1], second[-2::-1], strict=True):
            above = differ.select(F.col("segment").alias("s"), F.col("node").alias("n"))

            def below(level: DataFrame, above: DataFrame = above) -> DataFrame:
                return level.join(above, (level.segment == above.s) & (F.expr(f"node div {fanout}") == above.n), "left_semi")

            differ = compare(below(a), below(b))
    return differ.select("segment", F.col("node").alias("record_no"), F.least("f1", "f2").alias("first"), F.greatest("p1", "p2").alias("past"), F.col("h1").isNotNull().alias("in_first"), F.col("h2").isNotNull().alias("in_second"))


def compare_archives(first: DataFrame, second: DataFrame) -> DataFrame:
    """The records of ``first`` with damaged and moved.

    A record whose place ``second`` fills otherwise is moved if another differing leaf of its file there has its
    key and content, else damaged.
    """
    scratch = Scratch(first.sparkSession, "fixity")
    first, second = scratch.keep(first, "first"), scratch.keep(second, "second")
    levels = depth(first, second)
    found = scratch.keep(audit(tree(first, scratch, levels), tree(second, scratch, levels)).select("segment", "record_no"), "differing")
    there = second.join(found, ["segment", "record_no"], "left_semi").select("segment", "key", "sha256").distinct().withColumn("moved", F.lit(True))
    of_first = first.join(found, ["segment", "record_no"], "left_semi")
    same = of_first.segment.eqNullSafe(there.segment) & of_first.key.eqNullSafe(there.key) & (of_first.sha256 == there.sha256)
    told = of_first.join(there, same, "left").select(of_first.segment, "record_no", F.coalesce("moved", F.lit(False)).alias("moved")).distinct()
    out = first.join(told, ["segment", "record_no"], "left")
    return out.withColumns({"damaged": F.coalesce(~F.col("moved"), F.lit(False)), "moved": F.coalesce("moved", F.lit(False))})
