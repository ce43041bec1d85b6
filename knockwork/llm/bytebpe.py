"""Byte-level BPE encoding and decoding by a rank file, text by text in overlapping chunks.

Every text is cut into chunks. Pre-tokens of a chunk are found without regard to its
neighbours; from the first boundary on that two overlapping chunks share, both see the same
pre-tokens, so they are stitched there. Where an overlap has no such boundary (a run of letters
longer than it), what is left from the last sure boundary on is cut again into larger chunks.
The stitched pieces are then encoded; decoding concatenates the raw bytes of the ids.

The chunks of a text lie together in its row and are stitched there. Those of texts of more
than ``SPREAD`` chunks are dealt out: each is pre-tokenised by itself, only boundaries in
overlaps meet by document, and every chunk's pieces are encoded where the chunk lies. From an
overlap without a shared boundary on, the rest of such a text is one piece.

A null text encodes as empty: no ids, and the hashes of nothing. Repeated rows give a
row each, an empty table none, and extra columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.llm import vocab
from knockwork.llm.merging import merge, uncollected
from knockwork.llm.textscan import blocks, kept, released

#: Characters of a chunk and of its overlap with the next; chunks of a text from which on they are dealt out.
CHUNK, OVERLAP, SPREAD = 1 << 12, 1 << 8, 64
#: Characters at a chunk's end in which a match may still change: the longest contraction.
MARGIN = 4
#: Units that a worker remembers as met of late, and as many met before; characters of the longest of them.
MEMO, MEMO_CHARS = 400_000, 64
#: Bytes of text whose units are met together, and what stands for no token.
BLOCK, NONE = 2 << 20, 1 << 62

#: White space as Unicode has it, and the runs that a pattern in which no pre-token holds
#: white space after its first character never cuts across. Found faster than pre-tokens.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


class Codec(dict):
    """Decimal ids, joined by a space, by unit, filled as units are met.

    A unit is a pre-token or, where ``runs`` is given, a string that holds whole pre-tokens
    whatever stands around it; what ``runs`` finds must be so for the pattern at hand. Of what
    was met before the last ``memo`` units, only those that were met again are remembered.
    """

    def __init__(self, data: bytes, pattern: str, runs: str | None = None, memo: int = MEMO):
        super().__init__()
        self.memo = memo
        self.ranks = vocab.ranks(data)
        self.said = {b: str(i).encode() for b, i in self.ranks.items()}
        self.raw = {said: b for b, said in self.said.items()}
        self.pairs = Pairs(self.ranks)
        self.pattern = regex.compile(pattern)
        self.units = re.compile(runs).findall if runs else self.pattern.findall
        self.before: dict = {}

    def __missing__(self, unit: str) -> bytes:
        out = self.before.get(unit)
        if out is None:
            out = b" ".join(map(self.piece, self.pattern.findall(unit)))
        self._remember(unit, out)
        return out

    def _remember(self, unit: str, out: bytes) -> None:
        if len(unit) <= MEMO_CHARS:
            if len(self) >= self.memo:
                self.before = dict(self)
                self.clear()
            self[unit] = out

    def meet(self, units: Iterable[str]) -> None:
        """Encode together, piece by piece, what isn't remembered of some units."""
        units = set(units)
        if len(self) > self.memo:
            self.before = dict(self)
            self.clear()
        lacking = units.difference(self)
        again = lacking.intersection(self.before)
        self.update(zip(again, map(self.before.__getitem__, again), strict=True))
        new = [u for u in lacking.difference(again) if len(u) <= MEMO_CHARS]
        split = list(map(self.pattern.findall, new))
        words = list(set(chain.from_iterable(split)))
        raws = [w.encode() for w in words]
        known = self.said
        told = {w: known[r] for w, r in zip(words, raws, strict=True) if r in known}
        rest = [(w, r) for w, r in zip(words, raws, strict=True) if r not in known]
        told |= zip((w for w, _ in rest), self.pairs.merged([r for _, r in rest]), strict=True)
        for unit, pieces_ in zip(new, split, strict=True):
            self[unit] = b" ".join(map(told.__getitem__, pieces_))

    def rank(self, a: bytes, b: bytes) -> tuple[int, bytes] | None:
        r = self.ranks.get(a + b)
        return None if r is None else (r, a + b)

    def piece(self, piece: str) -> bytes:
        raw = piece.encode()
        if raw in self.said:
            return self.said[raw]
        return b" ".join(map(self.said.__getitem__, merge([raw[i : i + 1] for i in range(len(raw))], self.rank)))

    def written(self, units: Sequence[str]) -> bytes:
        """The decimal ids of all units, joined by a space."""
        return b" ".join(map(self.__getitem__, units))

    def encode(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        return list(map(int, self.written(pieces(text, self.units, chunk, overlap)).split()))

    def decode(self, said: bytes) -> bytes:
        """The bytes of decimal ids joined by a space, one after another."""
        return b"".join(map(self.raw.__getitem__, said.split()))

    def ends(self, text: str) -> list[int]:
        return [m.end() for m in self.pattern.finditer(text)]


class Pairs:
    """Which two tokens make a third, for merging many pre-tokens at once in numpy."""

    def __init__(self, ranks: dict[bytes, int]):
        made = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    made[a << 32 | b] = rank
        keys = np.fromiter(made, np.int64, len(made))
        order = np.argsort(keys)
        self.keys, self.made = np.append(keys[order], -1), np.append(np.fromiter(made.values(), np.int64, len(made))[order], NONE)
        self.bytes = np.array([ranks.get(bytes([b]), NONE) for b in range(256)])
        self.two = np.array([ranks.get(bytes([a, b]), NONE) for a in range(256) for b in range(256)])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of each pair, the token that it makes, which is also its rank; NONE where it makes none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys[:-1], key)
        return np.where(self.keys[at] == key, self.made[at], NONE)

    def merged(self, raws: Sequence[bytes]) -> list[bytes]:
        """Decimal ids of each: its adjacent pair of lowest rank, leftmost first, merges again and again, in all of them at once."""
        out = [b""] * len(raws)
        if not raws:
            return out
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        data = np.frombuffer(b"".join(raws), np.uint8).astype(np.int64)
        token, owner = self.bytes[data], np.repeat(np.arange(len(raws)), size)
        rank = np.full(len(token), NONE)
        rank[:-1] = np.where(owner[1:] == owner[:-1], self.two[data[:-1] << 8 | data[1:]], NONE)
        while len(token):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            low = np.minimum.reduceat(rank, first)
            ended = np.repeat(low == NONE, np.diff(np.append(first, len(owner))))
            if ended.any():
                ids, of = token[ended], owner[ended]
                begin = np.flatnonzero(np.diff(of, prepend=-1))
                said = list(map(str, ids.tolist()))
                for i, a, b in zip(of[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(ids)], strict=True):
                    out[i] = " ".join(said[a:b]).encode()
                token, owner, rank, low = token[~ended], owner[~ended], rank[~ended], low[low != NONE]
                if not len(token):
                    break
                first = np.flatnonzero(np.diff(owner, prepend=-1))
            at = np.flatnonzero(rank == np.repeat(low, np.diff(np.append(first, len(owner)))))
            at = at[np.diff(owner[at], prepend=-1) != 0]  # the leftmost of each
            token[at] = rank[at]
            keep = np.ones(len(token), bool)
            keep[at + 1] = False
            token, owner, rank = token[keep], owner[keep], rank[keep]
            at = at - np.arange(len(at))  # one token is gone before each of the next ones
            for place in (at, at[at > 0] - 1):
                follows = place + 1 < len(token)
                follows[follows] = owner[place[follows]] == owner[place[follows] + 1]
                pair = place[follows]
                rank[place[~follows]] = NONE
                rank[pair] = self.rank(token[pair], token[pair + 1])
        return out


def cut(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """(start, text) of each chunk; all but the last reach into the next one's first ``overlap`` characters."""
    starts = range(0, max(1, len(text)), chunk)
    return [(s, text[s : s + chunk + overlap]) for s in starts]


def meet(tail: Sequence[int], head: Sequence[int]) -> int | None:
    """The first place that both have, of boundaries in an overlap as each of two neighbours sees them; both in ascending order."""
    if tail and head and tail[0] == head[0]:
        return tail[0]
    common = set(head).intersection(tail)
    return min(common) if common else None


def overlaps(ends: Sequence[int], size: int, last: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries of a chunk in its first ``overlap`` characters, and those in the next one's, from where that one starts.

    A chunk's start is a boundary to itself; ends so near its end that more text might move them are none.
    """
    head = [0, *ends[: bisect_right(ends, overlap)]]
    if last:
        return head, []
    a, b = bisect_left(ends, chunk), bisect_right(ends, size - MARGIN)
    return head, [e - chunk for e in ends[a:b]]


def pieces(text: str, units: Callable[[str], list[str]], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """The units of the whole text, from those of its chunks."""
    out: list[str] = []
    at = 0  # a boundary of the whole text
    while at < len(text):
        rest = text[at:] if at else text
        found = [units(part) for _, part in cut(rest, chunk, overlap)]
        begin, k = 0, 0  # unit of chunk k that the next piece is
        ends = list(accumulate(map(len, found[0]))) if len(found) > 1 else []
        while k + 1 < len(found):
            size = min(chunk + overlap, len(rest) - k * chunk)
            following = list(accumulate(map(len, found[k + 1])))
            _, tail = overlaps(ends, size, False, chunk, overlap)
            head, _ = overlaps(following, 0, True, chunk, overlap)
            if size < chunk + overlap:  # the chunk reaches the text's end, where no end can move
                tail = [e - chunk for e in ends[bisect_left(ends, chunk) :]]
            place = meet([e for e in tail if e + chunk >= (ends[begin - 1] if begin else 0)], head)
            if place is None:
                break
            stop = bisect_right(ends, place + chunk)
            out += found[k][begin:stop]
            begin, k, ends = bisect_right(following, place), k + 1, following
        if k + 1 == len(found):
            return out + found[k][begin:]
        # No boundary in common: go on from the last one that is sure, by larger chunks.
        at += k * chunk + (ends[begin - 1] if begin else 0)
        chunk, overlap = 4 * chunk, 4 * max(overlap, 1)
    return out


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", key: str = "doc_id", *, runs: str | None = None) -> DataFrame:
    """``key`` and ids (array of int) of every row."""
    data = docs.sparkSession.sparkContext.broadcast(vocab.read(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(data.value, pattern, runs)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([codec.encode(t or "") for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))], ["k", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key`` and raw (binary) of every row: the bytes of its ids, one after another; null ids are none."""
    data = rows.sparkSession.sparkContext.broadcast(vocab.read(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = {i: b for b, i in vocab.ranks(data.value).items()}
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([b"".join(map(raw.__getitem__, x or ())) for x in batch.column(1).to_pylist()], pa.binary())], ["k", "raw"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("k"), F.col(ids).alias("i")).mapInArrow(run, f"k {kind}, raw binary").withColumnRenamed("k", key)


def _digest(said: bytes, raw: bytes) -> tuple[int, str, str]:
    return said.count(b" ") + bool(said), hashlib.sha256(said).hexdigest(), hashlib.sha256(raw).hexdigest()


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", key: str = "doc_id", *, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD, runs: str | None = None, memo: int = MEMO) -> DataFrame:
    """``key``, n_tokens, ids_sha256 and decoded_sha256 of every row; a worker remembers ``memo`` units of late and as many before."""
    data = docs.sparkSession.sparkContext.broadcast(vocab.read(vocabulary))
    kind = docs.schema[key].dataType.simpleString()
    columns = ["k", "n_tokens", "ids_sha256", "decoded_sha256"]
    whole = f"k {kind}, sha string, copies long"

    @released
    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with uncollected(), kept(("codec", data.value, pattern, runs, memo), lambda: Codec(data.value, pattern, runs, memo)) as codec:
            for batch in batches:
                found = []
                for a, b in blocks(np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0)), BLOCK):
                    units = [pieces(t, codec.units, chunk, overlap) if t else [] for t in batch.column(1).slice(a, b - a).to_pylist()]
                    codec.meet(chain.from_iterable(units))
                    found += [_digest(said, codec.decode(said)) for said in map(codec.written, units)]
                n, ids, raw = zip(*found, strict=True) if found else ((), (), ())
                yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())], columns)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column(3).to_pylist()):
                parts = cut(t, chunk, overlap)
                for at in range(0, len(parts), 256):
                    some = parts[at : at + 256]
                    again = pa.array(np.full(len(some), i))
                    yield pa.record_batch(
                        [*(batch.column(c).take(again) for c in range(3)), pa.array([s // chunk for s, _ in some], pa.int64()), pa.array([len(parts)] * len(some), pa.int64()), pa.array([p for _, p in some], pa.string())],
                        ["k", "sha", "copies", "no", "parts", "part"],
                    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(data.value, pattern, runs)
        for batch in batches:
            heads, tails = [], []
            for no, n, part in zip(*(batch.column(c).to_pylist() for c in (3, 4, 5)), strict=True):
                ends = list(accumulate(map(len, codec.units(part))))
                head, tail = overlaps(ends, len(part) + MARGIN * (len(part) < chunk + overlap), no + 1 == n, chunk, overlap)
                heads.append(np.array(head, np.int32).tobytes())
                tails.append(np.array(tail, np.int32).tobytes())
            yield pa.record_batch([*batch.columns[:5], pa.array(heads, pa.binary()), pa.array(tails, pa.binary())], ["k", "sha", "copies", "no", "parts", "head", "tail"])

    def agree(table: pa.Table) -> pa.Table:
        """For each chunk, where its pieces begin and, in the next one, end; -1 is a text's end."""
        table = table.sort_by("no")
        heads, tails = ([np.frombuffer(x, np.int32).tolist() for x in table.column(c).to_pylist()] for c in ("head", "tail"))
        n, begin, rows = len(heads), 0, []
        for no in range(n):
            place = meet([e for e in tails[no] if e + chunk >= begin], heads[no + 1]) if no + 1 < n else None
            rows.append((no, begin, -1 if place is None else place))
            if place is None:
                break
            begin = place
        last = len(rows) - 1  # chunks after it are read with it
        of = np.minimum(np.arange(n), last)
        return table.select(["k", "sha", "no"]).append_column("piece", pa.array(of)).append_column("first", pa.array([rows[i][1] for i in of], pa.int64())).append_column("past", pa.array([rows[i][2] for i in of], pa.int64()))

    def write(table: pa.Table) -> pa.Table:
        """The ids and bytes of a piece's chunks: of one, but for those after the last shared boundary."""
        table = table.sort_by("no")
        codec = Codec(data.value, pattern, runs)
        parts, first, past = table.column("part").to_pylist(), table.column("first")[0].as_py(), table.column("past")[0].as_py()
        said = "".join([*(p[:chunk] for p in parts[:-1]), parts[-1]])
        ids = codec.written(pieces(said[first : len(said) if past < 0 else chunk + past], codec.units, chunk, overlap))
        return pa.table([*(table.column(c).slice(0, 1) for c in ("k", "sha", "copies", "piece")), pa.array([ids], pa.binary()), pa.array([codec.decode(ids)], pa.binary())], ["k", "sha", "copies", "piece", "ids", "raw"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        n, ids, raw = _digest(b" ".join(table.column("ids").to_pylist()), b"".join(table.column("raw").to_pylist()))
        return pa.table([table.column("k").slice(0, 1), table.column("copies").slice(0, 1), [n], [ids], [raw]], ["k", "copies", *columns[1:]])

    given = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    long = F.char_length("t") > chunk * spread
    short = given.filter(F.coalesce(~long, F.lit(True))).mapInArrow(together, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    dealt = (
        given.filter(long).groupBy("k", "t").agg(F.count("*").alias("copies")).select("k", F.sha2("t", 256).alias("sha"), "copies", "t")
        .mapInArrow(deal, f"{whole}, no long, parts long, part string")
    )
    marks = dealt.mapInArrow(look, f"{whole}, no long, parts long, head binary, tail binary")
    sure = marks.groupBy("k", "sha").applyInArrow(agree, f"k {kind}, sha string, no long, piece long, first long, past long").withColumnsRenamed({"k": "k_", "sha": "sha_", "no": "no_"})
    met = dealt.join(sure, F.col("k").eqNullSafe(F.col("k_")) & (F.col("sha") == F.col("sha_")) & (F.col("no") == F.col("no_")))
    written = met.select("k", "sha", "copies", "no", "piece", "first", "past", "part").groupBy("k", "sha", "piece").applyInArrow(write, f"{whole}, piece long, ids binary, raw binary")
    joined = (
        written.groupBy("k", "sha").applyInArrow(join, f"k {kind}, copies long, n_tokens long, ids_sha256 string, decoded_sha256 string")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")
    )
    return short.unionByName(joined).select(F.col("k").alias(key), *columns[1:])
