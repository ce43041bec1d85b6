"""Token counts without tokens: what a BPE vocabulary with word ends would give, by merging alone.

A word's count is its initial symbols minus its merges (``merging``); no identifier is
looked up. Text is prepared as the vocabulary's library does it: strings of special
tokens count one each, the rest is composed (NFC), white space becomes one space,
letters become small, and each match of the word pattern is merged separately.

A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted one by one,
words of any length take O(n log n), extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.llm import vocab
from knockwork.llm.merging import merge, uncollected
from knockwork.llm.textscan import kept, released

#: Fixed values of the vocabulary's library: how words are cut.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

#: Characters at which str.split cuts though the word pattern doesn't.
NOT_SPACE = regex.compile(r"[\x1c-\x1f]")

#: Strings between white space whose counts a worker remembers as met of late, and as many met before; characters of the longest of them.
MEMO, MEMO_CHARS = 400_000, 64


class Counter(dict):
    """Counts by string between white space (no word spans any), filled as they are met."""

    def __init__(self, data: bytes):
        super().__init__()
        self.pairs, self.specials, self.end = vocab.word_bpe(data)
        self.letters = vocab.byte_letters()
        self.short = lru_cache(MEMO // 2)(self.merged)
        self.before: dict = {}
        self.find = regex.compile(WORDS).findall
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None

    def __missing__(self, run: str) -> int:
        n = self.before.get(run)
        if n is None:
            n = sum(map(self.word, self.find(run)))
        if len(run) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.before = dict(self)
                self.clear()
            self[run] = n
        return n

    def word(self, word: str) -> int:
        return self.short(word) if len(word) <= MEMO_CHARS else self.merged(word)

    def merged(self, word: str) -> int:
        symbols = [self.letters[b] for b in word.encode()]
        symbols[-1] += self.end
        return len(merge(symbols, lambda a, b: self.pairs.get((a, b))))

    def count(self, text: str) -> int:
        parts = self.cut.split(text) if self.cut else [text]
        n = len(parts) - 1
        for part in parts:
            # A letter at a time: a final sigma stays a plain one.
            small = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            if NOT_SPACE.search(small):
                n += sum(self.word(w) for w in self.find(small))
            else:
                n += sum(map(self.__getitem__, small.split()))
        return n


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit for every row, in one pass without a shuffle."""
    data = docs.sparkSession.sparkContext.broadcast(vocab.read(vocabulary))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with uncollected(), kept(("counter", data.value), lambda: Counter(data.value)) as counter:
            for batch in batches:
                n = [counter.count(t) if t else 0 for t in batch.column(1).to_pylist()]
                yield pa.record_batch([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["k", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    counted = given.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
