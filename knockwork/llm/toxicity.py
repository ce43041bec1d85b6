"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the words, pairs of neighbours and pairs with one word between
them that it holds (once each, however often), hashed to ``BUCKETS``. The learner has a
rate for each coordinate and an L1 penalty that leaves few weights other than zero; those
are broadcast as two sorted arrays.

It learns from at most ``SAMPLE_ROWS`` labelled rows, the first in the order of a hash of
their key, of which the driver takes the features of at most ``SAMPLE_BYTES`` of text; scores
cover every whole text. The L1 penalty is that of ``L1S`` which does best on a fifth of these rows after
learning from the others. Null, empty and wordless texts have no features
and the score of the bias alone. Without labelled rows every score is that of no
knowledge, 0.5. Repeated rows are scored one by one, of equally good penalties the larger is
taken; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.llm.sampling import chosen, fold, within
from knockwork.llm.textscan import NOT_ALNUM, U, blocks, mix, scan, xxh64

#: Fixed values of the contract.
FOLDS, HELD_OUT, LIMIT = 4, 2, 0.3

#: Labelled rows that are learned from, and bytes of their texts.
SAMPLE_ROWS, SAMPLE_BYTES = 8000, 64 << 20
BITS = 20
#: Times that all rows are gone through, for each penalty that is tried too.
EPOCHS = 6
ALPHA, BETA, L2 = 0.5, 1.0, 0.1
L1S = (32.0, 16.0, 8.0, 4.0)


@dataclass
class Model:
    """Weights other than zero by bucket, in order, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, features: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """Of n texts, whose features are given with the text of each."""
        at = np.searchsorted(self.buckets, features)
        at[at == len(self.buckets)] = 0
        hit = self.buckets[at] == features if len(self.buckets) else np.zeros(len(features), bool)
        once = np.unique(text[hit].astype(np.int64) << BITS | features[hit])
        weights = self.weights[np.searchsorted(self.buckets, once & (1 << BITS) - 1)] if len(once) else np.zeros(0)
        return self.bias + np.bincount(once >> BITS, weights, n)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word, pair and skip pair of the texts."""
    words = scan(texts, lower=True, separators=NOT_ALNUM)
    h = xxh64(words.data, words.start, words.end - words.start)
    text = words.text_of()
    out, owner = [mix(h)], [text]
    with np.errstate(over="ignore"):
        for gap, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            same = text[gap:] == text[:-gap]
            out.append(mix(h[:-gap] * U(factor) + h[gap:])[same])
            owner.append(text[gap:][same])
    return (np.concatenate(out) >> U(64 - BITS)).astype(np.int64), np.concatenate(owner)


def penalty(examples: list[tuple[np.ndarray, int]], candidates: tuple[float, ...] = L1S) -> float:
    """The L1 penalty of least log loss on every fifth example, learned from the others."""
    aside, rest = examples[::5], [e for i, e in enumerate(examples) if i % 5]
    if len({y for _, y in rest}) < 2 or not aside:
        return candidates[0]
    loss = {}
    for l1 in candidates:
        model = learn(rest, l1=l1)
        of = np.repeat(np.arange(len(aside)), [len(f) for f, _ in aside])
        logit = model.logits(np.concatenate([f for f, _ in aside]), of, len(aside))
        loss[l1] = float(np.logaddexp(0, np.where([y for _, y in aside], -logit, logit)).mean())
    return min(candidates, key=loss.__getitem__)


def learn(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, seed: int = 11, l1: float = 8.0) -> Model:
    """FTRL-proximal over (distinct buckets, label) in a shuffled order, ``epochs`` times."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS  # its weight has no L1 penalty
    rate = sum(y for _, y in examples) / len(examples) if examples else 0.5

    def weights(at: np.ndarray) -> np.ndarray:
        least = np.where(at == bias, 0.0, l1)
        return np.where(np.abs(z[at]) <= least, 0.0, -(z[at] - np.sign(z[at]) * least) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(seed)
    if examples:
        start = np.clip(rate, 1e-3, 1 - 1e-3)
        z[bias] = -np.log(start / (1 - start)) * (BETA / ALPHA + L2)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            at, y = np.append(examples[i][0], bias), examples[i][1]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(len(z)))
    found = np.flatnonzero(w[:bias])
    return Model(found, w[found], float(w[bias]))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Features of the chosen rows are made on the executors; the driver learns from their distinct buckets."""
    known = within(docs, chosen(labels, key, label, sample_rows), key, text, SAMPLE_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, _ = features(batch.column(1).slice(i, 1))
                yield pa.record_batch([batch.column(0).slice(i, 1), pa.array([np.unique(bucket).astype(np.int32).tobytes()], pa.binary())], ["k", "f"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.filter(F.col(key).isin(list(known))).select(key, text).mapInArrow(run, f"k {kind}, f binary").collect() if known else []
    examples = sorted((r.k, bytes(r.f)) for r in rows)
    given = [(np.frombuffer(f, np.int32).astype(np.int64), int(known[k] > 0)) for k, f in examples]
    return learn(given, l1=penalty(given))


def scores(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and score of every row, in one pass without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for a, b in blocks(np.asarray(pc.fill_null(pc.binary_length(column), 0))):
                logit = sent.value.logits(*features(column.slice(a, b - a)), b - a)
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(1 / (1 + np.exp(-np.clip(logit, -35, 35))))], ["k", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, score double").select(F.col("k").alias(key), "score")


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``key``, held_out, score and predicted; labels of held-out rows are never learned from."""
    model = train(docs, labels.filter(fold(F.col(key), FOLDS) != HELD_OUT), text, key, label, sample_rows)
    out = scores(docs, model, text, key)
    return out.select(key, (fold(F.col(key), FOLDS) == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= LIMIT, 1).otherwise(0).alias("predicted"))
