"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are runs of 2 to 4 bytes of a word in lower case, those at its start told apart, its end
marked by a space; each is hashed to an embedding, a text is the mean of its subwords'
embeddings, and a linear softmax gives the languages. Both layers are trained together by
stochastic gradient descent in numpy. A temperature, fitted on rows set aside, turns the softmax
into calibrated probabilities, and the rows set aside also give the score below which a
prediction should be rejected (``Model.floor``).

It learns from at most ``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES`` of text, the first in the order of a
hash of their key, each as a whole text and as a short span of it; predictions read every whole
text. A text that is null or has no letters is ``und`` with score 0, as is every text when there is
nothing to learn from. Repeated rows are judged one by one, of equally likely languages the first in
order is taken; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.llm.sampling import chosen, fold, within
from knockwork.llm.textscan import NOT_LETTERS, blocks, scan

#: Fixed values of the contract.
FOLDS, HELD_OUT, UNKNOWN = 5, 0, "und"

#: Labelled rows that are learned from, and bytes of their texts.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 64 << 20
BITS = 13
DIM = 16
SIZES = (2, 3, 4)
EPOCHS, BATCH, RATE = 10, 64, 4.0
#: Share of right predictions that the rejection floor aims at.
PRECISION = 0.98


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    floor: float

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        x = (means + self.bias) / self.temperature
        x = np.exp(x - x.max(1, keepdims=True))
        return x / x.sum(1, keepdims=True)


def subwords(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every subword of the texts."""
    words = scan(texts, lower=True, separators=NOT_LETTERS)
    data, used = words.data, int(words.end[-1]) + 1 if len(words.end) else 0
    size = words.end - words.start
    first = np.zeros(used, bool)
    first[words.start] = True
    text = np.repeat(words.text_of(), size + 1)  # of each byte, a word's space included
    inside = np.ones(used, bool)
    inside[words.end] = False
    out, owner = [], []
    value, whole = data[:used].astype(np.uint32), inside
    for n in range(2, max(SIZES) + 1):
        value = value[:-1] | data[n - 1 : used].astype(np.uint32)[: max(used - n + 1, 0)] << np.uint32(8 * (n - 1)) if used >= n else value[:0]
        at = np.flatnonzero(whole[: len(value)])  # no space before the last byte
        if n in SIZES:
            h = (value[at] ^ (first[at] * np.uint32(0x5BD1E995))) * np.uint32(0x9E3779B1 + 2 * n)
            out.append((h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS))
            owner.append(text[at])
        whole = whole[: len(value)] & inside[n - 1 : n - 1 + len(value)]
    return np.concatenate(out), np.concatenate(owner)


def means(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """Mean of the rows of ``table`` over each text's subwords; zeros for a text without any."""
    bucket, text = subwords(texts)
    n = np.bincount(text, minlength=len(texts))
    sums = np.stack([np.bincount(text, table[bucket, k], len(texts)) for k in range(table.shape[1])], 1)
    return sums / np.maximum(n, 1)[:, None]


def _span(text: str, key: object) -> str:
    """A few words of a text, chosen by its key."""
    words = text.split()
    seed = zlib.crc32(f"span {key}".encode())
    size = 2 + seed % 7
    at = seed // 7 % max(1, len(words) - size + 1)
    return " ".join(words[at : at + size])


def learn(counts: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, aside: np.ndarray, languages: list[str], seed: int = 5) -> Model:
    """Softmax regression on mean embeddings; ``counts`` are (bucket, share) of each example, ``aside`` those kept for calibration."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    weight = rng.normal(0, 0.1, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    train = np.flatnonzero(~aside)
    if not len(train):
        train = np.arange(len(counts))

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), 1 << BITS), np.float32)
        for i, r in enumerate(rows.tolist()):
            x[i, counts[r][0]] = counts[r][1]
        return x

    def softmax(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    steps, done = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        mixed = rng.permutation(train)
        for at in range(0, len(mixed), BATCH):
            rows = mixed[at : at + BATCH]
            x = dense(rows)
            v = x @ embed
            g = softmax(v @ weight + bias)
            g[np.arange(len(rows)), label[rows]] -= 1
            g *= RATE * (1 - done / steps) / len(rows)
            back = g @ weight.T
            weight -= v.T @ g
            bias -= g.sum(0)
            embed -= (x.T @ back) * 10  # means of many subwords move little
            done += 1
    table = (embed @ weight).astype(np.float64)
    held = np.flatnonzero(aside) if aside.any() else train
    logits = np.concatenate([dense(held[i : i + 256]) @ table for i in range(0, len(held), 256)]) + bias
    right = label[held]
    loss = {t: -np.log(softmax(logits / t)[np.arange(len(held)), right] + 1e-12).mean() for t in np.geomspace(0.25, 8, 41)}
    temperature = min(loss, key=loss.get)
    p = softmax(logits / temperature)
    order = np.argsort(-p.max(1), kind="stable")
    good = np.cumsum((p.argmax(1) == right)[order]) / np.arange(1, len(held) + 1)
    enough = np.flatnonzero(good >= PRECISION)
    floor = float(p.max(1)[order][enough[-1]]) if len(enough) else 1.0
    return Model(languages, table, bias.astype(np.float64), float(temperature), floor)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Subword counts of the chosen rows are made on the executors; the driver learns from them."""
    known = within(docs, chosen(docs.filter(F.col(text).isNotNull()), key, lang, sample_rows), key, text, SAMPLE_BYTES)
    if not known:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = []
                for said in (t or "", _span(t or "", k)):
                    bucket, n = np.unique(subwords(pa.array([said]))[0], return_counts=True)
                    found.append((bucket.astype(np.int32).tobytes(), (n / max(1, n.sum())).astype(np.float32).tobytes()))
                yield pa.record_batch([pa.array([str(k)] * 2), pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())], ["k", "b", "n"])

    by_text = {str(k): v for k, v in known.items()}
    rows = sorted((r.k, bytes(r.b), bytes(r.n)) for r in docs.filter(F.col(key).isin(list(known))).select(key, text).mapInArrow(run, "k string, b binary, n binary").collect())
    rows = [r for r in rows if r[1]]
    languages = sorted({by_text[r[0]] for r in rows})
    if not languages:
        return None
    label = np.array([languages.index(by_text[r[0]]) for r in rows])
    aside = np.array([zlib.crc32(f"aside {r[0]}".encode()) % 5 == 0 for r in rows])
    return learn([(np.frombuffer(b, np.int32), np.frombuffer(n, np.float32)) for _, b, n in rows], label, aside, languages)


def predict(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, lang_pred, score and rejected (score below the calibrated floor) of every row."""
    given = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if model is None:
        return given.select(F.col("k").alias(key), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = np.array(known.languages, object)
        for batch in batches:
            column = batch.column(1)
            for a, b in blocks(np.asarray(pc.fill_null(pc.binary_length(column), 0))):
                p = known.probabilities(means(column.slice(a, b - a), known.table))
                letters = np.asarray(batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False), bool)
                score = np.where(letters, p.max(1), 0.0)
                lang = np.where(letters, names[p.argmax(1)], UNKNOWN)
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(score < known.floor)], ["k", "lang_pred", "score", "rejected"])

    kind = docs.schema[key].dataType.simpleString()
    return given.mapInArrow(run, f"k {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("k", key)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``key``, held_out, lang_pred, score and rejected; held-out rows are never learned from."""
    model = train(docs.filter(fold(F.col(key), FOLDS) != HELD_OUT), text, lang, key, sample_rows)
    return predict(docs, model, text, key).select(key, (fold(F.col(key), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")
