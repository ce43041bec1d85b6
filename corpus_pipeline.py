"""From raw documents to training ids: quality, near-duplicates, repeats, contamination, encoding.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last give the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from knockwork.llm import bytebpe, decontam, quality, simhash, substr
from knockwork.llm.queries import BYTE_BPE
from knockwork.llm.scratch import Scratch

#: Units that a worker remembers while it encodes: executors still hold the heap that the stages before have filled.
MEMO = 100_000


def drop_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id; of null id only where no other is there."""
    return simhash.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages that stand in one of smaller id; n_chars follows the text."""
    return substr.remove_repeats(docs, length="n_chars")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than a twentieth of benchmark passages."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left."""
    return bytebpe.encode_documents(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, runs=bytebpe.RUNS, memo=MEMO)


STAGES = [
    ("quality_rules", drop_junk),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Near-duplicate groups and merges are beyond SQL; the tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
