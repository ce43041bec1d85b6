"""Bounded samples of labelled rows, the same for every order and partitioning of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: Column, folds: int) -> Column:
    """crc32 of a key as text, modulo ``folds``; a null key is like an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def chosen(labelled: DataFrame, key: str, label: str, most: int) -> dict:
    """key -> label of at most ``most`` rows, the first in the order of a hash of their key.

    Only keys and labels are ranked and brought to the driver. A key with several
    labels has the largest; null keys and labels are left out.
    """
    known = labelled.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    first = known.groupBy(key).agg(F.max(label).alias("label")).orderBy(F.xxhash64(key), key).limit(most)
    return {r[0]: r[1] for r in first.collect()}


def within(docs: DataFrame, known: dict, key: str, text: str, most: int) -> dict:
    """Those of the chosen keys, in their order, whose texts hold ``most`` bytes together; a key without a text needs none."""
    if not known:
        return known
    sizes = docs.filter(F.col(key).isin(list(known))).groupBy(key).agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0))).alias("n"))
    n = {r[0]: r[1] for r in sizes.collect()}
    out, total = {}, 0
    for k, label in known.items():
        total += n.get(k, 0)
        if total > most:
            break
        out[k] = label
    return out
