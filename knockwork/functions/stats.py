"""Tests and adjustments of p values."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bh_adjust(df: DataFrame, p: str = "p_weight", into: str = "p_adj_bh", by: tuple[str, ...] = ("target_gene",), order: str = "gene_id", universe: int | None = None) -> DataFrame:
    """Adds Benjamini-Hochberg q values within ``by``: over the p values that aren't null, or out of ``universe`` tests.

    Null stays null. Ranks are taken from the largest p down. The ratio is made before the product, so it is 1 or more
    and no q is below its p.
    """
    keys = [F.col(c) for c in by]
    known = F.col(p).isNotNull()
    down = W.partitionBy(*keys, known).orderBy(F.col(p).desc(), F.col(order))
    up_to = down.rowsBetween(W.unboundedPreceding, W.currentRow)
    m = F.count(p).over(W.partitionBy(*keys, known))
    tests = F.greatest(F.lit(universe), m) if universe else m
    raw = F.col(p) * (tests / (m - F.row_number().over(down) + 1))
    out = df.withColumn("bh__raw", raw)
    q = F.least(F.lit(1.0), F.min("bh__raw").over(up_to))
    return out.withColumn(into, F.when(known, q)).drop("bh__raw")


def wald_p(beta: float, se: float) -> float | None:
    """P(chi-square of one degree > (beta / se)²); None where the error is zero or not finite."""
    if not (math.isfinite(beta) and math.isfinite(se)) or se <= 0:
        return None
    return math.erfc(abs(beta / se) / math.sqrt(2.0))
