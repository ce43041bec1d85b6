"""Weights of cells in the regression, from their perturbation scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwork.functions.columns import finite, ratio

SCOPE = ("target", "cell_type")


def min_max(df: DataFrame, column: str, by: tuple[str, ...]) -> DataFrame:
    """``column`` scaled to 0..1 within ``by``; unchanged where its range is zero or not finite."""
    span = df.groupBy(*by).agg(F.min(column).alias("lo__"), F.max(column).alias("hi__"))
    width = finite(F.col("hi__") - F.col("lo__"))
    scaled = F.when(width > 0, ratio(F.col(column) - F.col("lo__"), width)).otherwise(F.col(column))
    return df.join(F.broadcast(span) if not by else span, list(by)).withColumn(column, scaled).drop("lo__", "hi__")


def standardized(scores: DataFrame, control: str, by: tuple[str, ...] = SCOPE) -> DataFrame:
    """``scores`` (…by, cell_id, gene, pvec) with weight.

    Scores are standardised by the mean and sample deviation of the control cells;
    what isn't finite or is below zero becomes zero, as does every control cell; then
    weights are scaled to 0..1 over both groups. Rows of other labels get 0.
    """
    control_score = F.when(F.col("gene") == control, finite(F.col("pvec")))
    moments = scores.groupBy(*by).agg(F.avg(control_score).alias("m__"), F.stddev_samp(control_score).alias("s__"))
    z = finite(ratio(F.col("pvec") - F.col("m__"), F.col("s__")))
    weight = F.when((F.col("gene") == F.col("target")) & (z > 0), z).otherwise(F.lit(0.0))
    return min_max(scores.join(moments, list(by)).withColumn("weight", weight).drop("m__", "s__"), "weight", by)


def leave_one_out(loo_scores: DataFrame, control: str) -> DataFrame:
    """The same for scores that each leave one gene out (loo_gene)."""
    return standardized(loo_scores, control, (*SCOPE, "loo_gene"))


def binary(cells: DataFrame, target: str | Column, control: str) -> DataFrame:
    """Cells of a target and of the control with weight 1 and 0: what serves without scores."""
    target = F.lit(target) if isinstance(target, str) else target
    kept = cells.filter((F.col("target") == target) | (F.col("target") == control))
    return kept.withColumn("weight", F.when(F.col("target") == target, 1.0).otherwise(0.0))


def binary_of(cells: DataFrame, targets: list[str], control: str) -> DataFrame:
    """(target, cell_id, gene, weight): the binary weights of many targets; each has all control cells."""
    each = F.when(F.col("target") == control, F.array(*map(F.lit, targets))).otherwise(F.array("target"))
    kept = cells.filter(F.col("target").isin([*targets, control])).select(F.explode(each).alias("of"), "cell_id", F.col("target").alias("gene"))
    return kept.select(F.col("of").alias("target"), "cell_id", "gene", F.when(F.col("gene") == F.col("of"), 1.0).otherwise(0.0).alias("weight"))


def varies(column: str = "weight") -> Column:
    """Aggregate: whether there are finite weights above zero and at zero."""
    w = finite(F.col(column))
    return F.coalesce(F.bool_or(w > 0), F.lit(False)) & F.coalesce(F.bool_or(w == 0), F.lit(False))
