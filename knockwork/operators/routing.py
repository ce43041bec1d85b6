"""Designs, leave-one-out routing and the shape of results."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.functions.columns import finite
from knockwork.functions.stats import bh_adjust
from knockwork.operators.weights import varies

log = logging.getLogger(__name__)

RESULT = "gene_ID string, log2FC double, beta_weight double, p_weight double, DE_method string, target_gene string, p_adj_bh double"


def design(weights: DataFrame, cells: DataFrame) -> DataFrame:
    """(target, cell_id, gene, cell_type, n_count, weight, log_ct): weights joined to covariates on cell and label.

    ``weights`` has target, cell_id, gene and weight; cells that aren't in ``cells`` go.
    """
    covariates = cells.select("cell_id", F.col("target").alias("gene"), "cell_type", "n_count")
    joined = weights.select("target", "cell_id", "gene", "weight").join(covariates, ["cell_id", "gene"])
    log_ct = F.coalesce(finite(F.log1p("n_count")), F.lit(0.0))
    return joined.select("target", "cell_id", "gene", "cell_type", "n_count", "weight", log_ct.alias("log_ct"))


def unmatched(weights: DataFrame, cells: DataFrame) -> int:
    """How many weighted cells of a target ``design`` leaves out, as ``cells`` doesn't have them; they are logged."""
    lost = weights.select("cell_id", "gene").distinct().join(cells.select("cell_id", F.col("target").alias("gene")), ["cell_id", "gene"], "left_anti").count()
    if lost:
        log.warning("%d weighted cells aren't in the screen and are left out", lost)
    return lost


def varying_targets(designs: DataFrame) -> DataFrame:
    """Targets whose weights vary; the others get an empty result."""
    return designs.groupBy("target").agg(varies("weight").alias("ok")).filter("ok").select("target")


def loo_targets(loo_weights: DataFrame, designs: DataFrame, genes: DataFrame) -> DataFrame:
    """(target, loo_gene): genes with weights of their own that vary, and each target's own gene where the matrix has it.

    A gene whose leave-one-out weights don't vary goes back to the main fit.
    """
    members = designs.select("target", "cell_id")
    scored = loo_weights.join(members, ["target", "cell_id"], "left_semi").groupBy("target", "loo_gene").agg(varies("weight").alias("ok")).filter("ok").select("target", "loo_gene")
    own = designs.groupBy("target").agg(F.bool_or(F.col("gene") == F.col("target")).alias("p"), F.bool_or(F.col("gene") != F.col("target")).alias("n"))
    own = own.filter("p and n").select("target", F.translate(F.col("target").cast("string"), "_", "-").alias("loo_gene"))
    known = genes.select(F.col("gene_id").alias("loo_gene")).distinct()
    return scored.unionByName(own).distinct().join(known, "loo_gene", "left_semi").select("target", "loo_gene")


def route(de_set: DataFrame, loo: DataFrame) -> DataFrame:
    """(target, gene_id, fit_group): leave-one-out genes each in a group of their own, whether they passed or not; the rest in 'main'."""
    alone = loo.select("target", F.col("loo_gene").alias("gene_id"), F.col("loo_gene").cast("string").alias("fit_group"))
    rest = de_set.join(loo.select("target", F.col("loo_gene").alias("gene_id")), ["target", "gene_id"], "left_anti")
    return rest.select("target", "gene_id", F.lit("main").alias("fit_group")).unionByName(alone)


def own_gene_weights(designs: DataFrame, loo: DataFrame) -> DataFrame:
    """Binary leave-one-out weights of each target's own gene."""
    own = loo.filter(F.col("loo_gene") == F.translate(F.col("target").cast("string"), "_", "-"))
    return designs.join(own, "target").select("target", "loo_gene", "cell_id", (F.col("gene") == F.col("target")).cast("double").alias("weight"))


def result(fits: DataFrame, changes: DataFrame, methods: DataFrame, bh_universe: int | None = None) -> DataFrame:
    """The seven columns of the result, in order of target and gene. ``fits`` has target, gene_id, beta_weight and p_weight."""
    joined = fits.join(changes, ["target", "gene_id"], "left").join(methods, "target", "left")
    shaped = joined.select(
        F.col("gene_id").cast("string").alias("gene_ID"), F.col("log2fc").alias("log2FC"), "beta_weight", "p_weight",
        F.col("method").alias("DE_method"), F.col("target").cast("string").alias("target_gene"))
    return bh_adjust(shaped, order="gene_ID", universe=bh_universe)


def empty_result(spark) -> DataFrame:
    return spark.createDataFrame([], RESULT)
