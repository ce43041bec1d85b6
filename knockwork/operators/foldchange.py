"""Fold changes of raw counts between each target and the control, with expression gates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRATUM = "con1"


def with_stratum(cells: DataFrame, split_by: str | None = None) -> DataFrame:
    """Cells with cell_type: a column's values, or one constant."""
    return cells.withColumn("cell_type", F.col(split_by) if split_by else F.lit(STRATUM))


def fold_change_stats(counts: DataFrame, cells: DataFrame, control: str, targets: list[str], pseudocount: float = 1.0, base: float = 2.0) -> DataFrame:
    """(target, cell_type, gene_id, avg_log2fc, n_p, n_n, cells_p, cells_n) of every gene that a target or the control has.

    The control's sums are made once for all targets. Group sizes count cells without
    counts too; the pseudocount is added to the sum. Strata without cells on either side give no rows.
    """
    used = cells.filter(F.col("target").isin([*targets, control])).select("cell_id", "target", "cell_type")
    size = used.groupBy("target", "cell_type").agg(F.count("*").cast("double").alias("n"))
    expressed = F.count(F.when(F.col("count") != 0, 1))
    sums = counts.join(used, "cell_id").groupBy("target", "cell_type", "gene_id").agg(F.sum("count").cast("double").alias("s"), expressed.alias("e"))
    zero = F.lit(0.0)
    own = sums.filter(F.col("target") != control).select("target", "cell_type", "gene_id", F.col("s").alias("sp"), F.col("e").alias("ep"), zero.alias("sn"), F.lit(0).cast("long").alias("en"))
    each = F.explode(F.array(*map(F.lit, targets)))
    theirs = sums.filter(F.col("target") == control).select(each.alias("target"), "cell_type", "gene_id", zero.alias("sp"), F.lit(0).cast("long").alias("ep"), F.col("s").alias("sn"), F.col("e").alias("en"))
    both = own.unionByName(theirs).groupBy("target", "cell_type", "gene_id").agg(*(F.sum(c).alias(c) for c in ("sp", "ep", "sn", "en")))
    p = size.filter(F.col("target") != control).withColumnRenamed("n", "cells_p")
    n = size.filter(F.col("target") == control).select("cell_type", F.col("n").alias("cells_n"))
    sized = both.join(p, ["target", "cell_type"]).join(n, "cell_type")
    scale = 1.0 / math.log(base)
    lfc = (F.log((F.col("sp") + pseudocount) / F.col("cells_p")) - F.log((F.col("sn") + pseudocount) / F.col("cells_n"))) * scale
    return sized.select("target", "cell_type", "gene_id", lfc.alias("avg_log2fc"), F.col("ep").alias("n_p"), F.col("en").alias("n_n"), "cells_p", "cells_n")


def gates(stats: DataFrame, logfc_threshold: float = 0.0, min_pct: float = 0.0, min_cells: int = 10) -> DataFrame:
    """Adds pass_pct, pass_cell, status2 (both) and status (and a large enough change)."""
    pct = (F.col("n_p") / F.col("cells_p") >= min_pct) | (F.col("n_n") / F.col("cells_n") >= min_pct)
    cell = (F.col("n_p") >= min_cells) | (F.col("n_n") >= min_cells)
    out = stats.withColumns({"pass_pct": pct, "pass_cell": cell})
    status2 = F.col("pass_pct") & F.col("pass_cell")
    return out.withColumns({"status2": status2, "status": (F.abs("avg_log2fc") >= logfc_threshold) & status2})


def de_genes(gated: DataFrame, genes: DataFrame) -> DataFrame:
    """(target, gene_id) to fit: genes that pass in any stratum, and each target's own gene where the matrix has it."""
    passing = gated.groupBy("target", "gene_id").agg(F.bool_or("status").alias("any")).filter("any").select("target", "gene_id")
    own = gated.select("target", F.translate("target", "_", "-").alias("gene_id")).distinct().join(genes.select("gene_id").distinct(), "gene_id", "left_semi")
    return passing.unionByName(own.select("target", "gene_id")).distinct()


def masked(gated: DataFrame) -> DataFrame:
    """(target, cell_type, gene_id, log2fc): the change, null where an expression gate failed."""
    return gated.select("target", "cell_type", "gene_id", F.when(F.col("status2"), F.col("avg_log2fc")).alias("log2fc"))


def wide(masks: DataFrame, strata: list[str]) -> DataFrame:
    """(target, gene_id, log2FC_<stratum>…)."""
    out = masks.groupBy("target", "gene_id").pivot("cell_type", strata).agg(F.first("log2fc"))
    return out.select("target", "gene_id", *(F.col(f"`{s}`").alias(f"log2FC_{s}") for s in strata))
