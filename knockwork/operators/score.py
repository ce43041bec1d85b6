"""Perturbation scores: differential genes by rank sums, then projection on the mean signature, with leave-one-out scores."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knockwork.functions.columns import finite, ratio


@F.pandas_udf(T.DoubleType())
def _two_sided(z):
    return z.map(lambda x: math.erfc(abs(x) / math.sqrt(2.0)), na_action="ignore").astype(float)


def rank_sum(expr: DataFrame, cells: DataFrame, control: str, targets: list[str], label: str = "target") -> DataFrame:
    """(target, gene_id, log2fc, z, p) of Wilcoxon rank sums between each label and the control.

    All cells that don't express a gene are one block of ties, so only stored values are
    ranked. Control values are put in order once for all labels; a label's values
    look up how many control cells stand below each and how many tie with it. The
    change is of log2 mean linear expression plus one.
    """
    used = cells.filter(F.col(label).isin([*targets, control])).select("cell_id", F.col(label).alias("label"))
    size = used.groupBy("label").agg(F.count("*").cast("double").alias("n"))
    held = expr.filter("expr <> 0").join(used, "cell_id")
    # One row for each value that occurs: ranks need only how many cells of a label have it.
    times = held.groupBy("gene_id", "label", "expr").agg(F.count("*").cast("double").alias("t"))
    is_c = F.col("label") == control
    of_control = F.sum(F.when(is_c, F.col("t")).otherwise(0.0))
    same = W.partitionBy("gene_id", "expr")
    below = W.partitionBy("gene_id").orderBy("expr").rangeBetween(W.unboundedPreceding, W.currentRow)
    ranked = times.withColumn("c", of_control.over(same)).withColumn("c_below", of_control.over(below) - F.col("c"))
    cube = lambda x: x ** 3 - x
    linear = F.expm1("expr")
    theirs = ranked.filter(is_c).groupBy("gene_id").agg(F.sum("t").alias("kn"), F.sum(cube(F.col("t"))).alias("tied_n"), F.sum(F.col("t") * linear).alias("sn"))
    own = W.partitionBy("label", "gene_id").orderBy("expr").rowsBetween(W.unboundedPreceding, -1)
    ours = ranked.filter(~is_c).withColumn("before", F.col("c_below") + F.coalesce(F.sum("t").over(own), F.lit(0.0)))
    tie = F.col("t") + F.col("c")
    ours = ours.groupBy(F.col("label").alias("target"), "gene_id").agg(
        F.sum(F.col("t") * (F.col("before") + (tie + 1) / 2)).alias("rank_p"), F.sum("t").alias("kp"),
        F.sum(cube(tie) - cube(F.col("c"))).alias("tied_p"), F.sum(F.col("t") * linear).alias("sp"))
    each = theirs.select(F.explode(F.array(*map(F.lit, targets))).alias("target"), "gene_id", "kn", "tied_n", "sn")
    zero = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("rank_p", "kp", "tied_p", "sp", "kn", "tied_n", "sn")]
    stats = each.join(ours, ["target", "gene_id"], "full").select("target", "gene_id", *zero)
    p = size.filter(F.col("label") != control).select(F.col("label").alias("target"), F.col("n").alias("np"))
    controls = F.broadcast(size.filter(is_c).select(F.lit(True).alias("any"), F.col("n").alias("nn")))
    sized = stats.join(F.broadcast(p), "target").withColumn("any", F.lit(True)).join(controls, "any")
    total = F.col("np") + F.col("nn")
    zeros = total - F.col("kn") - F.col("kp")
    tied = F.col("tied_n") + F.col("tied_p")
    ranks = F.col("rank_p") + F.col("kp") * zeros + (F.col("np") - F.col("kp")) * (zeros + 1) / 2
    u = ranks - F.col("np") * (F.col("np") + 1) / 2
    spread_of = F.col("np") * F.col("nn") / 12 * (total + 1 - (tied + zeros ** 3 - zeros) / (total * (total - 1)))
    out = sized.select(
        "target", "gene_id", (F.log2(F.col("sp") / F.col("np") + 1) - F.log2(F.col("sn") / F.col("nn") + 1)).alias("log2fc"),
        F.when(spread_of > 0, (u - F.col("np") * F.col("nn") / 2) / F.sqrt(spread_of)).alias("z"))
    return out.withColumn("p", _two_sided("z"))


def score_genes(tests: DataFrame, n_genes: int, logfc_threshold: float = 0.0, min_genes: int = 0, max_genes: int = 100, cutoff: float = 0.05) -> DataFrame:
    """(target, gene_id, place): the ``max_genes`` genes of smallest p that pass; targets with fewer than ``min_genes`` have none."""
    passing = tests.filter((F.abs("log2fc") >= logfc_threshold) & (F.least(F.lit(1.0), F.col("p") * n_genes) < cutoff))
    of_target = W.partitionBy("target")
    placed = passing.withColumns({"place": F.row_number().over(of_target.orderBy("p", F.abs("z").desc(), "gene_id")), "found": F.count("*").over(of_target)})
    return placed.filter((F.col("place") <= max_genes) & (F.col("found") >= min_genes)).select("target", "gene_id", "place")


def projection_scores(signature: DataFrame, cells: DataFrame, control: str, genes: DataFrame, scale: bool = True) -> tuple[DataFrame, DataFrame]:
    """(scores, leave-one-out scores) of each target's and all control cells, by target.

    ``signature`` is (cell_id, gene_id, prtb), for all targets alike or, with a column
    ``slice``, for each of its own. The vector is the difference of mean signatures; a score is a
    cell's projection on it. Leaving a gene out takes its part from both sums, so no
    score is made twice. Pairs without a row are zeros: scaling shifts every cell by the same
    amount, taken once.
    """
    wanted = genes.select("target", "gene_id")
    targets = wanted.groupBy(F.lit(True).alias("any")).agg(F.collect_set("target").alias("targets"))
    own = cells.join(F.broadcast(wanted.select("target").distinct()), "target", "left_semi").select("target", "cell_id", F.col("target").alias("gene"))
    theirs = cells.filter(F.col("target") == control).select("cell_id", F.col("target").alias("gene"), F.lit(True).alias("any")).join(F.broadcast(targets), "any")
    members = own.unionByName(theirs.select(F.explode("targets").alias("target"), "cell_id", "gene"))
    size = members.groupBy("target").agg(F.count("*").cast("double").alias("n"), F.sum((F.col("gene") == F.col("target")).cast("double")).alias("np"))
    labelled = signature.join(cells.select("cell_id", F.col("target").alias("gene")), "cell_id")
    if "slice" in signature.columns:
        labelled, on = labelled.withColumnRenamed("slice", "target"), ["target", "gene_id"]
    else:
        on = ["gene_id"]
    # Of each label, what its cells have of a gene; the control's is made once and joined to every target.
    by = [c for c in ("target", "gene") if c in labelled.columns]
    label_sums = labelled.groupBy(*by, "gene_id").agg(F.sum("prtb").alias("s"), F.sum(F.col("prtb") * F.col("prtb")).alias("ss"))
    is_p = F.col("gene") == F.col("target")
    sums = label_sums.join(wanted, on).filter(is_p | (F.col("gene") == control)).groupBy("target", "gene_id").agg(
        F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.sum(F.when(is_p, F.col("s")).otherwise(0.0)).alias("sp"))
    full = sums.join(size, "target")
    mean = F.col("s") / F.col("n")
    sd = F.sqrt(F.greatest(F.lit(0.0), ratio(F.col("ss") - F.col("n") * mean * mean, F.col("n") - 1)))
    full = full.withColumns({"m": mean if scale else F.lit(0.0), "sd": F.when(sd > 0, sd).otherwise(1.0) if scale else F.lit(1.0)})
    v = (ratio(F.col("sp"), F.col("np")) - ratio(F.col("s") - F.col("sp"), F.col("n") - F.col("np"))) / F.col("sd")
    vector = full.select("target", "gene_id", finite(v).alias("v"), "m", "sd").filter("v is not null")
    norm = vector.groupBy("target").agg(F.sum(F.col("v") * F.col("v")).alias("vv"), F.sum(F.col("v") * F.col("m") / F.col("sd")).alias("shift"))
    x = labelled.join(vector, on).filter(is_p | (F.col("gene") == control))
    parts = x.groupBy("target", "cell_id").agg(F.sum(F.col("prtb") * F.col("v") / F.col("sd")).alias("xv"), F.map_from_entries(F.collect_list(F.struct("gene_id", "prtb"))).alias("has"))
    base = members.join(parts, ["target", "cell_id"], "left").join(F.broadcast(norm), "target").withColumn("num", F.coalesce("xv", F.lit(0.0)) - F.col("shift"))
    scores = base.select("target", "cell_id", "gene", ratio(F.col("num"), F.col("vv")).alias("pvec"))
    listed = vector.groupBy("target").agg(F.collect_list(F.struct("gene_id", "v", "m", "sd")).alias("genes"))
    each = base.join(F.broadcast(listed), "target").select("target", "cell_id", "gene", "num", "vv", "has", F.explode("genes").alias("g"))
    each = each.select("target", "cell_id", "gene", "num", "vv", F.coalesce(F.try_element_at("has", F.col("g.gene_id")), F.lit(0.0)).alias("prtb"), "g.*")
    part = (F.col("prtb") - F.col("m")) / F.col("sd") * F.col("v")
    loo = each.select("target", "cell_id", "gene", F.col("gene_id").alias("loo_gene"), ratio(F.col("num") - part, F.col("vv") - F.col("v") * F.col("v")).alias("pvec"))
    return scores, loo
