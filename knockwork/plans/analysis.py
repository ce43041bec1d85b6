"""From a screen to weighted differential expression, for one target or many in one job.

Python workers have one thread of linear algebra each: Spark sets OMP_NUM_THREADS to spark.task.cpus for them.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.config import ScreenConfig
from knockwork.functions.held import held as _held, shared_folder
from knockwork.functions.names import dashed
from knockwork.operators import expression, foldchange, glm, neighbours, routing, score, weights
from knockwork.sources.screen import Screen, perturbations, prepare

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Scores:
    """Per target: scores, leave-one-out scores and, if asked for, neighbours."""

    scores: DataFrame
    loo: DataFrame
    knn: DataFrame | None = None


def perturbation_scores(screen: Screen, cfg: ScreenConfig, targets: list[str], shared_embedding: bool = False) -> Scores | None:
    """Signature and score of each target in an embedding of its own cells and the controls, or in one of all cells.

    All targets go through every step together, the target being a key: a slice of cells for each. Signatures are
    made only of the genes that a target's score uses. With a guide column, genes
    are chosen by guide and joined. None where no target has genes to score by.
    """
    cells = foldchange.with_stratum(screen.cells.filter(F.col("target").isin([*targets, cfg.control])), cfg.split_by)
    cells = _held(cells)
    counts = screen.counts.join(cells.select("cell_id"), "cell_id", "left_semi")
    expr = _held(expression.log_normalize(counts, cells))
    n_genes = screen.genes.count()
    if cfg.guide_col and cfg.guide_col in cells.columns:
        genes = _genes_by_guide(expr, cells, cfg, targets, n_genes)
    else:
        genes = score.score_genes(score.rank_sum(expr, cells, cfg.control, targets), n_genes, cfg.logfc_threshold, cfg.min_de_genes, cfg.max_de_genes)
    genes = _held(genes)
    scored = [r[0] for r in genes.select("target").distinct().orderBy("target").collect()]
    if without := [t for t in targets if t not in scored]:
        log.warning("no genes to score %d of %d targets by: %s", len(without), len(targets), ", ".join(without[:20]))
    if not scored:
        return None
    slices = None if shared_embedding else _held(expression.sliced(cells, cfg.control, scored))
    _, embedding = expression.embed(counts, cells, cfg.variable_features, max(cfg.min_npcs, cfg.ndims), slices)
    embedding = _held(embedding)
    asking = cells if shared_embedding else cells.drop("target").join(slices, "cell_id")
    knn = _held(neighbours.knn_controls(asking, embedding, cfg.control, cfg.num_neighbors, cfg.ndims, cfg.split_by, cfg.exclude_self))
    chosen = genes if shared_embedding else genes.withColumn("slice", F.col("target"))
    sign = _held(neighbours.signature(expr, knn, cfg.num_neighbors, chosen))
    scores, loo = score.projection_scores(sign, cells, cfg.control, genes)
    kind = cells.select("cell_id", "cell_type")
    return Scores(_held(scores.join(kind, "cell_id")), _held(loo.join(kind, "cell_id")), knn if cfg.store_neighbors else None)


def _genes_by_guide(expr: DataFrame, cells: DataFrame, cfg: ScreenConfig, targets: list[str], n_genes: int) -> DataFrame:
    """Genes that pass for any guide of a target, the smallest p of them first."""
    named = cells.withColumn("guide__", F.when(F.col("target") == cfg.control, F.lit(cfg.control)).otherwise(F.concat_ws("\t", "target", F.coalesce(F.col(cfg.guide_col), F.lit("")))))
    guides = [r[0] for r in named.filter(F.col("target").isin(targets)).select("guide__").distinct().orderBy("guide__").collect()]
    tests = score.rank_sum(expr, named, cfg.control, guides, "guide__").withColumn("target", F.substring_index("target", "\t", 1))
    best = tests.groupBy("target", "gene_id").agg(F.min_by(F.struct("log2fc", "z", "p"), "p").alias("b")).select("target", "gene_id", "b.*")
    return score.score_genes(best, n_genes, cfg.logfc_threshold, cfg.min_de_genes, cfg.max_de_genes)


def weighted_de(screen: Screen, cfg: ScreenConfig, scores: Scores | None = None) -> DataFrame:
    """The result of every target: weighted where it has scores, else by binary weights.

    Targets whose weights don't vary, or without cells on either side, have no rows. With
    ``full_results``, coefficients come as arrays with their names.
    """
    targets = perturbations(screen.cells, cfg.control, cfg.targets)
    cells = foldchange.with_stratum(screen.cells, cfg.split_by)
    scored = [r[0] for r in scores.scores.select("target").distinct().collect()] if scores else []
    rest = [t for t in targets if t not in scored]
    all_weights = weights.binary_of(cells, rest, cfg.control) if rest else None
    if scored:
        w = weights.standardized(scores.scores.filter(F.col("target").isin(targets)), cfg.control).select("target", "cell_id", "gene", "weight")
        all_weights = w if all_weights is None else w.unionByName(all_weights)
    all_weights = _held(all_weights)
    routing.unmatched(all_weights, cells)
    designs = _held(routing.design(all_weights, cells))
    designs = _held(designs.join(routing.varying_targets(designs), "target", "left_semi"))
    stats = foldchange.gates(foldchange.fold_change_stats(screen.counts, cells, cfg.control, targets, cfg.pseudocount, cfg.base), cfg.logfc_threshold, cfg.min_pct, cfg.min_cells_group)
    stats = _held(stats.join(designs.select("target").distinct(), "target", "left_semi"))
    de_set = _held(foldchange.de_genes(stats, screen.genes))
    loo_weights = None
    if scored:
        loo_weights = _held(weights.leave_one_out(scores.loo, cfg.control).select("target", "loo_gene", "cell_id", "weight"))
        weighted = designs.filter(F.col("target").isin(scored))
        loo = _held(routing.loo_targets(loo_weights, weighted, screen.genes))
        own = dashed(F.col("target"))
        loo_weights = loo_weights.filter(F.col("loo_gene") != own).unionByName(routing.own_gene_weights(weighted, loo))
        genes = routing.route(de_set, loo)
    else:
        genes = de_set.withColumn("fit_group", F.lit("main"))
    strata = [r[0] for r in cells.filter("cell_type is not null").select("cell_type").distinct().orderBy("cell_type").collect()] if cfg.split_by else [foldchange.STRATUM]
    fits = _held(glm.fit(screen.counts, designs, _held(genes), loo_weights, strata, cfg.subsample))
    names = glm.design_columns(strata)
    at = next(i for i, n in enumerate(names) if n.endswith("weight"))
    methods = screen.cells.sparkSession.createDataFrame([(t, "weighted" if t in scored else "standard") for t in targets], "target string, method string")
    changes = foldchange.masked(stats)
    if cfg.full_results:
        wide = foldchange.wide(changes, strata)
        return fits.join(wide, ["target", "gene_id"], "left").join(methods, "target").withColumn("coefficients", F.array(*map(F.lit, names)))
    if len(strata) > 1:
        changes = foldchange.wide(changes, strata)
        changes = changes.select("target", "gene_id", F.coalesce(*(F.col(f"`log2FC_{s}`") for s in strata)).alias("log2fc"))
    else:
        changes = changes.select("target", "gene_id", "log2fc")
    flat = fits.select("target", "gene_id", F.get("beta", F.lit(at)).alias("beta_weight"), F.get("p", F.lit(at)).alias("p_weight"))
    return routing.result(flat, changes, methods, cfg.bh_universe)


def analyse(screen: Screen, cfg: ScreenConfig, guides: DataFrame | None = None, shared_embedding: bool = False, score_col: str = "perturbation_score") -> tuple[DataFrame, DataFrame]:
    """(result, cells with their score, null for cells without one): the whole analysis."""
    ready = prepare(screen, cfg, guides)
    ready = replace(ready, counts=_held(ready.counts), cells=_held(ready.cells), genes=_held(ready.genes))
    targets = perturbations(ready.cells, cfg.control, cfg.targets)
    scores = perturbation_scores(ready, cfg, targets, shared_embedding)
    return weighted_de(ready, cfg, scores), with_score(ready.cells, scores, score_col)


def with_score(cells: DataFrame, scores: Scores | None, score_col: str = "perturbation_score") -> DataFrame:
    """Cells with the score of their own target, null for the others."""
    if scores is None:
        return cells
    of_cell = scores.scores.filter(F.col("gene") == F.col("target")).select("cell_id", F.col("pvec").alias(score_col))
    return cells.join(of_cell, "cell_id", "left")
