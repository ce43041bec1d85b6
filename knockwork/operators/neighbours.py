"""Nearest control cells and the perturbation signature."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from knockwork.functions.columns import require

#: Control cells and queries of a split that meet in one task.
POOL, QUERIES = 50_000, 20_000
#: Distances that a worker holds at once, and controls beyond the k nearest whose distances are taken exactly.
DISTANCES, MORE = 2_000_000, 16


def knn_controls(cells: DataFrame, embedding: DataFrame, control: str, k: int = 20, ndims: int = 30, split_by: str | None = None, exclude_self: bool = False, pool: int = POOL, queries: int = QUERIES) -> DataFrame:
    """(query_cell, nt_cell, rank, distance): the k nearest control cells of every cell, by Euclidean distance.

    Ties go to the smaller id. A control cell is its own nearest neighbour unless ``exclude_self``.
    With ``split_by``, queries and controls are those of the same split; where ``cells`` and ``embedding``
    have a column ``slice``, also of the same slice, which the result has too. An error where a split
    has fewer than k controls or an embedding fewer than ``ndims`` dimensions.

    Blocks of queries meet blocks of controls, each pair of blocks in a task; the k nearest of each are ranked again where
    a split has several blocks of controls.
    """
    require(cells, "cell_id", "target", *([split_by] if split_by else []), what="cells")
    sliced = "slice" in cells.columns
    slice_ = F.col("slice").cast("string") if sliced else F.lit("")
    split = F.coalesce(F.col(split_by).cast("string"), F.lit("")) if split_by else F.lit("all")
    points = cells.withColumn("split", split).select(slice_.alias("slice"), "cell_id", "target", "split")
    points = points.join(embedding if sliced else embedding.withColumn("slice", F.lit("")), ["slice", "cell_id"])
    if points.filter(F.size("embedding") < ndims).take(1):
        raise ValueError(f"embeddings have fewer than {ndims} dimensions")
    is_control = F.col("target") == control
    points = points.select("slice", "split", "cell_id", F.coalesce(is_control, F.lit(False)).alias("control"), F.slice("embedding", 1, ndims).cast("array<double>").alias("embedding"))
    size = points.groupBy("slice", "split").agg(F.count(F.when(F.col("control"), 1)).alias("n"), F.count("*").alias("m"))
    if few := size.filter(F.col("n") < k).select("split", "n").take(1):
        raise ValueError(f"split {few[0][0]} has {few[0][1]} control cells; {k} are needed")
    parts = size.select("slice", "split", F.ceil(F.col("n") / pool).cast("long").alias("p"), F.ceil(F.col("m") / queries).cast("long").alias("q"))
    dealt = points.join(F.broadcast(parts), ["slice", "split"]).withColumn("h", F.xxhash64("cell_id"))

    def every(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    controls = dealt.filter("control").select("slice", "split", F.pmod("h", F.col("p")).alias("pool"), every("q").alias("block"), "cell_id", "embedding")
    controls = controls.toDF(*controls.columns)  # columns of its own beside those of the queries
    asking = dealt.select("slice", "split", every("p").alias("pool"), F.pmod("h", F.col("q")).alias("block"), "cell_id", "embedding")
    kind = cells.schema["cell_id"].dataType.simpleString()
    by = ["slice", "split", "block", "pool"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["slice", "query_cell", "nt_cell", "rank", "distance"]
        if not left.num_rows or not right.num_rows:
            return pa.table([left.column("slice").slice(0, 0), left.column("cell_id").slice(0, 0), left.column("cell_id").slice(0, 0), pa.array([], pa.int32()), pa.array([], pa.float64())], names)
        right = right.sort_by("cell_id")
        query, at, distance = _nearest(_points(left), _points(right), k, _same(left, right) if exclude_self else None)
        again, found = pa.array(query), pa.array(at)
        first = np.concatenate(([0], np.flatnonzero(np.diff(query)) + 1)) if len(query) else np.zeros(0, int)
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query)))) + 1
        return pa.table([left.column("slice").take(again), left.column("cell_id").take(again), right.column("cell_id").take(found), pa.array(rank, pa.int32()), pa.array(distance)], names)

    best = asking.groupBy(*by).cogroup(controls.groupBy(*by)).applyInArrow(meet, f"slice string, query_cell {kind}, nt_cell {kind}, rank int, distance double")
    if parts.filter("p > 1").take(1):
        again = F.row_number().over(W.partitionBy("slice", "query_cell").orderBy("distance", "nt_cell"))
        best = best.withColumn("rank", again).filter(F.col("rank") <= k)
    return best if sliced else best.drop("slice")


def _points(table: pa.Table) -> np.ndarray:
    column = table.column("embedding").combine_chunks()
    return np.asarray(column.flatten(), float).reshape(table.num_rows, -1)


def _same(left: pa.Table, right: pa.Table) -> np.ndarray:
    """Of each row of ``left``, the row of ``right`` with its cell; -1 for none."""
    place = {c: i for i, c in enumerate(right.column("cell_id").to_pylist())}
    return np.array([place.get(c, -1) for c in left.column("cell_id").to_pylist()])


def _nearest(q: np.ndarray, x: np.ndarray, k: int, skip: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, control, distance) of the k nearest controls of each query, nearest first, ties to the first control.

    A product of matrices finds a few more than k that may be the nearest; their distances are then taken exactly. Queries
    for which rounding leaves it open whether others are as near are compared with all controls.
    """
    out = []
    xx = (x * x).sum(1)
    wide = min(len(x), k + MORE + (skip is not None))
    for begin in range(0, len(q), step := max(1, DISTANCES // len(x))):
        some = q[begin : begin + step]
        rough = xx[None, :] - 2 * (some @ x.T)
        if skip is not None:
            own = skip[begin : begin + step]
            rough[np.flatnonzero(own >= 0), own[own >= 0]] = np.inf
        near = np.argpartition(rough, wide - 1, axis=1)[:, :wide] if wide < len(x) else np.tile(np.arange(len(x)), (len(some), 1))
        near.sort(axis=1)
        exact = np.sqrt(((some[:, None, :] - x[near]) ** 2).sum(2))
        if skip is not None:
            exact[near == own[:, None]] = np.inf
        order = np.argsort(exact, axis=1, kind="stable")[:, :k]
        at, distance = np.take_along_axis(near, order, 1), np.take_along_axis(exact, order, 1)
        if wide < len(x):
            edge = np.take_along_axis(rough, near, 1).max(1)
            norm = (some * some).sum(1)
            sure = distance[:, -1] ** 2 - norm + 1e-9 * (norm + xx.max()) < edge
            for i in np.flatnonzero(~sure).tolist():
                d = np.sqrt(((some[i] - x) ** 2).sum(1))
                if skip is not None and own[i] >= 0:
                    d[own[i]] = np.inf
                at[i] = np.argsort(d, kind="stable")[:k]
                distance[i] = d[at[i]]
        rows, columns = np.nonzero(np.isfinite(distance))
        out.append((begin + rows, at[rows, columns], distance[rows, columns]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def signature(expr: DataFrame, knn: DataFrame, k: int, genes: DataFrame | None = None) -> DataFrame:
    """(cell_id, gene_id, prtb): a cell's expression less the log mean of its neighbours'.

    Means are of linear expression, over k cells whether they express the gene or not.
    A pair that neither side expresses has no row and stands for 0. With ``genes``, only those. Where ``knn`` has a
    column ``slice``, so has the result, and ``genes`` are those of each slice.
    """
    by = ["slice"] if "slice" in knn.columns else []
    linear = expr
    if genes is not None:
        wanted = genes.select(*by, "gene_id").distinct()
        linear = expr.join(wanted.select("gene_id").distinct(), "gene_id", "left_semi")
        if not linear.take(1):
            raise ValueError("none of the genes asked for is in the expression table")
    own = knn.select(*by, F.col("query_cell").alias("cell_id")).distinct().join(linear, "cell_id").select(*by, "cell_id", "gene_id", F.col("expr").alias("v"))
    theirs = knn.join(linear.select(F.col("cell_id").alias("nt_cell"), "gene_id", F.expm1("expr").alias("lin")), "nt_cell")
    if genes is not None and by:
        own, theirs = (x.join(F.broadcast(wanted), [*by, "gene_id"], "left_semi") for x in (own, theirs))
    around = theirs.groupBy(*by, F.col("query_cell").alias("cell_id"), "gene_id").agg((-F.log1p(F.sum("lin") / k)).alias("v"))
    return own.unionByName(around).groupBy(*by, "cell_id", "gene_id").agg(F.sum("v").alias("prtb"))
