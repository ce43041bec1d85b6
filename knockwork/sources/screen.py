"""A screen as three tables: counts (cell_id, gene_id, count), cells (cell_id, target, …) and genes (gene_id, feature_index).

Zeros aren't stored. Order, which the tables lack, is in feature_index and cell_index.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knockwork.config import ScreenConfig
from knockwork.functions.columns import require
from knockwork.functions.names import dashed, make_unique


log = logging.getLogger(__name__)

#: Rows (cells, or genes of a matrix that is stored by gene) of an AnnData file that a task reads at once.
H5AD_ROWS = 2000


@dataclass(frozen=True)
class Screen:
    counts: DataFrame
    cells: DataFrame
    genes: DataFrame

    def write(self, path: str) -> None:
        for name in ("counts", "cells", "genes"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")


def read_screen(spark: SparkSession, path: str) -> Screen:
    return Screen(*(spark.read.parquet(f"{path}/{n}") for n in ("counts", "cells", "genes")))


def read_h5ad(spark: SparkSession, path: str, target_col: str = "target_gene", max_features: int | None = None) -> Screen:
    """A screen in an AnnData file, where h5py is installed; the file lies where all executors see it.

    The driver reads the tables of both axes; tasks read ranges of rows of the matrix, sparse by cell or gene or dense.
    """
    try:
        import h5py
    except ImportError as e:
        raise RuntimeError("h5ad files need h5py; convert the file to tables of triplets, cells and genes elsewhere") from e

    def text(x) -> list[str]:
        return [v.decode() if isinstance(v, bytes) else str(v) for v in x]

    with h5py.File(path, "r") as f:
        x, obs, var = f["X"], f["obs"], f["var"]
        sparse = isinstance(x, h5py.Group)
        n_cells, n_genes = (int(v) for v in (x.attrs["shape"] if sparse else x.shape))
        by_cell = not sparse or "csr" in str(x.attrs["encoding-type"])
        cells = pd.DataFrame({"cell_index": range(n_cells), "cell_id": text(obs[obs.attrs["_index"]][:])})
        for name in obs:
            if name != obs.attrs["_index"]:
                column = obs[name]
                if isinstance(column, h5py.Group):
                    labels = text(column["categories"][:])
                    cells[name] = [labels[c] if c >= 0 else None for c in column["codes"][:]]
                else:
                    values = column[:]
                    cells[name] = text(values) if values.dtype.kind in "SOU" else values
        genes = pd.DataFrame({"feature_index": range(n_genes), "gene_id": text(var[var.attrs["_index"]][:])})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import h5py
        import numpy as np

        with h5py.File(path, "r") as f:
            x = f["X"]
            for a, b in ((int(i), min(int(i) + H5AD_ROWS, n_cells if by_cell else n_genes)) for batch in batches for i in batch["id"]):
                if sparse:
                    edge = np.asarray(x["indptr"][a : b + 1]).astype(np.int64)
                    major, minor = np.repeat(np.arange(a, b), np.diff(edge)), np.asarray(x["indices"][edge[0] : edge[-1]])
                    data = np.asarray(x["data"][edge[0] : edge[-1]])
                else:
                    block = np.asarray(x[a:b])
                    major, minor = np.nonzero(block)
                    data, major = block[major, minor], major + a
                cell, gene = (major, minor) if by_cell else (minor, major)
                yield pd.DataFrame({"cell_index": cell.astype(np.int64), "feature_index": gene.astype(np.int64), "count": data.astype(float)})

    size = n_cells if by_cell else n_genes
    starts = spark.range(0, max(size, 1), H5AD_ROWS, max(1, -(-size // H5AD_ROWS)))
    triplets = starts.mapInPandas(read, "cell_index long, feature_index long, count double")
    return from_triplets(triplets, spark.createDataFrame(cells), spark.createDataFrame(genes), target_col, max_features)


def from_dense(dense: DataFrame, cell: str = "cell_index", values: str = "values") -> DataFrame:
    """Triplets of rows that hold all values of a cell as an array."""
    spread = dense.select(F.col(cell).alias("cell_index"), F.posexplode(values).alias("feature_index", "count"))
    return spread.filter("count <> 0").withColumn("count", F.col("count").cast("double"))


def cap_features(genes: DataFrame, most: int | None) -> DataFrame:
    """The first ``most`` features by index; all when it is null or not above zero."""
    return genes if not most or most <= 0 else genes.filter(F.col("feature_index") < most)


def from_triplets(triplets: DataFrame, cells: DataFrame, genes: DataFrame, target_col: str = "target", max_features: int | None = None) -> Screen:
    """A screen of matrix triplets (cell_index, feature_index, count) and the tables of both axes.

    Features are capped, then renamed with dashes and made unique; cells are made unique.
    Triplets of the same place are summed and zeros dropped.
    """
    require(cells, "cell_index", "cell_id", target_col, what="cells")
    require(genes, "feature_index", "gene_id", what="genes")
    require(triplets, "cell_index", "feature_index", "count", what="triplets")
    kept = cap_features(genes, max_features)
    named = make_unique(kept.withColumn("gene_id", dashed(F.col("gene_id"))), "gene_id", "feature_index", "unique_id").drop("gene_id").withColumnRenamed("unique_id", "gene_id")
    barcodes = make_unique(cells, "cell_id", "cell_index", "unique_id").drop("cell_id").withColumnRenamed("unique_id", "cell_id")
    counts = triplets.groupBy("cell_index", "feature_index").agg(F.sum(F.col("count").cast("double")).alias("count")).filter("count <> 0")
    counts = counts.join(named.select("feature_index", "gene_id"), "feature_index").join(barcodes.select("cell_index", "cell_id"), "cell_index")
    return Screen(counts.select("cell_id", "gene_id", "count"), barcodes.withColumnRenamed(target_col, "target"), named)


def read_guides(spark: SparkSession, path: str, cell_col: str = "cell", guide_col: str = "pair_key") -> DataFrame:
    """(cell_id, guide, row): a CSV whose first column is its index, which isn't a column any more, in the order of its rows.

    An error where the index repeats or isn't there.
    """
    table = spark.read.csv(path, header=True, inferSchema=False)
    index = table.columns[0]
    if again := table.groupBy(F.col(f"`{index}`")).count().filter("count > 1").take(1):
        raise ValueError(f"the index of {path} has {again[0][0]!r} more than once")
    rest = require(table.drop(index), cell_col, guide_col, what="guide table")
    return rest.select(F.col(cell_col).alias("cell_id"), F.col(guide_col).alias("guide"), F.monotonically_increasing_id().alias("row"))


def first_match(guides: DataFrame, key: str = "cell_id", order: str = "row") -> DataFrame:
    """One row for each key: the first in order."""
    others = [c for c in guides.columns if c not in (key, order)]
    first = F.min_by(F.struct(*others), order)
    return guides.groupBy(key).agg(first.alias("first__")).select(key, *(F.col(f"first__.{c}").alias(c) for c in others))


def add_guides(cells: DataFrame, guides: DataFrame) -> DataFrame:
    """Cells with the guide of their first match, null for none; an error when no cell has any."""
    out = cells.join(first_match(guides), "cell_id", "left")
    n, found = out.agg(F.count("*"), F.count("guide")).first()
    log.info("%d of %d cells have no guide", n - found, n)
    if not found:
        raise ValueError("no cell has a guide: check the key columns of both tables")
    return out


def subset(cells: DataFrame, targets: list[str], control: str) -> DataFrame:
    """Cells of some targets and of the control; a null target is never one of them. An error when none is left."""
    kept = cells.filter(F.col("target").isin([*targets, control]))
    n = kept.count()
    log.info("%d cells of %d targets and %s", n, len(targets), control)
    if not n:
        raise ValueError(f"no cells of {', '.join(targets)} or {control}")
    return kept


def library_size(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells with n_count, the sum of their counts; 0 for a cell without any. A column of that name is replaced."""
    totals = counts.groupBy("cell_id").agg(F.sum("count").alias("n_count"))
    return cells.drop("n_count").join(totals, "cell_id", "left").withColumn("n_count", F.coalesce("n_count", F.lit(0).cast(totals.schema["n_count"].dataType)))


def cap_controls(cells: DataFrame, control: str, most: int | None, by: str = "target") -> DataFrame:
    """At most ``most`` control cells, chosen by a hash of their id."""
    if not most:
        return cells
    chosen = cells.filter(F.col(by) == control).orderBy(F.xxhash64("cell_id"), "cell_id").limit(most)
    return cells.filter(~F.col(by).eqNullSafe(control)).unionByName(chosen)


def prepare(screen: Screen, cfg: ScreenConfig, guides: DataFrame | None = None) -> Screen:
    """Guides joined, cells narrowed to what is asked for, library sizes of what is left."""
    cells = screen.cells if guides is None else add_guides(screen.cells, guides)
    targets = list(cfg.targets or [])
    if cfg.subset and targets:
        cells = subset(cells, targets, cfg.control)
    cells = cap_controls(cells, cfg.control, cfg.max_control_cells)
    counts = screen.counts.join(cells.select("cell_id"), "cell_id", "left_semi")
    return replace(screen, counts=counts, cells=library_size(counts, cells))


def perturbations(cells: DataFrame, control: str, requested: tuple[str, ...] | None = None) -> list[str]:
    """Labels other than the control, sorted, narrowed to those asked for; an error when none is left."""
    labels = [r[0] for r in cells.filter(F.col("target").isNotNull() & (F.col("target") != control)).select("target").distinct().orderBy("target").collect()]
    labels = [x for x in labels if requested is None or x in requested]
    if not labels:
        raise ValueError("no perturbation that is asked for has cells")
    return labels


