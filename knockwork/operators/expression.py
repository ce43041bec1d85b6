"""Normalised expression, variable genes, scaling and principal components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from knockwork.functions.held import held

SCALE = 10_000
CLIP = 10.0
#: Cells of a slice whose products a task sums, those that it projects, those it holds as dense rows at once, and rows of a table of products that travel together.
SUMMED, CHUNK, DENSE, GRAM_ROWS = 65_536, 8192, 512, 128
#: Products of dense rows that take as long as one of two expressed genes of a cell; rows of a table that is broadcast at most.
SPARSE, FEW = 1000, 200_000


def log_normalize(counts: DataFrame, cells: DataFrame, scale: float = SCALE) -> DataFrame:
    """(cell_id, gene_id, expr): log1p of counts per ``scale``; cells without counts have no rows."""
    sized = counts.join(cells.select("cell_id", "n_count"), "cell_id")
    return sized.filter("n_count > 0").select("cell_id", "gene_id", F.log1p(F.col("count") / F.col("n_count") * scale).alias("expr"))


def _loess(x: np.ndarray, y: np.ndarray, span: float = 0.3) -> np.ndarray:
    """Local quadratic fit with tricube weights at up to 200 places, linear between them."""
    n, k = len(x), max(4, int(np.ceil(span * len(x))))
    if n < 4 or np.ptp(x) == 0:
        return np.full(n, y.mean() if n else 0.0)
    order = np.argsort(x, kind="stable")
    xs, ys = x[order], y[order]
    at = np.unique(np.quantile(xs, np.linspace(0, 1, 200)))
    fit = []
    for c in at:
        lo = int(np.clip(np.searchsorted(xs, c) - k // 2, 0, max(0, n - k)))
        part = slice(lo, lo + k)
        d = np.abs(xs[part] - c)
        w = np.sqrt(np.clip(1 - (d / max(d.max(), 1e-12)) ** 3, 0, None) ** 3)
        a = np.vander(xs[part] - c, 3) * w[:, None]
        fit.append(np.linalg.lstsq(a, ys[part] * w, rcond=None)[0][-1])
    return np.interp(x, at, fit)


def sliced(cells: DataFrame, control: str, targets: list[str]) -> DataFrame:
    """(slice, cell_id, target) of every target's own cells and all control cells; a slice has its target's name."""
    each = F.when(F.col("target") == control, F.array(*map(F.lit, targets))).otherwise(F.array("target"))
    return cells.filter(F.col("target").isin([*targets, control])).select(F.explode(each).alias("slice"), "cell_id", "target")


def one_slice(cells: DataFrame) -> DataFrame:
    """All cells as one slice, whose name is ''."""
    return cells.select(F.lit("").alias("slice"), "cell_id", F.lit("").alias("target"))


def _by_slice(sums: DataFrame, slices: DataFrame) -> DataFrame:
    """Sums by label (``target``) as rows of every slice that has cells of the label: those of the control are made once for all."""
    return sums.join(F.broadcast(slices.select("slice", "target").distinct()), "target").drop("target")


def variable_genes(counts: DataFrame, n_cells: int | None = None, most: int = 2000, slices: DataFrame | None = None) -> DataFrame:
    """(slice, gene_id, mean, variance, expected, std_variance, rank) of the ``most`` genes of largest standardised variance in each slice.

    The expected variance is a local fit of log variance by log mean; standardised
    values are clipped at the root of the number of cells. Zeros enter by formula. Counts travel once, as
    sums by label and gene; only those beyond a clip are looked up again. A task fits
    one slice and holds a row for each of its genes. Without ``slices`` all cells are one, of
    ``n_cells``, and there is no column for it.
    """
    if slices is None:
        spread = counts.withColumn("target", F.lit(""))
        sizes = counts.sparkSession.createDataFrame([("", float(n_cells))], "slice string, n double")
        names = sizes.select("slice", F.lit("").alias("target"))
    else:
        spread = counts.join(slices.select("cell_id", "target").distinct(), "cell_id")
        sizes = slices.groupBy("slice").agg(F.count("*").cast("double").alias("n"))
        names = slices
    spread = spread.select("target", "gene_id", F.col("count").cast("double").alias("count"))
    c, less = F.col("count"), F.greatest(F.col("n") - 1, F.lit(1.0))
    sums = spread.groupBy("target", "gene_id").agg(F.sum("count").alias("s"), F.sum(c * c).alias("ss"), F.max("count").alias("largest"))
    stats = _by_slice(sums, names).groupBy("slice", "gene_id").agg(F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.max("largest").alias("largest")).join(F.broadcast(sizes), "slice")
    stats = stats.select("slice", "gene_id", "n", (F.col("s") / F.col("n")).alias("mean"), ((F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / less).alias("variance"), "largest")

    def fit(table: pa.Table) -> pa.Table:
        mean, variance = (np.asarray(table.column(c), float) for c in ("mean", "variance"))
        good, expected = variance > 0, np.zeros(table.num_rows)
        if good.any():
            expected[good] = 10 ** _loess(np.log10(mean[good]), np.log10(variance[good]))
        return table.append_column("expected", pa.array(expected))

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema)
    fitted = held(stats.groupBy("slice").applyInArrow(fit, f"{kind}, expected double").filter("expected > 0"))
    beyond = fitted.withColumn("clip", F.col("mean") + F.sqrt(F.col("n") * F.col("expected"))).filter(F.col("largest") > F.col("clip")).select("slice", "gene_id", "n", "mean", "expected", "clip")
    scored = fitted.withColumn("std_variance", F.col("variance") / F.col("expected"))
    if many := beyond.count():
        lowest = beyond.groupBy("gene_id").agg(F.min("clip").alias("lowest"))
        high = spread.join(F.broadcast(lowest) if many <= FEW else lowest, "gene_id").filter(c > F.col("lowest"))
        times = _by_slice(high.groupBy("target", "gene_id", "count").agg(F.count("*").cast("double").alias("cells")), names)
        z = (c - F.col("mean")) / F.sqrt("expected")
        over = times.join(beyond, ["slice", "gene_id"]).filter(c > F.col("clip")).groupBy("slice", "gene_id").agg(F.sum(F.col("cells") * (z * z - F.col("n"))).alias("over"))
        scored = scored.join(over, ["slice", "gene_id"], "left").withColumn("std_variance", F.col("std_variance") - F.coalesce("over", F.lit(0.0)) / less)
    best = scored.withColumn("rank", F.row_number().over(W.partitionBy("slice").orderBy(F.col("std_variance").desc(), "gene_id"))).filter(F.col("rank") <= most)
    return best.select(*([] if slices is None else ["slice"]), "gene_id", "mean", "variance", "expected", "std_variance", "rank")


def pca(expr: DataFrame, slices: DataFrame, genes: DataFrame, k: int = 50) -> DataFrame:
    """(slice, cell_id, embedding): principal components of scaled expression of each slice's ``genes`` (slice, gene_id).

    Scaling clips at 10 deviations. Cells travel as what their expressed ones of the chosen genes are above a cell that
    expresses none; a constant row doesn't change the covariance, so cells without any take no part in it and all have the
    place of that cell. A task sums the products of ``SUMMED`` cells of a slice, gene by gene or as ``DENSE`` dense rows
    at once, whichever is less work, and sends what isn't zero; a slice's table of products, 2,000 by 2,000 as a rule,
    is decomposed in one task. Each component's sign is that which makes its largest loading positive.
    """
    kind = expr.schema["cell_id"].dataType.simpleString()
    chosen = held(genes.select("slice", "gene_id"))
    near = F.broadcast if chosen.count() <= FEW else lambda x: x
    sizes = slices.groupBy("slice").agg(F.count("*").cast("double").alias("n"))
    every = W.partitionBy("slice")
    named = chosen.select("slice", "gene_id", (F.row_number().over(every.orderBy("gene_id")) - 1).alias("place"), F.count("*").over(every).cast("int").alias("size"))
    wanted = held(expr.join(near(chosen.select("gene_id").distinct()), "gene_id", "left_semi").select("cell_id", "gene_id", "expr"))
    labels = slices.select("cell_id", "target").distinct()
    sums = wanted.join(labels, "cell_id").groupBy("target", "gene_id").agg(F.sum("expr").alias("s"), F.sum(F.col("expr") * F.col("expr")).alias("ss"))
    moments = _by_slice(sums, slices).groupBy("slice", "gene_id").agg(F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    mean = F.coalesce("s", F.lit(0.0)) / F.col("n")
    var = (F.coalesce("ss", F.lit(0.0)) - F.col("n") * mean * mean) / F.greatest(F.col("n") - 1, F.lit(1.0))
    scaled = held(named.join(sizes, "slice").join(moments, ["slice", "gene_id"], "left").select("slice", "gene_id", "place", "size", "n", mean.alias("m"), F.when(var > 0, F.sqrt(var)).otherwise(1.0).alias("sd")))

    def level(v):
        return F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), (v - F.col("m")) / F.col("sd")))

    listed = F.sort_array(F.collect_list(F.struct("place", level(F.lit(0.0)).alias("none")))).alias("g")
    tables = scaled.groupBy("slice", "n").agg(listed).select("slice", "n", F.transform("g", lambda x: x["none"]).alias("none"))
    entries = wanted.join(slices.select("slice", "cell_id"), "cell_id").join(near(scaled), ["slice", "gene_id"]).withColumn("value", level(F.col("expr")) - level(F.lit(0.0)))
    cells = entries.groupBy("slice", "cell_id").agg(F.collect_list("place").alias("places"), F.collect_list("value").alias("values"), F.first("size").alias("size"), F.first("n").alias("n"))

    def lists(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and values of all rows, one after another, and how many each row has."""
        places, values = part.column("places"), part.column("values")
        return np.asarray(places.flatten()), np.asarray(values.flatten()), np.asarray(pc.list_value_length(places))

    def dense(place: np.ndarray, value: np.ndarray, held_: np.ndarray, size: int) -> np.ndarray:
        x = np.zeros((len(held_), size))
        x[np.repeat(np.arange(len(held_)), held_), place] = value
        return x

    def gather(out: np.ndarray, place: np.ndarray, value: np.ndarray, held_: np.ndarray) -> None:
        """Add the products of some rows, and the rows themselves to the last one."""
        size = out.shape[1]
        if int((held_.astype(np.int64) ** 2).sum()) * SPARSE > len(held_) * size * size:
            x = dense(place, value, held_, size)
            out[:-1] += x.T @ x
        else:
            times = np.repeat(held_, held_).astype(np.int64)  # of each entry, the entries of its row
            begin = np.repeat(np.cumsum(held_) - held_, held_)
            left = np.repeat(np.arange(len(place)), times)
            right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times - begin, times)
            np.add.at(out[:-1].reshape(-1), place[left].astype(np.int64) * size + place[right], value[left] * value[right])
        out[-1] += np.bincount(place, value, minlength=size)

    def packed(name: str, size: int, rows: int, blocks: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        """Blocks of a table of products: all numbers, or where fewer, those that aren't zero and their places."""
        at, sums = [], []
        for _, block in blocks:
            there = np.flatnonzero(block).astype(np.int32)
            sparse = 3 * len(there) < 2 * len(block)
            at.append(there.tobytes() if sparse else None)
            sums.append((block[there] if sparse else block).tobytes())
        n = len(blocks)
        columns = [pa.array([name] * n, pa.string()), pa.array([i for i, _ in blocks], pa.int64()), pa.array([size] * n, pa.int32()), pa.array([rows] * n, pa.int64()), pa.array(at, pa.binary()), pa.array(sums, pa.binary())]
        return pa.record_batch(columns, ["slice", "block", "size", "rows", "at", "sums"])

    def unpacked(table: pa.Table, length: int) -> np.ndarray:
        """The sum of packed blocks of one place."""
        total = np.zeros(length)
        for at, sums in zip(table.column("at"), table.column("sums"), strict=True):
            x = np.frombuffer(sums.as_buffer())
            if at.is_valid:
                total[np.frombuffer(at.as_buffer(), np.int32)] += x
            else:
                total += x
        return total

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of products of columns, some rows of the table at a time, and the columns' sums as its last row, of each slice that a task meets."""
        name, rows, out = None, 0, None

        def told() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(out), GRAM_ROWS):
                yield packed(name, out.shape[1], rows, [(i // GRAM_ROWS, out[i : i + GRAM_ROWS].reshape(-1))])

        for batch in batches:
            codes = np.asarray(batch.column("slice").dictionary_encode().indices)
            edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if out is None or batch.column("slice")[a].as_py() != name:
                    if out is not None:
                        yield from told()
                    size = batch.column("size")[a].as_py()
                    name, rows, out = batch.column("slice")[a].as_py(), 0, np.zeros((size + 1, size))
                for i in range(a, b, DENSE):
                    gather(out, *lists(batch.slice(i, min(DENSE, b - i))))
                rows += b - a
        if out is not None:
            yield from told()

    def add(table: pa.Table) -> pa.Table:
        block, size = table.column("block")[0].as_py(), table.column("size")[0].as_py()
        total = unpacked(table, (min(size + 1, (block + 1) * GRAM_ROWS) - block * GRAM_ROWS) * size)
        return pa.Table.from_batches([packed(table.column("slice")[0].as_py(), size, pc.sum(table.column("rows")).as_py(), [(block, total)])])

    def decompose(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return pa.table({"slice": pa.array([], pa.string()), "rows": pa.array([], pa.int64()), "loadings": pa.array([], pa.binary()), "none": pa.array([], pa.list_(pa.float64()))})
        n, none = right.column("n")[0].as_py(), np.asarray(right.column("none")[0].values, float)
        size = len(none)
        table = np.zeros((size + 1, size))
        for i in range(left.num_rows):
            begin = left.column("block")[i].as_py() * GRAM_ROWS
            place = table[begin : begin + GRAM_ROWS].reshape(-1)
            place += unpacked(left.slice(i, 1), len(place))
        centre = table[-1] / n
        values, vectors = np.linalg.eigh((table[:-1] - n * np.outer(centre, centre)) / max(n - 1, 1))
        vectors = vectors[:, ::-1][:, : min(k, size)]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
        rows = left.column("rows")[0].as_py() if left.num_rows else 0
        return pa.table([right.column("slice").slice(0, 1), pa.array([rows], pa.int64()), pa.array([np.ascontiguousarray(vectors).tobytes()], pa.binary()), pa.array([(none @ vectors).tolist()], pa.list_(pa.float64()))], ["slice", "rows", "loadings", "none"])

    def project(left: pa.Table, right: pa.Table) -> pa.Table:
        none = np.asarray(right.column("none")[0].values, float) if right.num_rows else np.zeros(0)
        found = [np.zeros((0, len(none)))]
        if left.num_rows and right.num_rows:
            w = np.frombuffer(right.column("loadings")[0].as_buffer()).reshape(-1, len(none))
            for i in range(0, left.num_rows, DENSE):
                found.append(none + dense(*lists(left.slice(i, DENSE).combine_chunks().to_batches()[0]), len(w)) @ w)
        x = np.concatenate(found)
        embedding = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(none), pa.int32()), pa.array(x.reshape(-1)))
        return pa.table([left.column("slice").slice(0, len(x)), left.column("cell_id").slice(0, len(x)), embedding], ["slice", "cell_id", "embedding"])

    def part(n):
        return F.pmod(F.xxhash64("cell_id"), n)

    block = "slice string, block long, size int, rows long, at binary, sums binary"
    spread = cells.withColumn("part", part(F.ceil(F.col("n") / SUMMED))).repartition("slice", "part").sortWithinPartitions("slice").select("slice", "size", "places", "values")
    whole = spread.mapInArrow(products, block).groupBy("slice", "block").applyInArrow(add, block)
    loadings = held(whole.groupBy("slice").cogroup(tables.groupBy("slice")).applyInArrow(decompose, "slice string, rows long, loadings binary, none array<double>"))
    parts = loadings.select("slice", F.greatest(F.ceil(F.col("rows") / CHUNK), F.lit(1)).cast("long").alias("parts"))
    dealt = cells.join(F.broadcast(parts), "slice").select("slice", part(F.col("parts")).alias("part"), "cell_id", "places", "values")
    each = loadings.join(F.broadcast(parts), "slice").select("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "loadings", "none")
    by = ("slice", "part")
    projected = dealt.groupBy(*by).cogroup(each.groupBy(*by)).applyInArrow(project, f"slice string, cell_id {kind}, embedding array<double>")
    members = slices.select("slice", "cell_id").join(F.broadcast(loadings.select("slice", "none")), "slice")
    return members.join(projected, ["slice", "cell_id"], "left").select("slice", "cell_id", F.coalesce("embedding", "none").alias("embedding"))


def embed(counts: DataFrame, cells: DataFrame, variable: int = 2000, k: int = 50, slices: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(expr, embedding) of each slice of cells; without ``slices`` all cells are one and there is no column for it."""
    expr = log_normalize(counts, cells)
    given = one_slice(cells) if slices is None else slices
    embedding = pca(expr, given, variable_genes(counts, None, variable, given), k)
    return expr, embedding.drop("slice") if slices is None else embedding
