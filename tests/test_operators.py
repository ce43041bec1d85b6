import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from knockwork.config import ScreenConfig
from knockwork.functions.stats import bh_adjust, wald_p
from knockwork.operators import expression, foldchange, glm, neighbours, routing, score, weights
from knockwork.plans import analysis
from knockwork.sources.screen import Screen


def scores(spark, rows):
    return spark.createDataFrame([("T", "con1", *r) for r in rows], "target string, cell_type string, cell_id string, gene string, pvec double")


def by_cell(df, column="weight"):
    return {r.cell_id: r[column] for r in df.collect()}


def test_weights(spark):
    got = by_cell(weights.standardized(scores(spark, [("a", "N", 0.0), ("b", "N", 2.0), ("c", "T", 3.0), ("d", "T", -5.0), ("e", "T", None), ("f", "T", math.nan)]), "N"))
    assert got == {"a": 0.0, "b": 0.0, "c": 1.0, "d": 0.0, "e": 0.0, "f": 0.0}


def test_weights_without_deviation(spark):
    for control in ([("a", "N", 1.0)], [("a", "N", 1.0), ("b", "N", 1.0)], [("a", "N", None)]):
        w = weights.standardized(scores(spark, [*control, ("c", "T", 3.0)]), "N")
        assert set(by_cell(w).values()) == {0.0}
        assert not w.agg(weights.varies().alias("v")).first().v


def test_binary_and_variation(spark):
    cells = spark.createDataFrame([("a", "T"), ("b", "N"), ("c", "O")], "cell_id string, target string")
    w = weights.binary(cells, "T", "N")
    assert by_cell(w) == {"a": 1.0, "b": 0.0}
    assert w.agg(weights.varies().alias("v")).first().v


def test_fold_change_counts_empty_cells_and_gates_apart(spark):
    cells = foldchange.with_stratum(spark.createDataFrame([("p1", "T"), ("p2", "T"), ("n1", "N"), ("n2", "N")], "cell_id string, target string"))
    counts = spark.createDataFrame([("p1", "g", 3.0), ("n1", "h", 1.0)], "cell_id string, gene_id string, count double")
    got = {r.gene_id: r for r in foldchange.gates(foldchange.fold_change_stats(counts, cells, "N", ["T"]), 1.0, 0.5, 2).collect()}
    assert got["g"].avg_log2fc == pytest.approx(math.log2(4 / 2) - math.log2(1 / 2))
    assert (got["g"].pass_pct, got["g"].pass_cell, got["g"].status) == (True, False, False)
    own = spark.createDataFrame([("T",), ("g",)], "gene_id string")
    stats = foldchange.gates(foldchange.fold_change_stats(counts, cells, "N", ["T"]), 99.0)
    assert [tuple(r) for r in foldchange.de_genes(stats, own).collect()] == [("T", "T")]


def test_fold_change_of_many_targets_is_that_of_each(spark):
    rng = np.random.default_rng(0)
    cells = foldchange.with_stratum(spark.createDataFrame([(i, "NAB"[i % 3]) for i in range(60)], "cell_id int, target string"))
    counts = spark.createDataFrame([(int(c), int(g), float(v)) for c, g, v in zip(rng.integers(0, 60, 200), rng.integers(0, 9, 200), rng.integers(1, 5, 200), strict=True)], "cell_id int, gene_id int, count double").groupBy("cell_id", "gene_id").agg(F.sum("count").alias("count"))
    both = {tuple(r) for r in foldchange.fold_change_stats(counts, cells, "N", ["A", "B"]).collect()}
    each = {tuple(r) for t in "AB" for r in foldchange.fold_change_stats(counts, cells, "N", [t]).collect()}
    assert both == each


def test_bh(spark):
    p = [0.01, 0.02, 0.02, None, 0.5, 1.0]
    df = spark.createDataFrame([("T", i, x) for i, x in enumerate(p)], "target_gene string, gene_id int, p_weight double")
    got = {r.gene_id: r.p_adj_bh for r in bh_adjust(df).collect()}
    assert got[3] is None
    assert [round(got[i], 6) for i in (0, 1, 2, 4, 5)] == [0.033333, 0.033333, 0.033333, 0.625, 1.0]
    wider = {r.gene_id: r.p_adj_bh for r in bh_adjust(df, universe=10).collect()}
    assert wider[0] >= got[0]


def test_wald():
    assert wald_p(1.959964, 1.0) == pytest.approx(0.05, abs=1e-6)
    assert wald_p(1.0, 0.0) is None and wald_p(1.0, math.inf) is None and wald_p(math.nan, 1.0) is None


def test_knn_errors_and_blocks(spark):
    cells = spark.createDataFrame([(i, "N" if i < 6 else "T") for i in range(9)], "cell_id int, target string")
    embedding = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(9)], "cell_id int, embedding array<double>")
    with pytest.raises(ValueError):
        neighbours.knn_controls(cells, embedding, "N", 7, 2)
    with pytest.raises(ValueError):
        neighbours.knn_controls(cells, embedding, "N", 2, 3)
    one = {(r.query_cell, r["rank"]): r.nt_cell for r in neighbours.knn_controls(cells, embedding, "N", 3, 2).collect()}
    assert one[(0, 1)] == 0 and [one[(2, i)] for i in (1, 2, 3)] == [2, 1, 3] and one[(8, 1)] == 5
    cut = {(r.query_cell, r["rank"]): r.nt_cell for r in neighbours.knn_controls(cells, embedding, "N", 3, 2, pool=2).collect()}
    assert cut == one
    other = {(r.query_cell, r["rank"]): r.nt_cell for r in neighbours.knn_controls(cells, embedding, "N", 2, 2, exclude_self=True).collect()}
    assert other[(0, 1)] == 1


def test_signature_of_its_own_neighbour_is_zero(spark):
    expr = spark.createDataFrame([(0, "g", 1.5)], "cell_id int, gene_id string, expr double")
    knn = spark.createDataFrame([(0, 0), (1, 0)], "query_cell int, nt_cell int")
    got = {r.cell_id: r.prtb for r in neighbours.signature(expr, knn, 1).collect()}
    assert got == {0: pytest.approx(0.0), 1: pytest.approx(-1.5)}
    with pytest.raises(ValueError):
        neighbours.signature(expr, knn, 1, spark.createDataFrame([("q",)], "gene_id string"))


def test_scaled_projection_equals_a_dense_one(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(12, 3)) * (rng.random((12, 3)) < 0.6)
    label = ["T"] * 5 + ["N"] * 7
    rows = [(i, g, float(x[i, g])) for i in range(12) for g in range(3) if x[i, g]]
    sign = spark.createDataFrame(rows, "cell_id int, gene_id int, prtb double")
    cells = spark.createDataFrame(list(enumerate(label)), "cell_id int, target string")
    genes = spark.createDataFrame([("T", g) for g in range(3)], "target string, gene_id int")
    got, loo = score.projection_scores(sign, cells, "N", genes)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    v = z[:5].mean(0) - z[5:].mean(0)
    assert np.allclose([by_cell(got, "pvec")[i] for i in range(12)], z @ v / (v @ v))
    left = {(r.cell_id, r.loo_gene): r.pvec for r in loo.collect()}
    keep = [0, 2]
    assert np.allclose([left[(i, 1)] for i in range(12)], z[:, keep] @ v[keep] / (v[keep] @ v[keep]))


def test_routing(spark):
    designs = spark.createDataFrame([("T", "a", "T"), ("T", "b", "N")], "target string, cell_id string, gene string")
    w = spark.createDataFrame([("T", "g", "a", 1.0), ("T", "g", "b", 0.0), ("T", "h", "a", 0.0), ("T", "h", "b", 0.0)], "target string, loo_gene string, cell_id string, weight double")
    genes = spark.createDataFrame([("g",), ("h",), ("T",)], "gene_id string")
    loo = routing.loo_targets(w, designs, genes)
    assert {r.loo_gene for r in loo.collect()} == {"g", "T"}
    de = spark.createDataFrame([("T", "g"), ("T", "h")], "target string, gene_id string")
    assert {(r.gene_id, r.fit_group) for r in routing.route(de, loo).collect()} == {("g", "g"), ("T", "T"), ("h", "main")}
    assert {r.cell_id: r.weight for r in routing.own_gene_weights(designs, loo).collect()} == {"a": 1.0, "b": 0.0}


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(11)
    for n, m, dims in ((300, 400, 5), (50, 30, 2), (200, 500, 1)):
        x, q = rng.integers(-4, 5, (m, dims)).astype(float), rng.integers(-4, 5, (n, dims)).astype(float)
        for shift in (0.0, 1e6):
            skip = rng.integers(-1, m, n)
            for own in (None, skip):
                d = np.sqrt((((q + shift)[:, None] - (x + shift)[None]) ** 2).sum(2))
                if own is not None:
                    d[np.flatnonzero(own >= 0), own[own >= 0]] = np.inf
                order = np.argsort(d, axis=1, kind="stable")[:, :7]
                query, at, distance = neighbours._nearest(q + shift, x + shift, 7, own)
                assert (query == np.repeat(np.arange(n), 7)).all() and (at == order.ravel()).all()
                assert np.allclose(distance, np.take_along_axis(d, order, 1).ravel())


def test_rank_sums_of_many_labels(spark):
    rng = np.random.default_rng(5)
    n, labels = 90, ["N", "A", "B", "C"]
    label = [labels[i % 4] for i in range(n)]
    x = rng.integers(0, 4, (n, 6)) / 2.0
    x[:, 4] = 0
    x[[l != "N" for l in label], 5] = 0  # expressed by control cells only
    cells = spark.createDataFrame([(i, l) for i, l in enumerate(label)], "cell_id int, target string")
    expr = spark.createDataFrame([(i, g, float(x[i, g])) for i in range(n) for g in range(6) if x[i, g]], "cell_id int, gene_id int, expr double")
    got = {(r.target, r.gene_id): (r.log2fc, r.z) for r in score.rank_sum(expr, cells, "N", ["A", "B", "C"]).collect()}
    assert set(got) == {(t, g) for t in "ABC" for g in (0, 1, 2, 3, 5)}
    for (t, g), (change, z) in got.items():
        p, c = x[[l == t for l in label], g], x[[l == "N" for l in label], g]
        both = np.concatenate((p, c))
        ranks = np.array([(both < v).sum() + ((both == v).sum() + 1) / 2 for v in both])
        _, times = np.unique(both, return_counts=True)
        total = len(both)
        var = len(p) * len(c) / 12 * (total + 1 - (times**3.0 - times).sum() / (total * (total - 1)))
        assert z == pytest.approx((ranks[: len(p)].sum() - len(p) * (total + 1) / 2) / math.sqrt(var))
        assert change == pytest.approx(math.log2(np.expm1(p).mean() + 1) - math.log2(np.expm1(c).mean() + 1))


def many_targets(spark):
    rng = np.random.default_rng(17)
    label = ["N" if i % 2 else ["T_a", "T_b"][i // 2 % 2] for i in range(120)]
    depth = rng.lognormal(0, 0.2, 120)
    rows = []
    for g in range(12):
        up = np.array([1.3 if (l, g) in (("T_a", 0), ("T_a", 1), ("T_b", 2), ("T_b", 3), ("T_b", 4)) else 0.0 for l in label])
        rows += [(i, f"g{g}", float(v)) for i, v in enumerate(rng.negative_binomial(5, 5 / (5 + 4 * depth * np.exp(up)))) if v]
    return Screen(
        spark.createDataFrame(rows, "cell_id int, gene_id string, count double"), spark.createDataFrame(list(enumerate(label)), "cell_id int, target string"),
        spark.createDataFrame([(f"g{g}", g) for g in range(12)], "gene_id string, feature_index int"))


def test_targets_together_are_each_alone(spark, monkeypatch):
    monkeypatch.setattr(expression, "CHUNK", 25)
    screen = many_targets(spark)
    shape = {"control": "N", "ndims": 3, "num_neighbors": 5, "variable_features": 6, "min_npcs": 3}
    ready = analysis.prepare(screen, ScreenConfig(**shape))
    both = analysis.perturbation_scores(ready, ScreenConfig(**shape), ["T_a", "T_b"])
    for t in ("T_a", "T_b"):
        alone = analysis.perturbation_scores(ready, ScreenConfig(**shape), [t])
        for part in ("scores", "loo"):
            key = [c for c in ("cell_id", "loo_gene") if c in getattr(both, part).columns]
            want = {tuple(r[c] for c in key): r.pvec for r in getattr(alone, part).collect()}
            got = {tuple(r[c] for c in key): r.pvec for r in getattr(both, part).filter(F.col("target") == t).collect()}
            assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)
    result = {(r.target_gene, r.gene_ID): r for r in analysis.weighted_de(ready, ScreenConfig(**shape), both).collect()}
    assert len(result) == 24 and {r.DE_method for r in result.values()} == {"weighted"}
    assert result["T_a", "g0"].log2FC > 1 > abs(result["T_b", "g0"].log2FC)


def test_components_equal_dense_ones(spark, monkeypatch):
    monkeypatch.setattr(expression, "CHUNK", 25)
    monkeypatch.setattr(expression, "GRAM_ROWS", 4)
    screen = many_targets(spark)
    ready = analysis.prepare(screen, ScreenConfig(control="N"))
    slices = expression.sliced(ready.cells, "N", ["T_a", "T_b"])
    expr, embedding = expression.embed(ready.counts, ready.cells, 7, 4, slices)
    genes = {}
    for r in expression.variable_genes(ready.counts, None, 7, slices).collect():
        genes.setdefault(r["slice"], []).append(r.gene_id)
    values = {(r.cell_id, r.gene_id): r.expr for r in expr.collect()}
    target = {r.cell_id: r.target for r in ready.cells.collect()}
    got = {(r["slice"], r.cell_id): r.embedding for r in embedding.collect()}
    counts = {(r.cell_id, r.gene_id): r["count"] for r in ready.counts.collect()}
    for t, names in genes.items():
        cells = sorted(c for c, l in target.items() if l in (t, "N"))
        raw = np.array([[counts.get((c, f"g{g}"), 0.0) for g in range(12)] for c in cells])
        mean, var = raw.mean(0), raw.var(0, ddof=1)
        expected = 10 ** expression._loess(np.log10(mean), np.log10(var))
        z = np.minimum((raw - mean) / np.sqrt(expected), math.sqrt(len(cells)))
        order = np.argsort(-(z**2).sum(0) / (len(cells) - 1), kind="stable")[:7]
        assert sorted(names) == sorted(f"g{g}" for g in order)
        x = np.array([[values.get((c, g), 0.0) for g in sorted(names)] for c in cells])
        z = np.clip((x - x.mean(0)) / x.std(0, ddof=1), -10, 10)
        _, v = np.linalg.eigh(np.cov(z.T))
        v = v[:, ::-1][:, :4]
        v = v * np.sign(v[np.abs(v).argmax(0), range(4)])
        assert np.allclose(z @ v, [got[t, c] for c in cells], atol=1e-8)


def test_fits_don_t_depend_on_blocks(spark, monkeypatch):
    screen = many_targets(spark)
    ready = analysis.prepare(screen, ScreenConfig(control="N"))
    cells = foldchange.with_stratum(ready.cells)
    design = routing.design(weights.binary_of(cells, ["T_a", "T_b"], "N"), cells)
    genes = design.select("target").distinct().crossJoin(screen.genes.select("gene_id")).select("target", "gene_id", F.when(F.col("gene_id") == "g3", "g3").otherwise("main").alias("fit_group"))
    loo = design.filter("target = 'T_a'").select("target", F.lit("g3").alias("loo_gene"), "cell_id", (F.col("weight") / 2).alias("weight"))
    found = []
    for n in (3, 64):
        monkeypatch.setattr(glm, "GENES", n)
        found.append({(r.target, r.gene_id): r for r in glm.fit(ready.counts, design, genes, loo).collect()})
    assert found[0] == found[1] and len(found[0]) == 24
    assert found[0]["T_b", "g3"].beta is None  # no weights of its own
    one = glm.fit(ready.counts, design, genes.withColumn("fit_group", F.lit("main"))).filter("target = 'T_a' and gene_id = 'g3'").first()
    assert found[0]["T_a", "g3"].beta[1] == pytest.approx(2 * one.beta[1], rel=0.05)


def test_special_functions():
    assert glm.digamma(1.0) == pytest.approx(-0.5772156649) and glm.trigamma(1.0) == pytest.approx(math.pi**2 / 6)
    assert glm.inverse_trigamma(glm.trigamma(2.5)) == pytest.approx(2.5)


def test_regression_recovers_its_parameters():
    rng = np.random.default_rng(1)
    n = 4000
    x = np.stack((np.ones(n), rng.random(n) * (rng.random(n) < 0.5), rng.normal(size=n) * 0.3), 1)
    beta, phi = np.array([0.5, 0.8, 1.0]), 0.5
    mu = np.exp(x @ beta)
    y = rng.negative_binomial(1 / phi, 1 / (1 + phi * mu)).astype(float)
    found, means = glm.irls(y, x, phi)
    assert np.allclose(found, beta, atol=0.15)
    assert glm.dispersion(y, means, x) == pytest.approx(phi, rel=0.15)
    assert glm.irls(y, np.ones((n, 2)), phi) is None


def simulated(spark, effect=1.2, cells=80, genes=12):
    rng = np.random.default_rng(7)
    label = ["T_x" if i % 2 else "N" for i in range(cells)]
    depth = rng.lognormal(0, 0.2, cells)
    rows = []
    for g in range(genes):
        mu = 4 * depth * np.where((np.array(label) == "T_x") & (g < 2), math.exp(effect), 1.0)
        y = rng.negative_binomial(5, 5 / (5 + mu))
        rows += [(i, f"g{g}" if g else "T-x", float(v)) for i, v in enumerate(y) if v]
    counts = spark.createDataFrame(rows, "cell_id int, gene_id string, count double")
    table = spark.createDataFrame([(i, t, f"{t}-{i % 4 // 2}") for i, t in enumerate(label)], "cell_id int, target string, guide string")
    names = spark.createDataFrame([(f"g{g}" if g else "T-x", g) for g in range(genes)], "gene_id string, feature_index int")
    return Screen(counts, table, names)


@pytest.mark.parametrize("m", [11, 12, 49, 10_000])
def test_no_adjusted_p_is_below_its_p(spark, m):
    rng = np.random.default_rng(m)
    frame = spark.createDataFrame([(t, i, float(x)) for t in range(5) for i, x in enumerate(rng.uniform(0.7, 1, m))], "target_gene int, gene_id int, p_weight double")
    assert bh_adjust(frame).filter("p_adj_bh < p_weight or p_adj_bh > 1").count() == 0


def test_analysis_finds_what_was_planted(spark):
    screen = simulated(spark)
    cfg = ScreenConfig(control="N", targets=("T_x",), ndims=3, num_neighbors=5, variable_features=8, min_npcs=3)
    result, cells = analysis.analyse(screen, cfg)
    rows = {r.gene_ID: r for r in result.collect()}
    assert set(rows) == {"T-x", *(f"g{g}" for g in range(1, 12))}
    assert {r.DE_method for r in rows.values()} == {"weighted"} and {r.target_gene for r in rows.values()} == {"T_x"}
    planted, others = [rows["T-x"], rows["g1"]], [rows[f"g{g}"] for g in range(2, 12)]
    assert all(0 <= r.p_weight <= r.p_adj_bh <= 1 for r in rows.values() if r.p_weight is not None)
    assert min(r.log2FC for r in planted) > 1 > max(r.log2FC for r in others)
    assert rows["T-x"].p_weight < 1e-4 and rows["T-x"].p_weight < min(r.p_weight for r in others)
    assert {c.target for c in cells.filter("perturbation_score is not null").collect()} == {"T_x"}


def test_analysis_without_scores_is_binary(spark):
    screen = simulated(spark)
    cfg = ScreenConfig(control="N", targets=("T_x",))
    rows = {r.gene_ID: r for r in analysis.weighted_de(analysis.prepare(screen, cfg), cfg).collect()}
    assert {r.DE_method for r in rows.values()} == {"standard"}
    assert rows["g1"].p_adj_bh < 0.01 and rows["g1"].beta_weight > 0.5


def test_split_fit_has_a_weight_for_each_stratum(spark):
    screen = simulated(spark)
    cells = screen.cells.withColumn("batch", F.when(F.col("cell_id") % 4 < 2, "b1").otherwise("b2"))
    cfg = ScreenConfig(control="N", targets=("T_x",), split_by="batch", full_results=True)
    ready = analysis.prepare(Screen(screen.counts, cells, screen.genes), cfg)
    row = analysis.weighted_de(ready, cfg).filter("gene_id = 'g1'").first()
    assert row.coefficients == ["cell_typeb1", "cell_typeb2", "cell_typeb1:weight", "cell_typeb2:weight", "log_ct"]
    assert len(row.beta) == 5 and row.log2FC_b1 is not None and min(row.beta[2:4]) > 0.5


def test_guides_choose_genes(spark):
    screen = simulated(spark)
    cfg = ScreenConfig(control="N", targets=("T_x",), guide_col="guide", ndims=3, num_neighbors=5, variable_features=8, min_npcs=3, store_neighbors=True)
    found = analysis.perturbation_scores(analysis.prepare(screen, cfg), cfg, ["T_x"])
    assert found.knn.count() == 80 * 5 and found.scores.count() == 80


def test_no_variation_gives_no_rows(spark):
    screen = simulated(spark)
    cfg = ScreenConfig(control="N", targets=("T_x",))
    only = Screen(screen.counts, screen.cells.filter("target <> 'N'"), screen.genes)
    assert analysis.weighted_de(analysis.prepare(only, cfg), cfg).count() == 0
    assert routing.empty_result(spark).columns == [c.split()[0] for c in routing.RESULT.split(", ")]


def test_variable_genes_and_components(spark):
    screen = simulated(spark)
    cfg = ScreenConfig(control="N", targets=("T_x",))
    ready = analysis.prepare(screen, cfg)
    top = expression.variable_genes(ready.counts, 80, 5).collect()
    assert [r["rank"] for r in sorted(top, key=lambda r: -r.std_variance)] == [1, 2, 3, 4, 5]
    _, pca = expression.embed(ready.counts, ready.cells, 8, 3)
    assert pca.count() == 80 and len(pca.first().embedding) == 3


def test_components_of_thin_cells_send_little(spark):
    """20,000 cells with one of 300 genes each: five tables of products in full would be 3.6 MB."""
    counts = spark.range(20_000).selectExpr("id as cell_id", "id % 300 as gene_id", "cast(1 + id % 7 % 3 as double) as count")
    cells = counts.select("cell_id", F.lit("T").alias("target"), F.col("count").alias("n_count"))
    slices, expr = expression.one_slice(cells), expression.log_normalize(counts, cells.withColumn("n_count", F.col("n_count") + 1))
    genes = spark.range(300).selectExpr("'' as slice", "id as gene_id")
    store = spark.sparkContext._jsc.sc().statusStore()
    before = store.executorList(True).head().totalShuffleWrite()
    got = {r.cell_id: r.embedding for r in expression.pca(expr, slices, genes, 3).collect()}
    assert len(got) == 20_000 and store.executorList(True).head().totalShuffleWrite() - before < 2_500_000
    x = np.zeros((20_000, 300))
    for r in expr.collect():
        x[r.cell_id, r.gene_id] = r.expr
    z = np.clip((x - x.mean(0)) / x.std(0, ddof=1), -10, 10)
    have = np.array([got[c] for c in range(20_000)])
    values = np.linalg.eigvalsh(np.cov(z.T))[::-1][:3]
    assert np.allclose(np.cov(have.T), np.diag(values), atol=1e-8)


def test_variable_genes_beyond_the_clip(spark):
    rng = np.random.default_rng(3)
    raw = rng.poisson(2.0, (50, 40)) * rng.uniform(1, 2, 40)  # no two means are equal
    raw[:, 20] = 0.0
    raw[7, 20] = 150.0
    counts = spark.createDataFrame([(i, g, float(raw[i, g])) for i in range(50) for g in range(40) if raw[i, g]], "cell_id int, gene_id int, count double")
    mean, var = raw.mean(0), raw.var(0, ddof=1)
    z = (raw - mean) / np.sqrt(10 ** expression._loess(np.log10(mean), np.log10(var)))
    assert (z > math.sqrt(50)).any()
    want = (np.minimum(z, math.sqrt(50)) ** 2).sum(0) / 49
    got = {r.gene_id: r.std_variance for r in expression.variable_genes(counts, 50, 40).collect()}
    assert np.allclose([got[g] for g in range(40)], want)


def test_registered_analyses_are_the_production_ones(monkeypatch):
    from knockwork.plans import queries

    calls = []
    monkeypatch.setattr(queries, "_screen", lambda spark, d: None)
    monkeypatch.setattr(analysis, "analyse", lambda screen, cfg, **more: calls.append((cfg.targets, cfg.variable_features, more)) or [None])
    for name in ("weighted_de_pipeline", "weighted_de_all_targets", "weighted_de_shared_embedding"):
        queries.QUERIES[name](None, "")
    assert calls == [((queries.TARGET,), 2000, {}), (None, 2000, {}), (None, 2000, {"shared_embedding": True})]
