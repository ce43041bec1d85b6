import pytest
from pyspark.sql import functions as F

from knockwork.config import ScreenConfig, lenient_bool, strict_bool
from knockwork.functions.names import dashed, make_unique
from knockwork.sources import screen as sc
from knockwork.sources.sinks import write_metadata_csv, write_result_csv, write_results
from knockwork.operators import routing


def test_booleans():
    assert strict_bool("Yes") and not strict_bool("F") and lenient_bool("T") and not lenient_bool("maybe")
    with pytest.raises(ValueError):
        strict_bool("maybe")


def test_config_is_checked():
    with pytest.raises(ValueError):
        ScreenConfig(num_neighbors=0)


def test_make_unique(spark):
    rows = [(i, n) for i, n in enumerate(["A", "A", "B", "A.1", "A", None, None])]
    got = {r.i: r.u for r in make_unique(spark.createDataFrame(rows, "i int, n string"), "n", "i", "u").collect()}
    assert [got[i] for i in range(5)] == ["A", "A.2", "B", "A.1", "A.3"]
    assert got[5] is None


def test_triplets(spark):
    triplets = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (1, 1, 5.0), (1, 2, 0.0), (0, 3, 9.0)], "cell_index int, feature_index int, count double")
    cells = spark.createDataFrame([(0, "c", "T"), (1, "c", "N")], "cell_index int, cell_id string, target string")
    genes = spark.createDataFrame([(0, "a_b"), (1, "a-b"), (2, "x"), (3, "y")], "feature_index int, gene_id string")
    s = sc.from_triplets(triplets, cells, genes, max_features=3)
    assert {tuple(r) for r in s.counts.collect()} == {("c", "a-b", 3.0), ("c.1", "a-b.1", 5.0)}
    assert s.genes.count() == 3
    with pytest.raises(ValueError):
        sc.from_triplets(triplets, cells.drop("target"), genes)


def test_dense(spark):
    got = sc.from_dense(spark.createDataFrame([(0, [0.0, 2.0]), (1, [0.0, 0.0])], "cell_index int, values array<double>")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 2.0)]


def test_feature_cap_off(spark):
    genes = spark.createDataFrame([(0,), (1,)], "feature_index int")
    assert sc.cap_features(genes, None).count() == sc.cap_features(genes, 0).count() == 2


def test_guides(spark, tmp_path):
    path = tmp_path / "guides.csv"
    path.write_text("i,cell,pair_key\n0,a,g1\n1,a,g2\n2,z,g3\n")
    guides = sc.read_guides(spark, str(path))
    cells = spark.createDataFrame([("a",), ("b",)], "cell_id string")
    assert {tuple(r) for r in sc.add_guides(cells, guides).collect()} == {("a", "g1"), ("b", None)}
    with pytest.raises(ValueError):
        sc.add_guides(cells.filter("cell_id = 'b'"), guides)


def test_subset_and_size(spark):
    cells = spark.createDataFrame([("a", "T"), ("b", "N"), ("c", "O"), ("d", None)], "cell_id string, target string")
    kept = sc.subset(cells, ["T"], "N")
    assert {r.cell_id for r in kept.collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        sc.subset(cells, ["Q"], "R")
    counts = spark.createDataFrame([("a", "g", 2.0)], "cell_id string, gene_id string, count double")
    assert {(r.cell_id, r.n_count) for r in sc.library_size(counts, kept.withColumn("n_count", F.lit(9))).collect()} == {("a", 2.0), ("b", 0.0)}
    assert sc.perturbations(cells, "N") == ["O", "T"]
    with pytest.raises(ValueError):
        sc.perturbations(cells, "N", ("Q",))
    assert sc.cap_controls(cells.unionByName(cells), "N", 1).filter("target = 'N'").count() == 1


def test_dashed(spark):
    assert spark.range(1).select(dashed(F.lit("a_b_c"))).first()[0] == "a-b-c"


def test_sinks(spark, tmp_path):
    row = spark.createDataFrame([("g", 1.0, None, 0.5, "weighted", "T", 0.5)], routing.RESULT)
    write_results(row, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    write_result_csv(row, str(tmp_path), "T", quoted=False)
    text = "".join(p.read_text() for p in (tmp_path / "pert_T_de_res_df.csv").glob("part-*"))
    assert text.splitlines() == ["gene_ID,log2FC,beta_weight,p_weight,DE_method,target_gene,p_adj_bh", "g,1.0,NA,0.5,weighted,T,0.5"]
    write_metadata_csv(spark.createDataFrame([("x", "c")], "target string, cell_id string"), str(tmp_path), "T")
    text = "".join(p.read_text() for p in (tmp_path / "pert_T_meta_data.csv").glob("part-*"))
    assert text.startswith("cell_id,target")


def test_screen_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([("a", "T")], "cell_id string, target string")
    counts = spark.createDataFrame([("a", "g", 2.0)], "cell_id string, gene_id string, count double")
    genes = spark.createDataFrame([("g", 0)], "gene_id string, feature_index int")
    sc.Screen(counts, cells, genes).write(str(tmp_path / "s"))
    assert sc.read_screen(spark, str(tmp_path / "s")).counts.collect() == counts.collect()


def test_index_of_guides_is_its_own(spark, tmp_path):
    (tmp_path / "guides.csv").write_text("i,cell,pair_key\n0,a,g1\n0,b,g2\n")
    with pytest.raises(ValueError):
        sc.read_guides(spark, str(tmp_path / "guides.csv"))


def test_names_that_clash_again_and_again(spark):
    rows = ["A", "A", "A", "A.1", "A.2", "A.2", "A.4", "B.", "B.", "B..1"]
    got = [r.u for r in make_unique(spark.createDataFrame(list(enumerate(rows)), "i int, n string"), "n", "i", "u").orderBy("i").collect()]
    assert len(set(got)) == len(rows) and [g for g, n in zip(got, rows) if g == n] == ["A", "A.1", "A.2", "A.4", "B.", "B..1"]
    assert got[1:3] == ["A.3", "A.5"] and got[5] == "A.2.1" and got[8] == "B..2"


FAKE = """
import pickle

class Dataset:
    def __init__(self, x):
        self.x, self.shape, self.dtype, self.attrs = x, x.shape, x.dtype, {}
    def __getitem__(self, k):
        return self.x[k]

class Group(dict):
    pass

def File(path, mode):
    import contextlib
    import numpy as np
    def wrap(v):
        if isinstance(v, dict):
            g = Group({k: wrap(x) for k, x in v.items() if k != "attrs"})
            g.attrs = v.get("attrs", {})
            return g
        return Dataset(np.asarray(v))
    return contextlib.nullcontext(wrap(pickle.load(open(path, "rb"))))
"""


@pytest.mark.parametrize("kind", ["csr_matrix", "csc_matrix", "dense"])
def test_h5ad_by_ranges(spark, tmp_path, monkeypatch, kind):
    """With a stand-in for the library: a matrix of either storage gives the same screen."""
    import pickle
    import sys

    import numpy as np

    monkeypatch.setattr(sc, "H5AD_ROWS", 2)
    rng = np.random.default_rng(3)
    x = rng.integers(0, 3, (7, 5)) * (rng.random((7, 5)) < 0.6)
    if kind == "dense":
        held = x
    else:
        m = x if kind == "csr_matrix" else x.T
        held = {"attrs": {"shape": x.shape, "encoding-type": kind}, "indptr": np.concatenate(([0], np.cumsum((m != 0).sum(1)))), "indices": np.nonzero(m)[1], "data": m[np.nonzero(m)]}
    obs = {"attrs": {"_index": "name"}, "name": [f"c{i}" for i in range(7)], "target_gene": {"codes": [0, 1, 0, -1, 1, 0, 1], "categories": ["N", "T"]}, "depth": [float(i) for i in range(7)]}
    (tmp_path / "x.h5ad").write_bytes(pickle.dumps({"X": held, "obs": obs, "var": {"attrs": {"_index": "g"}, "g": ["a_1", "b", "c", "d", "e"]}}))
    (tmp_path / "lib").mkdir()
    (tmp_path / "lib" / "h5py.py").write_text(FAKE)
    monkeypatch.syspath_prepend(str(tmp_path / "lib"))
    spark.sparkContext.addPyFile(str(tmp_path / "lib" / "h5py.py"))
    try:
        screen = sc.read_h5ad(spark, str(tmp_path / "x.h5ad"), max_features=4)
        names = ["a-1", "b", "c", "d"]
        assert {tuple(r) for r in screen.counts.collect()} == {(f"c{i}", names[j], float(x[i, j])) for i in range(7) for j in range(4) if x[i, j]}
        assert {r.cell_id: (r.target, r.depth) for r in screen.cells.collect()} == {f"c{i}": ([None, "N", "T"][[1, 2, 1, 0, 2, 1, 2][i]], float(i)) for i in range(7)}
    finally:
        sys.modules.pop("h5py", None)


def test_command_runs_and_resumes(spark, tmp_path, caplog):
    import logging

    from test_operators import simulated

    from knockwork import __main__ as command

    simulated(spark).write(str(tmp_path / "screen"))
    (tmp_path / "guides.csv").write_text("i,cell,pair_key\n" + "".join(f"{i},{i},g{i % 3}\n" for i in range(80)))
    argv = ["--screen", str(tmp_path / "screen"), "--outdir", str(tmp_path / "out"), "--nt-label", "N", "--ndims", "3", "--num-neighbors", "5", "--variable-features", "8", "--subsample", "no"]
    with caplog.at_level(logging.INFO, "knockwork"):
        result = command.run(spark, command.parser().parse_args(argv))
        rows = {r.gene_ID: r.p_weight for r in result.collect()}
        assert len(rows) == 12 and "regression of 1 targets took" in caplog.text and '"spark"' in caplog.text
        caplog.clear()
        again = command.run(spark, command.parser().parse_args([*argv, "--resume"]))
        assert {r.gene_ID: r.p_weight for r in again.collect()} == rows and "took" not in caplog.text.replace("tables took", "")
    text = "".join(p.read_text() for p in (tmp_path / "out" / "pert_T_x_de_res_df.csv").glob("part-*"))
    assert len(text.splitlines()) == 13
    table = "".join(p.read_text() for p in (tmp_path / "out" / "pert_T_x_meta_data.csv").glob("part-*"))
    assert table.startswith("cell_id,") and "perturbation_score" in table.splitlines()[0] and len(table.splitlines()) == 81
    with pytest.raises(SystemExit):
        command.parser().parse_args(["--screen", "x", "--subsample", "maybe"])


def test_workers_have_one_thread_of_linear_algebra(spark):
    def threads(batches):
        import os

        import pandas as pd

        for _ in batches:
            yield pd.DataFrame({"n": [os.environ.get("OMP_NUM_THREADS")]})

    assert {r.n for r in spark.range(4).mapInPandas(threads, "n string").collect()} == {"1"}


def test_h5ad_needs_a_library(spark):
    pytest.importorskip("pyspark")
    try:
        import h5py  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError):
            sc.read_h5ad(spark, "x.h5ad")
