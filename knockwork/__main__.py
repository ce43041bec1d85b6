"""The whole analysis from a command line: ``python -m knockwork --screen DIR --pair-csv FILE --perturb-gene GENE --outdir DIR``.

Three steps, each stored below ``outdir/stages`` under a hash of the parameters: the screen made ready, the scores, the
result. With ``--resume``, a step that is stored already isn't made again. Results are CSV files for each target, the
log says when each step began and how long it took, and ``session`` holds versions and parameters.
"""

from __future__ import annotations

import argparse
import contextlib
import hashlib
import json
import logging
import platform
import time
from collections.abc import Iterator, Sequence
from dataclasses import asdict, replace

import numpy
import pandas
import pyarrow
import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knockwork.config import ScreenConfig, lenient_bool, strict_bool
from knockwork.plans.analysis import Scores, perturbation_scores, weighted_de, with_score
from knockwork.sources import screen as sc
from knockwork.sources.sinks import write_metadata_csv, write_result_csv, write_results

log = logging.getLogger("knockwork")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="knockwork", description=__doc__.split("\n")[0])
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--screen", help="folder of a screen's tables counts, cells and genes")
    source.add_argument("--triplets", help="folder of Parquet tables triplets, cells and genes of a matrix")
    source.add_argument("--h5ad", help="AnnData file, where h5py is installed")
    p.add_argument("--outdir", default="results")
    p.add_argument("--perturb-gene", nargs="*", help="targets; all labels but the control if none is given")
    p.add_argument("--pair-csv", help="table of guides; its first column is its index")
    p.add_argument("--target-gene-col", default="target_gene")
    p.add_argument("--cell-col", default="cell")
    p.add_argument("--guide-col", default="pair_key")
    p.add_argument("--nt-label", default=ScreenConfig.control)
    p.add_argument("--max-features", type=int, default=ScreenConfig.max_features)
    p.add_argument("--subset-to-gene", type=lenient_bool, default=True)
    p.add_argument("--split-by")
    for name, kind in (("ndims", int), ("num-neighbors", int), ("min-de-genes", int), ("max-de-genes", int), ("logfc-threshold", float), ("min-pct", float), ("min-cells-group", int), ("max-control-cells", int), ("bh-universe", int), ("variable-features", int)):
        p.add_argument(f"--{name}", type=kind, default=getattr(ScreenConfig, name.replace("-", "_")))
    for name in ("subsample", "full-results", "store-neighbors", "exclude-self"):
        p.add_argument(f"--{name}", type=strict_bool, default=False)
    p.add_argument("--shared-embedding", type=strict_bool, default=False, help="one embedding for all targets")
    p.add_argument("--resume", action="store_true")
    p.add_argument("--log-file", help="file of this machine that gets the log too")
    p.add_argument("--master", help="Spark's master; this machine if none is given")
    p.add_argument("--cpus", type=int, default=8)
    p.add_argument("--memory", default="64g")
    p.add_argument("--checkpoint-dir", help="folder that the driver and all executors share; below outdir if none is given")
    return p


def config_of(args: argparse.Namespace) -> ScreenConfig:
    given = {k: v for k, v in vars(args).items() if k in ScreenConfig.__dataclass_fields__}
    return ScreenConfig(**given | {"control": args.nt_label, "targets": tuple(args.perturb_gene) if args.perturb_gene else None, "target_col": args.target_gene_col, "guide_col": "guide" if args.pair_csv else None, "subset": args.subset_to_gene})


def session_of(args: argparse.Namespace) -> SparkSession:
    build = SparkSession.builder.appName("knockwork")
    if args.master:
        build = build.master(args.master).config("spark.executor.cores", args.cpus).config("spark.executor.memory", args.memory)
    else:
        build = build.master(f"local[{args.cpus}]").config("spark.driver.memory", args.memory)
    return build.getOrCreate()


@contextlib.contextmanager
def step(spark: SparkSession, tag: str) -> Iterator[None]:
    """Tags the jobs of a step and logs how long it takes."""
    log.info("%s began", tag)
    began = time.monotonic()
    spark.sparkContext.setJobDescription(tag)
    try:
        yield
    finally:
        spark.sparkContext.setJobDescription(None)
    log.info("%s took %.1f s", tag, time.monotonic() - began)


def stored(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return jvm.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jvm)


def load(spark: SparkSession, args: argparse.Namespace) -> sc.Screen:
    if args.h5ad:
        return sc.read_h5ad(spark, args.h5ad, args.target_gene_col, args.max_features)
    if args.triplets:
        tables = (spark.read.parquet(f"{args.triplets}/{n}") for n in ("triplets", "cells", "genes"))
        return sc.from_triplets(*tables, args.target_gene_col, args.max_features)
    screen = sc.read_screen(spark, args.screen)
    if args.target_gene_col in screen.cells.columns and "target" not in screen.cells.columns:
        screen = replace(screen, cells=screen.cells.withColumnRenamed(args.target_gene_col, "target"))
    kept = sc.cap_features(screen.genes, args.max_features)
    return replace(screen, counts=screen.counts.join(kept.select("gene_id"), "gene_id", "left_semi"), genes=kept)


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The result of all targets, as it is stored."""
    cfg = config_of(args)
    said = {k: v for k, v in vars(args).items() if k not in ("resume", "master", "cpus", "memory", "outdir", "checkpoint_dir", "log_file")}
    stages = f"{args.outdir}/stages/{hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest()[:16]}"
    versions = {"python": platform.python_version(), "spark": spark.version} | {m.__name__: m.__version__ for m in (pyspark, numpy, pandas, pyarrow)}
    session = json.dumps({"versions": versions, "parameters": said, "config": asdict(cfg)}, default=str)
    log.info("session %s", session)
    spark.createDataFrame([(session,)], "value string").coalesce(1).write.mode("overwrite").text(f"{args.outdir}/session")

    def done(name: str) -> bool:
        found = args.resume and stored(spark, f"{stages}/{name}")
        if found:
            log.info("%s is stored", name)
        return found

    if not done("screen/genes"):
        with step(spark, "screen"):
            guides = sc.read_guides(spark, args.pair_csv, args.cell_col, args.guide_col) if args.pair_csv else None
            sc.prepare(load(spark, args), cfg, guides).write(f"{stages}/screen")
    ready = sc.read_screen(spark, f"{stages}/screen")
    targets = sc.perturbations(ready.cells, cfg.control, cfg.targets)
    if not done("loo"):
        with step(spark, f"scores of {len(targets)} targets"):
            found = perturbation_scores(ready, cfg, targets, args.shared_embedding)
            if found is None:
                empty = spark.createDataFrame([], "target string, cell_id string, gene string, pvec double, cell_type string")
                found = Scores(empty, empty.withColumn("loo_gene", F.lit("")))
            if found.knn is not None:
                found.knn.write.mode("overwrite").parquet(f"{stages}/neighbours")
            found.scores.write.mode("overwrite").parquet(f"{stages}/scores")
            found.loo.write.mode("overwrite").parquet(f"{stages}/loo")
    scores = Scores(spark.read.parquet(f"{stages}/scores"), spark.read.parquet(f"{stages}/loo"))
    scores = scores if scores.scores.take(1) else None
    if not done("result"):
        with step(spark, f"regression of {len(targets)} targets"):
            made = weighted_de(ready, cfg, scores)
            if cfg.full_results:
                made = made.withColumn("target_gene", F.col("target"))
            write_results(made, f"{stages}/result")
    result = spark.read.parquet(f"{stages}/result")
    with step(spark, "tables"):
        cells = with_score(ready.cells, scores)
        for target in targets:
            if not cfg.full_results:
                write_result_csv(result, args.outdir, target)
            write_metadata_csv(cells.filter(F.col("target").isin(target, cfg.control)), args.outdir, target)
    return result


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    handlers = [logging.StreamHandler(), *([logging.FileHandler(args.log_file)] if args.log_file else [])]
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s", handlers=handlers)
    spark = session_of(args)
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir or f"{args.outdir}/checkpoints")
    run(spark, args)


if __name__ == "__main__":
    main()
