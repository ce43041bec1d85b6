"""Negative-binomial regression of each gene's counts on weight and library size.

Coefficients are on the natural-log scale; library size is a covariate. Dispersions are fitted by
gene (Cox-Reid adjusted profile likelihood), follow a local median over mean counts
within a fit group, and quasi-likelihood dispersions are shrunken within it. Each task
holds one gene's counts over the cells of its design, never a matrix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.functions.columns import finite
from knockwork.functions.stats import wald_p

#: Genes of a fit group that are fitted in one task, beside one copy of the group's design.
GENES = 64
#: Cells on which dispersions are fitted when subsampling.
SUBSAMPLE = 1000
_GRID = np.linspace(math.log(1e-4), math.log(1e2), 25)
_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def digamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out, x = out - 1 / x, x + 1
    i = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - i * (1 / 12 - i * (1 / 120 - i * (1 / 252 - i / 240)))


def trigamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out, x = out + 1 / (x * x), x + 1
    i = 1 / (x * x)
    return out + 1 / x + i / 2 + i / x * (1 / 6 - i * (1 / 30 - i * (1 / 42 - i / 30)))


def inverse_trigamma(y: float) -> float:
    """By bisection on a log scale; trigamma falls."""
    lo, hi = -20.0, 20.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if trigamma(math.exp(mid)) > y else (lo, mid)
    return math.exp((lo + hi) / 2)


def _deviance(y: np.ndarray, mu: np.ndarray, phi: float) -> float:
    with np.errstate(divide="ignore", invalid="ignore"):
        first = np.where(y > 0, y * np.log(y / mu), 0.0)
        if phi < 1e-8:
            return float(2 * (first - (y - mu)).sum())
        return float(2 * (first - (y + 1 / phi) * np.log((1 + phi * y) / (1 + phi * mu))).sum())


def irls(y: np.ndarray, x: np.ndarray, phi: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray] | None:
    """(coefficients, means) of a log-link fit; a fit that fails is tried again from the mean alone. None where both fail."""
    if found := _irls(y, x, phi, np.log(y + 0.1), rounds):
        return found
    if not len(y) or np.linalg.matrix_rank(x) < x.shape[1]:
        return None
    return _irls(y, x, phi, np.full(len(y), math.log(max(float(y.mean()), 1e-8))), rounds)


def _irls(y: np.ndarray, x: np.ndarray, phi: float, begin: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray] | None:
    """With halved steps, from coefficients that fit ``begin``; None where it's singular or doesn't settle."""
    try:
        beta = np.linalg.lstsq(x, begin, rcond=None)[0]
        mu = np.exp(np.clip(x @ beta, -30, 30))
        dev = _deviance(y, mu, phi)
        for _ in range(rounds):
            w = mu / (1 + phi * mu)
            step = np.linalg.solve(x.T @ (x * w[:, None]), x.T @ (w * (y - mu) / mu))
            scale = 1.0
            while True:
                new = beta + scale * step
                mu_new = np.exp(np.clip(x @ new, -30, 30))
                dev_new = _deviance(y, mu_new, phi)
                if dev_new <= dev + 1e-9 or scale < 1e-4:
                    break
                scale /= 2
            change = abs(dev - dev_new) / (abs(dev_new) + 0.1)
            beta, mu, dev = new, mu_new, dev_new
            if change < 1e-9:
                return (beta, mu) if np.isfinite(beta).all() else None
        return None
    except np.linalg.LinAlgError:
        return None


def dispersion(y: np.ndarray, mu: np.ndarray, x: np.ndarray) -> float:
    """Overdispersion of largest Cox-Reid adjusted profile likelihood, means held fixed."""
    values, times = np.unique(y, return_counts=True)

    def profile(log_phi: float) -> float:
        phi = math.exp(log_phi)
        r = 1 / phi
        part = float((_lgamma(values + r).astype(float) * times).sum()) - len(y) * math.lgamma(r)
        part += float((y * np.log(phi * mu) - (y + r) * np.log1p(phi * mu)).sum())
        w = mu / (1 + phi * mu)
        sign, det = np.linalg.slogdet(x.T @ (x * w[:, None]))
        return part - 0.5 * det if sign > 0 else -math.inf

    score = [profile(g) for g in _GRID]
    best = int(np.argmax(score))
    lo, hi = _GRID[max(0, best - 1)], _GRID[min(len(_GRID) - 1, best + 1)]
    golden = (math.sqrt(5) - 1) / 2
    a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
    fa, fb = profile(a), profile(b)
    for _ in range(20):
        if fa > fb:
            hi, b, fb = b, a, fa
            a = hi - golden * (hi - lo)
            fa = profile(a)
        else:
            lo, a, fa = a, b, fb
            b = lo + golden * (hi - lo)
            fb = profile(b)
    found = math.exp((lo + hi) / 2)
    return 0.0 if found < 2e-4 else found


def local_median(mean: np.ndarray, phi: np.ndarray, share: float = 0.1, least: int = 50) -> np.ndarray:
    """Of each gene, the median dispersion of genes of similar mean; its own where there are few genes."""
    n = len(mean)
    if n < 10:
        return phi
    width = min(n, max(least, int(share * n)))
    order = np.argsort(mean, kind="stable")
    s = phi[order]
    out = np.empty(n)
    begin = np.clip(np.arange(n) - width // 2, 0, n - width)
    for i, b in enumerate(begin.tolist()):
        out[order[i]] = np.median(s[b : b + width])
    return out


def shrink(ql: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Quasi-likelihood dispersions drawn towards a scaled inverse chi-square prior fitted to all of them."""
    good = np.isfinite(ql) & (ql > 0) & (df > 0)
    if good.sum() < 3:
        return ql
    e = np.log(ql[good]) - np.array([digamma(d / 2) - math.log(d / 2) for d in df[good]])
    extra = e.var(ddof=1) - np.mean([trigamma(d / 2) for d in df[good]])
    if extra <= 1e-8:
        prior_df, prior = math.inf, math.exp(e.mean())
        return np.where(good, prior, ql)
    prior_df = 2 * inverse_trigamma(extra)
    prior = math.exp(e.mean() + digamma(prior_df / 2) - math.log(prior_df / 2))
    return np.where(good, (prior_df * prior + df * ql) / (prior_df + df), ql)


def design_columns(strata: list[str]) -> list[str]:
    """Names of the coefficients."""
    if len(strata) <= 1:
        return ["intercept", "weight", "log_ct"]
    return [*(f"cell_type{s}" for s in strata), *(f"cell_type{s}:weight" for s in strata), "log_ct"]


def _matrix(weight: np.ndarray, log_ct: np.ndarray, stratum: np.ndarray, n: int) -> np.ndarray:
    if n <= 1:
        return np.stack((np.ones(len(weight)), weight, log_ct), 1)
    one = np.eye(n)[stratum]
    return np.concatenate((one, one * weight[:, None], log_ct[:, None]), 1)


def fit(counts: DataFrame, design: DataFrame, genes: DataFrame, loo_weights: DataFrame | None = None, strata: list[str] | None = None, subsample: bool = False) -> DataFrame:
    """(target, fit_group, gene_id, coefficient arrays beta, se, p; mean, phi) of every gene asked for.

    ``design`` is (target, cell_id, cell_type, weight, log_ct); ``genes`` is (target, gene_id,
    fit_group): genes of fit group 'main' are fitted on weight, each other on its own
    weights in ``loo_weights`` (target, loo_gene, cell_id, weight), fit_group being loo_gene. Genes without
    counts and fits that fail have null arrays.
    """
    strata = strata or []
    n_strata = max(1, len(strata))
    gene_kind, target_kind = dict(genes.dtypes)["gene_id"], dict(genes.dtypes)["target"]
    group = ["target", "fit_group"]
    sizes = genes.groupBy(*group).agg(F.ceil(F.count("*") / GENES).alias("blocks"))
    keyed = genes.select("target", "gene_id", "fit_group").join(F.broadcast(sizes), group).withColumn("block", F.pmod(F.xxhash64("gene_id"), F.col("blocks"))).drop("blocks")
    level = F.coalesce(F.array_position(F.array(*map(F.lit, strata)), F.col("cell_type")) - 1, F.lit(0)) if strata else F.lit(0)
    cells = design.select("target", "cell_id", F.greatest(level, F.lit(0)).cast("int").alias("level"), "weight", "log_ct")
    designs = keyed.filter("fit_group = 'main'").select(*group, "block").distinct().join(cells, "target")
    if loo_weights is not None:
        own = loo_weights.select("target", F.col("loo_gene").cast("string").alias("fit_group"), "cell_id", finite(F.col("weight")).alias("own"))
        alone = keyed.filter("fit_group <> 'main'").select(*group, "block").distinct().join(own.select(*group).distinct(), group, "left_semi")
        theirs = alone.join(cells.drop("weight"), "target").join(own, [*group, "cell_id"], "left").withColumn("weight", F.coalesce("own", F.lit(0.0)))
        designs = designs.unionByName(theirs.select(*designs.columns))
    rows = counts.join(keyed, "gene_id").join(design.select("target", "cell_id"), ["target", "cell_id"]).select(*group, "block", "gene_id", "cell_id", F.col("count").cast("double").alias("count"))
    keys = f"target {target_kind}, fit_group string, gene_id {gene_kind}"

    def genes_of(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[tuple[object, pd.DataFrame, np.ndarray, np.ndarray]]:
        """(gene, its rows, counts of all cells, design) of a block, cells in order of their ids."""
        if not len(left) or not len(right):
            return
        right = right.sort_values("cell_id").reset_index(drop=True)
        place = pd.Index(right["cell_id"])
        x = _matrix(right["weight"].to_numpy(float), right["log_ct"].to_numpy(float), right["level"].to_numpy(int), n_strata)
        for gene, part in left.groupby("gene_id", sort=True):
            y = np.zeros(len(right))
            np.add.at(y, place.get_indexer(part["cell_id"]), part["count"].to_numpy(float))
            yield gene, part, y, x

    def first(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for gene, _, y, x in genes_of(left, right):
            phi = math.nan
            if fitted := irls(y, x, 0.1):
                at = np.random.default_rng(1).permutation(len(y))[:SUBSAMPLE] if subsample else slice(None)
                phi = dispersion(y[at], fitted[1][at], x[at])
            found.append((key[0], key[1], gene, float(y.mean()), phi))
        return pd.DataFrame(found, columns=["target", "fit_group", "gene_id", "mean", "phi"])

    def trend(pdf: pd.DataFrame) -> pd.DataFrame:
        good = pdf["phi"].notna().to_numpy()
        out = pdf["phi"].to_numpy(float).copy()
        out[good] = local_median(pdf["mean"].to_numpy(float)[good], out[good])
        return pdf.assign(trend=out)

    def second(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for gene, part, y, x in genes_of(left, right):
            phi = float(part["trend"].iloc[0])
            beta = var = None
            ql, df = math.nan, 0
            if math.isfinite(phi) and (fitted := irls(y, x, phi)):
                w = fitted[1] / (1 + phi * fitted[1])
                try:
                    var = np.diag(np.linalg.inv(x.T @ (x * w[:, None]))).tolist()
                    beta, df = fitted[0].tolist(), len(y) - x.shape[1]
                    ql = _deviance(y, fitted[1], phi) / df if df > 0 else math.nan
                except np.linalg.LinAlgError:
                    var = None
            found.append((key[0], key[1], gene, part["mean"].iloc[0], phi, beta, var, ql, df))
        return pd.DataFrame(found, columns=["target", "fit_group", "gene_id", "mean", "phi", "beta", "var", "ql", "df"])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        scale = shrink(pdf["ql"].to_numpy(float), pdf["df"].to_numpy(float))
        se, p = [], []
        for beta, var, s in zip(pdf["beta"], pdf["var"], scale, strict=True):
            if beta is None or var is None or not math.isfinite(s):
                se.append(None)
                p.append(None)
                continue
            e = [math.sqrt(v * s) if v > 0 else math.nan for v in var]
            se.append(e)
            p.append([wald_p(b, x) for b, x in zip(beta, e, strict=True)])
        return pdf.assign(se=se, p=p)[["target", "fit_group", "gene_id", "mean", "phi", "beta", "se", "p"]]

    by_gene, by_block = [*group, "gene_id"], [*group, "block"]
    designs = designs.toDF(*designs.columns)  # columns of its own beside those of the counts
    estimated = rows.groupBy(*by_block).cogroup(designs.groupBy(*by_block)).applyInPandas(first, f"{keys}, mean double, phi double")
    trended = estimated.groupBy(*group).applyInPandas(trend, f"{keys}, mean double, phi double, trend double")
    known = rows.join(trended.select(*by_gene, "mean", "trend"), by_gene)
    fitted = known.groupBy(*by_block).cogroup(designs.groupBy(*by_block)).applyInPandas(second, f"{keys}, mean double, phi double, beta array<double>, var array<double>, ql double, df long")
    done = fitted.groupBy(*group).applyInPandas(finish, f"{keys}, mean double, phi double, beta array<double>, se array<double>, p array<double>")
    return genes.select(*by_gene).join(done, by_gene, "left")
