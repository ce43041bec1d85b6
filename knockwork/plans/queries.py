"""The registered queries, with the tables at hand in the parts of a screen, and their SQL.

Orders are cells (priority is the target, status the stratum), parts are genes, summed line
quantities are counts; embeddings serve as an embedding and their first elements as scores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knockwork.config import ScreenConfig
from knockwork.functions.names import dashed, make_unique
from knockwork.functions.stats import bh_adjust
from knockwork.operators import expression, foldchange, glm, neighbours, routing, score, weights
from knockwork.plans import analysis
from knockwork.sources import screen as sc

NT, TARGET = "5-LOW", "1-URGENT"
MIN_PCT, MIN_CELLS, LOGFC = 0.002, 10, 0.25
K, NDIMS = 20, 30
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _counts(spark: SparkSession, d: str) -> DataFrame:
    lines = _table(spark, d, "lineitem").repartition("l_orderkey")  # by cell, which serves the sums by cell and what joins cells as well
    return lines.groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id")).agg(F.sum("l_quantity").cast("long").alias("count"))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderpriority").alias("target"), F.col("o_orderstatus").alias("status"))


def _genes(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "part").select(F.col("p_partkey").alias("gene_id"), F.col("p_partkey").alias("feature_index"), "p_name")


def _points(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Cells (target is the label) and their embedding."""
    t = _table(spark, d, "embeddings")
    return t.select(F.col("vec_id").alias("cell_id"), F.col("label").cast("string").alias("target"), (F.col("vec_id") % 2).alias("half")), t.select(F.col("vec_id").alias("cell_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def _scores(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Scores and leave-one-out scores of the cells of labels 0 (control) and 1 (target)."""
    t = _table(spark, d, "embeddings").filter("label in (0, 1)")
    base = t.select(F.lit("1").alias("target"), F.lit("con1").alias("cell_type"), F.col("vec_id").alias("cell_id"), F.col("label").cast("string").alias("gene"), F.col("embedding").cast("array<double>").alias("e"))
    spread = base.select("*", F.posexplode(F.slice("e", 1, 5)).alias("at", "p")).select("target", "cell_type", "cell_id", "gene", (F.col("at") + 1).cast("long").alias("loo_gene"), F.col("p").alias("pvec"))
    return base.select("target", "cell_type", "cell_id", "gene", F.get("e", F.lit(0)).alias("pvec")), spread


def _r(c: str, alias: str | None = None):
    return F.round(c, 6).alias(alias or c)


COUNTS = "counts as (select l_orderkey cell_id, l_partkey gene_id, cast(sum(l_quantity) as bigint) cnt from lineitem group by 1, 2)"
CELLS = "cells as (select o_orderkey cell_id, o_orderpriority target, o_orderstatus status from orders)"


@_query(f"select o_orderkey cell_id, o_orderpriority target, o_orderstatus status from orders where o_orderpriority in ('{TARGET}', '{NT}')")
def subset_target_nt(spark: SparkSession, d: str) -> DataFrame:
    return sc.subset(_cells(spark, d), [TARGET], NT)


@_query("select p_partkey gene_id, p_partkey feature_index from part where p_partkey < 1000")
def feature_cap(spark: SparkSession, d: str) -> DataFrame:
    return sc.cap_features(_genes(spark, d), 1000).select("gene_id", "feature_index")


@_query("""with n as (select p_partkey gene_id, replace(p_name, ' ', '-') name, row_number() over (partition by replace(p_name, ' ', '-') order by p_partkey) - 1 i from part)
select gene_id, name, case when i = 0 then name else name || '.' || i end unique_name from n""")
def make_unique_names(spark: SparkSession, d: str) -> DataFrame:
    named = _genes(spark, d).select("gene_id", dashed(F.col("p_name"), " ").alias("name"))
    return make_unique(named, "name", "gene_id", "unique_name")


@_query("""with g as (select c_nationkey k, c_mktsegment guide, row_number() over (partition by c_nationkey order by c_custkey) i from customer)
select o_orderkey order_key, o_custkey % 30 cell_id, guide from orders left join g on o_custkey % 30 = k and i = 1""")
def guide_lookup_first_match(spark: SparkSession, d: str) -> DataFrame:
    cells = _table(spark, d, "orders").select(F.col("o_orderkey").alias("order_key"), (F.col("o_custkey") % 30).alias("cell_id"))
    guides = _table(spark, d, "customer").select(F.col("c_nationkey").alias("cell_id"), F.col("c_mktsegment").alias("guide"), F.col("c_custkey").alias("row"))
    return sc.add_guides(cells, guides).select("order_key", "cell_id", "guide")


@_query(f"with {COUNTS}, {CELLS}, t as (select cell_id, sum(cnt) n from counts group by 1) select cell_id, target, cast(coalesce(n, 0) as bigint) n_count, round(ln(1 + coalesce(n, 0)), 6) log_ct from cells left join t using (cell_id)")
def library_size(spark: SparkSession, d: str) -> DataFrame:
    return sc.library_size(_counts(spark, d), _cells(spark, d)).select("cell_id", "target", "n_count", F.round(F.log1p("n_count"), 6).alias("log_ct"))


@_query(f"with {COUNTS}, t as (select cell_id, sum(cnt) n from counts group by 1) select cell_id, gene_id, round(ln(1 + cnt / cast(n as double) * 10000), 6) expr from counts join t using (cell_id)")
def log_normalize(spark: SparkSession, d: str) -> DataFrame:
    counts = _counts(spark, d)
    return expression.log_normalize(counts, sc.library_size(counts, _cells(spark, d))).select("cell_id", "gene_id", _r("expr"))


def _stats(spark: SparkSession, d: str, split: str | None = None) -> DataFrame:
    cells = foldchange.with_stratum(_cells(spark, d), split)
    return foldchange.gates(foldchange.fold_change_stats(_counts(spark, d), cells, NT, [TARGET]), LOGFC, MIN_PCT, MIN_CELLS)


def _fc_sql(stratum: str = "'con1'") -> str:
    return f"""with {COUNTS}, cells as (select o_orderkey cell_id, o_orderpriority target, {stratum} cell_type from orders where o_orderpriority in ('{TARGET}', '{NT}')),
n as (select cell_type, sum(case when target = '{TARGET}' then 1 else 0 end) np, sum(case when target = '{NT}' then 1 else 0 end) nn from cells group by 1),
s as (select cell_type, gene_id, sum(case when target = '{TARGET}' then cnt else 0 end) sp, sum(case when target = '{NT}' then cnt else 0 end) sn,
  sum(case when target = '{TARGET}' then 1 else 0 end) ep, sum(case when target = '{NT}' then 1 else 0 end) en from counts join cells using (cell_id) group by 1, 2),
f as (select cell_type, gene_id, log2((sp + 1) / cast(np as double)) - log2((sn + 1) / cast(nn as double)) fc, cast(ep as bigint) n_p, cast(en as bigint) n_n,
  (ep / cast(np as double) >= {MIN_PCT} or en / cast(nn as double) >= {MIN_PCT}) pass_pct, (ep >= {MIN_CELLS} or en >= {MIN_CELLS}) pass_cell from s join n using (cell_type) where np > 0 and nn > 0)"""


@_query(f"{_fc_sql()} select '{TARGET}' target, gene_id, round(fc, 6) avg_log2fc, n_p, n_n from f")
def fold_change_stats(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).select("target", "gene_id", _r("avg_log2fc"), "n_p", "n_n")


@_query(f"{_fc_sql()} select gene_id, round(fc, 6) avg_log2fc, pass_pct, pass_cell, pass_pct and pass_cell status2, abs(fc) >= {LOGFC} and pass_pct and pass_cell status from f")
def fold_change_gates(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).select("gene_id", _r("avg_log2fc"), "pass_pct", "pass_cell", "status2", "status")


@_query(f"{_fc_sql()} select '{TARGET}' target, gene_id from f where abs(fc) >= {LOGFC} and pass_pct and pass_cell")
def de_gene_set(spark: SparkSession, d: str) -> DataFrame:
    return foldchange.de_genes(_stats(spark, d), _genes(spark, d).select(F.col("gene_id").cast("string"))).select("target", F.col("gene_id").cast("long").alias("gene_id"))


@_query(f"{_fc_sql()} select gene_id, case when pass_pct and pass_cell then round(fc, 6) end log2fc from f")
def masked_fold_change(spark: SparkSession, d: str) -> DataFrame:
    return foldchange.masked(_stats(spark, d)).select("gene_id", _r("log2fc"))


@_query(f"""{_fc_sql("o_orderstatus")} select gene_id, round(max(case when cell_type = 'F' and pass_pct and pass_cell then fc end), 6) "log2FC_F",
  round(max(case when cell_type = 'O' and pass_pct and pass_cell then fc end), 6) "log2FC_O", round(max(case when cell_type = 'P' and pass_pct and pass_cell then fc end), 6) "log2FC_P" from f group by 1""")
def fc_wide_by_stratum(spark: SparkSession, d: str) -> DataFrame:
    return foldchange.wide(foldchange.masked(_stats(spark, d, "status")), ["F", "O", "P"]).select("gene_id", *(_r(f"log2FC_{s}") for s in "FOP"))


SCORES = "sc as (select vec_id cell_id, label lab, cast(embedding[1] as double) pvec from embeddings where label in (0, 1))"
LOO = "sc as (select vec_id cell_id, label lab, i loo_gene, cast(embedding[i] as double) pvec from embeddings, (select unnest([1, 2, 3, 4, 5]) i) where label in (0, 1))"


def _weight_sql(source: str, by: str) -> str:
    on, keys = (f"join m using ({by})", f"group by {by}") if by else ("cross join m", "")
    span = f"join r using ({by})" if by else "cross join r"
    k = f"{by}, " if by else ""
    return f"""with {source}, m as (select {k}avg(case when lab = 0 then pvec end) mu, stddev_samp(case when lab = 0 then pvec end) sd from sc {keys}),
w as (select cell_id, {k}lab, case when lab = 0 or sd is null or sd = 0 or pvec is null or (pvec - mu) / sd < 0 then 0.0 else (pvec - mu) / sd end w from sc {on}),
r as (select {k}min(w) lo, max(w) hi from w {keys}), s as (select cell_id, {k}lab, case when hi - lo > 0 then (w - lo) / (hi - lo) else w end weight from w {span})"""


@_query(f"{_weight_sql(SCORES, '')} select cell_id, cast(lab as varchar) gene, round(weight, 6) weight from s")
def standardized_weights(spark: SparkSession, d: str) -> DataFrame:
    return weights.standardized(_scores(spark, d)[0], "0").select("cell_id", "gene", _r("weight"))


@_query(f"{_weight_sql(LOO, 'loo_gene')} select cell_id, cast(loo_gene as bigint) loo_gene, cast(lab as varchar) gene, round(weight, 6) weight from s")
def loo_weights(spark: SparkSession, d: str) -> DataFrame:
    return weights.leave_one_out(_scores(spark, d)[1], "0").select("cell_id", "loo_gene", "gene", _r("weight"))


@_query(f"select o_orderkey cell_id, case when o_orderpriority = '{TARGET}' then 1.0::double else 0.0::double end weight from orders where o_orderpriority in ('{TARGET}', '{NT}')")
def binary_weights(spark: SparkSession, d: str) -> DataFrame:
    return weights.binary(_cells(spark, d), TARGET, NT).select("cell_id", "weight")


@_query(f"{_weight_sql(LOO, 'loo_gene')} select cast(loo_gene as bigint) loo_gene, bool_or(weight > 0) and bool_or(weight = 0) varies from s group by 1")
def weight_variation_gate(spark: SparkSession, d: str) -> DataFrame:
    return weights.leave_one_out(_scores(spark, d)[1], "0").groupBy("loo_gene").agg(weights.varies().alias("varies"))


@_query(f"""with {COUNTS}, t as (select cell_id, sum(cnt) n from counts group by 1)
select o_orderkey cell_id, o_orderpriority gene, case when o_orderpriority = '{TARGET}' then 1.0::double else 0.0::double end weight, cast(coalesce(n, 0) as bigint) n_count, round(ln(1 + coalesce(n, 0)), 6) log_ct
from orders left join t on cell_id = o_orderkey where o_orderpriority in ('{TARGET}', '{NT}')""")
def design_frame(spark: SparkSession, d: str) -> DataFrame:
    return _design(spark, d).select("cell_id", "gene", "weight", "n_count", _r("log_ct"))


def _design(spark: SparkSession, d: str) -> DataFrame:
    cells = foldchange.with_stratum(sc.library_size(_counts(spark, d), _cells(spark, d)))
    w = weights.binary(cells, TARGET, NT).select(F.lit(TARGET).alias("target"), "cell_id", F.col("target").alias("gene"), "weight")
    return routing.design(w, cells)


def _knn_sql(k: int, split: str) -> str:
    return f"""d as (select q.vec_id query_cell, n.vec_id nt_cell, list_distance(q.embedding[1:{NDIMS}]::double[], n.embedding[1:{NDIMS}]::double[]) dist from embeddings q, embeddings n where n.label = 0 and {split}),
knn as (select query_cell, nt_cell, rank, dist from (select *, row_number() over (partition by query_cell order by dist, nt_cell) rank from d) where rank <= {k})"""


@_query(f"with {_knn_sql(K, 'true')} select query_cell, nt_cell, cast(rank as integer) rank, round(dist, 6) distance from knn")
def knn_nt(spark: SparkSession, d: str) -> DataFrame:
    cells, embedding = _points(spark, d)
    return neighbours.knn_controls(cells, embedding, "0", K, NDIMS).select("query_cell", "nt_cell", "rank", _r("distance"))


@_query(f"with {_knn_sql(10, 'q.vec_id % 2 = n.vec_id % 2')} select query_cell, nt_cell, cast(rank as integer) rank, round(dist, 6) distance from knn")
def knn_nt_split(spark: SparkSession, d: str) -> DataFrame:
    cells, embedding = _points(spark, d)
    return neighbours.knn_controls(cells, embedding, "0", 10, NDIMS, "half").select("query_cell", "nt_cell", "rank", _r("distance"))


SIGNATURE = f"""{COUNTS}, t as (select cell_id, sum(cnt) n from counts group by 1), x as (select cell_id, gene_id, ln(1 + cnt / cast(n as double) * 10000) e from counts join t using (cell_id)),
{_knn_sql(K, 'true')}, a as (select query_cell cell_id, gene_id, ln(1 + sum(exp(e) - 1) / {K}) v from knn join x on cell_id = nt_cell group by 1, 2),
o as (select cell_id, gene_id, e from x where cell_id in (select vec_id from embeddings)),
sig as (select cell_id, gene_id, coalesce(e, 0) - coalesce(v, 0) prtb from o full outer join a using (cell_id, gene_id))"""


@_query(f"with {SIGNATURE} select cell_id, gene_id, round(prtb, 6) + 0.0 prtb from sig")
def perturb_signature(spark: SparkSession, d: str) -> DataFrame:
    return _signature(spark, d).select("cell_id", "gene_id", (F.round("prtb", 6) + 0.0).alias("prtb"))


def _signature(spark: SparkSession, d: str) -> DataFrame:
    cells, embedding = _points(spark, d)
    counts = _counts(spark, d)
    expr = expression.log_normalize(counts, sc.library_size(counts, _cells(spark, d)))
    return neighbours.signature(expr, neighbours.knn_controls(cells, embedding, "0", K, NDIMS), K)


def _projections(spark: SparkSession, d: str, scale: bool = False) -> tuple[DataFrame, DataFrame]:
    cells, embedding = _points(spark, d)
    sign = embedding.select("cell_id", F.posexplode(F.slice("embedding", 1, 5)).alias("at", "prtb")).select("cell_id", (F.col("at") + 1).cast("long").alias("gene_id"), "prtb")
    genes = spark.range(1, 6).select(F.lit("1").alias("target"), F.col("id").alias("gene_id"))
    return score.projection_scores(sign, cells, "0", genes, scale=scale)


PROJECTION = """x as (select vec_id cell_id, label, i, cast(embedding[i] as double) v from embeddings, (select unnest([1, 2, 3, 4, 5]) i) where label in (0, 1)),
vec as (select i, avg(case when label = 1 then v end) - avg(case when label = 0 then v end) d from x group by 1), vv as (select sum(d * d) den from vec),
num as (select cell_id, label, sum(v * d) num from x join vec using (i) group by 1, 2)"""


@_query(f"with {PROJECTION} select cell_id, cast(label as varchar) gene, round(num / den, 6) pvec from num, vv")
def projection_score(spark: SparkSession, d: str) -> DataFrame:
    return _projections(spark, d)[0].select("cell_id", "gene", _r("pvec"))


SCALED = PROJECTION.replace("x as (", "raw as (").replace("vec as (", "mo as (select i, avg(v) mu, stddev_samp(v) sd from raw group by 1), x as (select cell_id, label, i, (v - mu) / sd v from raw join mo using (i)),\nvec as (")


@_query(f"with {SCALED} select cell_id, cast(label as varchar) gene, round(num / den, 6) pvec from num, vv")
def projection_score_scaled(spark: SparkSession, d: str) -> DataFrame:
    return _projections(spark, d, True)[0].select("cell_id", "gene", _r("pvec"))


@_query(f"with {PROJECTION} select cell_id, cast(label as varchar) gene, cast(i as bigint) loo_gene, round((num - v * d) / (den - d * d), 6) pvec from num join x using (cell_id, label) join vec using (i), vv")
def projection_score_loo(spark: SparkSession, d: str) -> DataFrame:
    return _projections(spark, d)[1].select("cell_id", "gene", "loo_gene", _r("pvec"))


@_query(f"""with {COUNTS}, cells as (select o_orderkey cell_id, o_orderpriority target from orders where o_orderpriority in ('{TARGET}', '{NT}')),
t as (select cell_id, sum(cnt) n from counts group by 1), x as (select gene_id, target, cnt / cast(n as double) * 10000 lin, ln(1 + cnt / cast(n as double) * 10000) e from counts join cells using (cell_id) join t using (cell_id)),
n as (select cast(count(*) as double) nt, cast(sum(case when target = '{TARGET}' then 1 else 0 end) as double) np from cells),
k as (select *, rank() over (partition by gene_id order by round(e, 9)) + (count(*) over (partition by gene_id, round(e, 9)) - 1) / 2.0 + nt - count(*) over (partition by gene_id) r,
  count(*) over (partition by gene_id, round(e, 9)) ties from x, n),
g as (select gene_id, max(nt) nt, max(np) np, count(*) c, sum(case when target = '{TARGET}' then r else 0 end) rp, sum(case when target = '{TARGET}' then 1 else 0 end) kp, sum(cast(ties as double) * ties - 1) tied,
  sum(case when target = '{TARGET}' then lin else 0 end) sp, sum(case when target = '{TARGET}' then 0 else lin end) sn from k group by 1),
u as (select *, rp + (np - kp) * (nt - c + 1) / 2 - np * (np + 1) / 2 - np * (nt - np) / 2 dev, np * (nt - np) / 12 * (nt + 1 - (tied + power(nt - c, 3) - (nt - c)) / (nt * (nt - 1))) var from g)
select gene_id, round(log2(sp / np + 1) - log2(sn / (nt - np) + 1), 5) log2fc, round(dev / sqrt(var), 5) z from u""")
def rank_sum_test(spark: SparkSession, d: str) -> DataFrame:
    counts = _counts(spark, d)
    expr = expression.log_normalize(counts, sc.library_size(counts, _cells(spark, d))).withColumn("expr", F.round("expr", 9))
    return score.rank_sum(expr, _cells(spark, d), NT, [TARGET]).select("gene_id", F.round("log2fc", 5).alias("log2fc"), F.round("z", 5).alias("z"))


def _routes(spark: SparkSession, d: str, passing: DataFrame | None = None) -> DataFrame:
    """Fit groups of the passing genes, or of all genes."""
    scores, loo = _scores(spark, d)
    w = weights.leave_one_out(loo, "0").select("target", "loo_gene", "cell_id", "weight")
    members = scores.select("target", "cell_id", "gene")
    genes = _genes(spark, d)
    de = (genes if passing is None else passing).select(F.lit("1").alias("target"), "gene_id")
    targets = routing.loo_targets(w, members, genes.select("gene_id"))
    return routing.route(de, targets.withColumn("loo_gene", F.col("loo_gene").cast("long"))).select("gene_id", "fit_group")


@_query(f"""{_weight_sql(LOO, 'loo_gene')}, ok as (select loo_gene g from s group by 1 having bool_or(weight > 0) and bool_or(weight = 0) union select 1)
select p_partkey gene_id, 'main' fit_group from part where p_partkey not in (select g from ok)
union all select g gene_id, cast(g as varchar) fit_group from ok where g in (select p_partkey from part)""")
def loo_routing(spark: SparkSession, d: str) -> DataFrame:
    return _routes(spark, d)


@_query(f"""with ok as (select g from ({_weight_sql(LOO, 'loo_gene')} select loo_gene g from s group by 1 having bool_or(weight > 0) and bool_or(weight = 0) union select 1)),
de as (select gene_id from ({_fc_sql()} select gene_id from f where abs(fc) >= {LOGFC} and pass_pct and pass_cell))
select gene_id, 'main' fit_group from de where gene_id not in (select g from ok)
union all select g gene_id, cast(g as varchar) fit_group from ok where g in (select p_partkey from part)""")
def loo_routing_de_set(spark: SparkSession, d: str) -> DataFrame:
    return _routes(spark, d, de_gene_set(spark, d))


P = f"{_fc_sql()}, p as (select gene_id, case when gene_id % 17 <> 0 then round(exp(-abs(round(fc, 6))), 3) end p from f)"
BH = f"""{P}, r as (select gene_id, p, row_number() over (order by p desc, gene_id) i, count(p) over () m from p where p is not null),
q as (select gene_id, p, least(1.0, min(p * m / (m - i + 1)) over (order by i rows between unbounded preceding and current row)) q from r)"""


def _p_values(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("gene_id") % 17 != 0, F.round(F.exp(-F.abs(F.round("avg_log2fc", 6))), 3))
    return _stats(spark, d).select(F.col("target").alias("target_gene"), "gene_id", p.alias("p_weight"))


@_query(f"{BH} select p.gene_id, p.p p_weight, round(q, 6) p_adj_bh from p left join q using (gene_id)")
def bh(spark: SparkSession, d: str) -> DataFrame:
    return bh_adjust(_p_values(spark, d)).select("gene_id", "p_weight", _r("p_adj_bh"))


QUERIES["bh_adjust"], ORACLE_SQL["bh_adjust"] = QUERIES.pop("bh"), ORACLE_SQL.pop("bh")


@_query(f"""{BH} select cast(p.gene_id as varchar) "gene_ID", case when pass_pct and pass_cell then round(fc, 6) end "log2FC", round(fc, 6) beta_weight, p.p p_weight, 'weighted' "DE_method", '{TARGET}' target_gene, round(q2, 6) p_adj_bh
from p join f using (gene_id) left join (select gene_id, least(1.0, min(p * m / (m - i + 1)) over (order by i rows between unbounded preceding and current row)) q2
  from (select gene_id, p, row_number() over (order by p desc, cast(gene_id as varchar)) i, count(p) over () m from p where p is not null)) using (gene_id)""")
def result_shape(spark: SparkSession, d: str) -> DataFrame:
    stats = _stats(spark, d)
    p = _p_values(spark, d).select(F.col("target_gene").alias("target"), "gene_id", "p_weight")
    fits = p.join(stats.select("gene_id", _r("avg_log2fc", "beta_weight")), "gene_id")
    methods = spark.createDataFrame([(TARGET, "weighted")], "target string, method string")
    out = routing.result(fits, foldchange.masked(stats).select("target", "gene_id", _r("log2fc")), methods)
    return out.withColumn("p_adj_bh", F.round("p_adj_bh", 6))


@_query("""select cast(null as varchar) "gene_ID", cast(null as double) "log2FC", cast(null as double) beta_weight, cast(null as double) p_weight, cast(null as varchar) "DE_method", cast(null as varchar) target_gene, cast(null as double) p_adj_bh where false""")
def empty_result(spark: SparkSession, d: str) -> DataFrame:
    return routing.empty_result(spark)


@_query()
def hvg_top(spark: SparkSession, d: str) -> DataFrame:
    return expression.variable_genes(_counts(spark, d), _cells(spark, d).count(), 2000)


@_query()
def pca_embedding(spark: SparkSession, d: str) -> DataFrame:
    counts = _counts(spark, d)
    return expression.embed(counts, sc.library_size(counts, _cells(spark, d)), k=NDIMS)[1]


@_query()
def nb_glm_main(spark: SparkSession, d: str) -> DataFrame:
    genes = _stats(spark, d).filter("status").select("target", "gene_id", F.lit("main").alias("fit_group"))
    return glm.fit(_counts(spark, d), _design(spark, d), genes)


@_query()
def nb_glm_loo(spark: SparkSession, d: str) -> DataFrame:
    counts = _counts(spark, d)
    scores, loo = _scores(spark, d)
    cells = foldchange.with_stratum(sc.library_size(counts, _points(spark, d)[0].drop("half")))
    designs = routing.design(weights.standardized(scores, "0"), cells)
    w = weights.leave_one_out(loo, "0").select("target", "loo_gene", "cell_id", "weight")
    held = counts.join(designs.select("cell_id"), "cell_id", "left_semi").groupBy("gene_id").agg(F.count("*").alias("n")).filter("n >= 3")
    targets = routing.loo_targets(w, designs, _genes(spark, d).select("gene_id")).withColumn("loo_gene", F.col("loo_gene").cast("long"))
    routes = routing.route(held.select(F.lit("1").alias("target"), "gene_id"), targets)
    every = w.filter("loo_gene <> 1").unionByName(routing.own_gene_weights(designs, targets.withColumn("loo_gene", F.col("loo_gene").cast("string"))).withColumn("loo_gene", F.col("loo_gene").cast("long")))
    return glm.fit(counts, designs, routes, every.withColumn("loo_gene", F.col("loo_gene").cast("string")))


def _screen(spark: SparkSession, d: str) -> sc.Screen:
    text = F.col("gene_id").cast("string").alias("gene_id")
    return sc.Screen(_counts(spark, d).select("cell_id", text, F.col("count").cast("double").alias("count")), _cells(spark, d), _genes(spark, d).select(text, "feature_index"))


def _config(targets: tuple[str, ...] | None) -> ScreenConfig:
    return ScreenConfig(control=NT, targets=targets, min_pct=MIN_PCT, min_cells_group=MIN_CELLS, logfc_threshold=LOGFC)


@_query()
def weighted_de_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return analysis.analyse(_screen(spark, d), _config((TARGET,)))[0]


@_query()
def weighted_de_all_targets(spark: SparkSession, d: str) -> DataFrame:
    return analysis.analyse(_screen(spark, d), _config(None))[0]


@_query()
def weighted_de_shared_embedding(spark: SparkSession, d: str) -> DataFrame:
    return analysis.analyse(_screen(spark, d), _config(None), shared_embedding=True)[0]
