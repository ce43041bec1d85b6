"""Names of genes and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dashed(name: Column, what: str = "_") -> Column:
    """A name with dashes for underscores."""
    return F.translate(name, what, "-" * len(what))


def make_unique(df: DataFrame, name: str, order: str, into: str) -> DataFrame:
    """Adds ``into``: the first of equal names as it is, the later ones with .1, .2, … in the order of ``order``.

    A name made so that another row already has is numbered on until it is free.
    """
    numbered = df.withColumn("unique__n", F.row_number().over(W.partitionBy(name).orderBy(order)) - 1)
    made = F.when(F.col("unique__n") == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("."), F.col("unique__n").cast("string")))
    out = numbered.withColumn(into, made)
    taken = df.select(F.col(name).alias(into)).distinct()
    clashing = out.filter("unique__n > 0").select(into, name).join(taken, into, "left_semi").select(F.col(name).alias("unique__name")).distinct()
    hit = F.col(name) == F.col("unique__name")
    again = out.filter("unique__n > 0")
    settled = out.filter("unique__n = 0").unionByName(again.join(clashing, hit, "left_anti"))
    rest = again.join(clashing, hit, "left_semi")
    # Of each clashing name, as many numbers as it needs beside those in use; the free ones are dealt out in order.
    used = settled.select(F.col(into).alias("unique__made")).distinct()
    stem = F.regexp_extract("unique__made", r"(?s)^(.*)\.\d+$", 1)
    many = rest.groupBy(F.col(name).alias("unique__name")).agg(F.max("unique__n").alias("unique__k"))
    room = used.groupBy(stem.alias("unique__name")).agg(F.count("*").alias("unique__t"))
    tried = many.join(room, "unique__name", "left").select("unique__name", F.explode(F.sequence(F.lit(1).cast("long"), F.col("unique__k") + F.coalesce("unique__t", F.lit(0)))).alias("unique__i"))
    free = tried.withColumn("unique__made", F.concat("unique__name", F.lit("."), F.col("unique__i").cast("string"))).join(used, "unique__made", "left_anti")
    free = free.withColumn("unique__at", F.row_number().over(W.partitionBy("unique__name").orderBy("unique__i")))
    numbered = rest.drop(into).join(free, (F.col(name) == F.col("unique__name")) & (F.col("unique__n") == F.col("unique__at"))).withColumnRenamed("unique__made", into)
    return settled.drop("unique__n").unionByName(numbered.select(*df.columns, into))
