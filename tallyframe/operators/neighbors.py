"""Exact nearest-neighbour means along one numeric predictor.

Donors are reduced to distinct predictor values, put in global order, and every
value asked for is placed between them.  Only the k donor values on each side can
be among the k nearest, so no pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ordering import laid_out, with_starts
from tallyframe.session import State


def donors(train: DataFrame, col: str, by: str) -> DataFrame:
    """Distinct predictor values with the number and sum of known targets."""
    known = train.where(F.col(col).isNotNull() & F.col(by).isNotNull())
    return known.groupBy(F.col(by).cast("double").alias("x")).agg(
        F.count("*").alias("c"), F.sum(F.col(col).cast("double")).alias("s"))


def neighbor_means(donor: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(x, rows, value): mean target of the k donors nearest to each asked x.

    ``asked`` holds distinct x with a row count ``rows``.  Donors as far as the
    k-th nearest all take part, so ties need no rule.
    """
    both = donor.select("x", "c", "s", F.lit(0).alias("rows")).unionByName(
        asked.select("x", F.lit(0).alias("c"), F.lit(None).cast("double").alias("s"), "rows"))
    both = both.groupBy("x").agg(F.sum("c").alias("c"), F.sum("s").alias("s"), F.sum("rows").alias("rows"))
    laid = laid_out(both, ["x"])
    is_donor = (F.col("c") > 0).cast("long")
    laid = with_starts(laid, laid.groupBy("__part").agg(F.sum(is_donor)))
    w = Window.partitionBy("__part").orderBy("__pos")       # one balanced range part each
    placed = laid.withColumn("at", F.col("__start") + F.sum(is_donor).over(w))
    near = (
        placed.where("c > 0")
        .select(F.explode(F.sequence(F.col("at") - k, F.col("at") + (k - 1))).alias("at"),
                F.struct("x", "c", "s").alias("d"))
        .groupBy("at").agg(F.collect_list("d").alias("near"))      # at most 2k entries
    )
    want = placed.where("rows > 0").select("x", "rows", "at")
    near = want.groupBy("at").agg(F.count("*").alias("__n")).join(near, "at", "left")
    got = State(near, ["at"]).attach(want)
    ranked = F.array_sort(F.transform("near", lambda d: F.struct(
        F.abs(d["x"] - F.col("x")).alias("far"), d["c"].alias("c"), d["s"].alias("s"))))
    got = got.withColumn("ranked", ranked)
    reach = F.aggregate(
        "ranked", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0.0).alias("far")),
        lambda a, d: F.struct((a["seen"] + d["c"]).alias("seen"),
                              F.when(a["seen"] < k, d["far"]).otherwise(a["far"]).alias("far")),
        lambda a: a["far"])
    got = got.withColumn("reach", reach).withColumn("used", F.filter("ranked", lambda d: d["far"] <= F.col("reach")))
    add = lambda part, zero: F.aggregate("used", zero, lambda a, d: a + d[part])
    mean = F.try_divide(add("s", F.lit(0.0)), add("c", F.lit(0).cast("long")))
    return got.select("x", "rows", mean.alias("value"))
