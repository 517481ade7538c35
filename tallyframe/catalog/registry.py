"""Registration of queries and shared base frames, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.catalog.sqlkit import bucket
from tallyframe.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def rounded(c, digits: int):
    """Half away from zero by scaling, as the SQL side rounds, so ties agree.

    Values too large to have that many digits, NaN and infinities stay as they are.
    """
    c, m = (F.col(c) if isinstance(c, str) else c), float(10**digits)
    near = F.when(c >= 0, F.floor(c * m + 0.5) / m).when(c < 0, F.ceil(c * m - 0.5) / m)
    return F.when(F.isnan(c) | (F.abs(c) >= 2.0**52 / m), c.cast("double")).otherwise(near)


def rnd(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round floating columns at the end, so sum order does not show."""
    return df.select(*[
        rounded(c, special.get(c, digits)).alias(c) if t in ("double", "float") else F.col(c)
        for c, t in df.dtypes
    ])


def rnd_rows(df: DataFrame) -> DataFrame:
    """Fewer digits for per-row model values, where one fit meets very many rows."""
    return rnd(df, 5)


# ── base frames ──────────────────────────────────────────────────────────────
# Shipment lines with a signed number that is sometimes unknown: days from
# mid-month (8 % NULL) and a second one NULL for another 5 %.

def ship(t: Tables) -> DataFrame:
    df = t.lineitem
    day = F.dayofmonth("l_shipdate")
    delay = F.when(F.col("l_orderkey") % 25 >= 2, day - 15)
    df = df.withColumn("year", F.year("l_shipdate")).withColumn("month", F.month("l_shipdate"))
    df = df.withColumn("day", day).withColumn("dep_delay", delay)
    return df.withColumn(
        "arr_delay", F.when(F.col("l_orderkey") % 20 != 0, F.col("dep_delay") + F.col("l_linenumber") - 3))


SHIP = """ship0 AS (SELECT *, year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month,
  day(l_shipdate)::INT AS day,
  CASE WHEN l_orderkey % 25 >= 2 THEN (day(l_shipdate) - 15)::INT END AS dep_delay FROM lineitem),
ship AS (SELECT *, CASE WHEN l_orderkey % 20 <> 0 THEN dep_delay + l_linenumber - 3 END AS arr_delay
  FROM ship0)"""


# Parts with injected NULLs: 5 % of prices, 8 % of sizes, 3 % of types.
def part_na(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(
        "p_partkey", "p_brand",
        F.when(k % 20 != 0, F.col("p_retailprice")).alias("price"),
        F.when(k % 25 >= 2, F.col("p_size")).alias("size"),
        F.when(k % 100 >= 3, F.col("p_type")).alias("type"),
    )


PART_NA = """part_na AS (SELECT p_partkey, p_brand,
  CASE WHEN p_partkey % 20 <> 0 THEN p_retailprice END AS price,
  CASE WHEN p_partkey % 25 >= 2 THEN p_size END AS size,
  CASE WHEN p_partkey % 100 >= 3 THEN p_type END AS type FROM part)"""


# Regression columns of the lines, scaled to similar size.
def reg(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice") / 1000
    return t.lineitem.select(
        *LINE_KEY, "l_returnflag", "l_linestatus",
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
        price.alias("price"), (F.col("l_discount") * 100).alias("disc"), (F.col("l_tax") * 100).alias("tax"),
        F.col("l_quantity").alias("qty"),
    )


REG = """reg AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
  l_returnflag, l_linestatus,
  l_extendedprice / 1000 * (1 - l_discount) * (1 + l_tax) AS charge, l_extendedprice / 1000 AS price,
  l_discount * 100 AS disc, l_tax * 100 AS tax, l_quantity AS qty FROM lineitem)"""

TRAIN_SQL = bucket(["l_orderkey", "l_linenumber"], 10)
