"""Aggregates, frequencies, profiles, missing values, outliers, association."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.registry import PART_NA, SHIP, part_na, query, reg, REG, rnd, ship
from tallyframe.operators import associate as assoc
from tallyframe.operators import describe as d
from tallyframe.operators import frame as fr
from tallyframe.operators.features import fit_zscore
from tallyframe.operators.quantiles import grouped_quantiles, median, quantiles, trimmed_mean


def one_row(t, **values):
    """A row of fitted scalars."""
    return t.spark.createDataFrame([tuple(values.values())], list(values))


# ── aggregates ───────────────────────────────────────────────────────────────


@query("agg_global", f"""WITH {SHIP} SELECT count(*) AS n, round(avg(dep_delay), 6) AS mean_delay,
 quantile_cont(dep_delay::DOUBLE, 0.5) AS median_delay, max(dep_delay) AS max_delay,
 round(avg((dep_delay > 0)::INT) * 100, 6) AS pct_delayed FROM ship""")
def _(t):
    df, x = ship(t), F.col("dep_delay")
    med = median(df, "dep_delay")
    return rnd(df.agg(F.count("*").alias("n"), F.avg(x).alias("mean_delay"), F.lit(med).alias("median_delay"),
                      F.max(x).alias("max_delay"), d.share_true(x > 0).alias("pct_delayed")))


@query("agg_by_key", f"""WITH {SHIP} SELECT l_suppkey, count(*) AS n, round(avg(dep_delay), 6) AS mean_delay,
 round(avg((dep_delay > 0)::INT) * 100, 6) AS pct_delayed FROM ship GROUP BY 1""")
def _(t):
    x = F.col("dep_delay")
    return rnd(ship(t).groupBy("l_suppkey").agg(F.count("*").alias("n"), F.avg(x).alias("mean_delay"),
                                                d.share_true(x > 0).alias("pct_delayed"))
               .orderBy(F.desc("mean_delay"), "l_suppkey"))


@query("agg_by_keys", f"WITH {SHIP} SELECT l_suppkey, month, round(avg(dep_delay), 6) AS mean_delay, count(*) AS n FROM ship GROUP BY 1, 2")
def _(t):
    return rnd(ship(t).groupBy("l_suppkey", "month").agg(F.avg("dep_delay").alias("mean_delay"), F.count("*").alias("n")))


@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def _(t):
    return t.lineitem.agg(F.count("*").alias("n"))


@query("agg_mean_sum", "SELECT round(avg(l_quantity), 6) AS mean, sum(l_quantity) AS total FROM lineitem")
def _(t):
    return rnd(t.lineitem.agg(F.avg("l_quantity").alias("mean"), F.sum("l_quantity").alias("total")))


@query("agg_min_max_range", "SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, max(o_totalprice) - min(o_totalprice) AS span FROM orders")
def _(t):
    x = F.col("o_totalprice")
    return t.orders.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), (F.max(x) - F.min(x)).alias("span"))


@query("agg_median", "SELECT round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem")
def _(t):
    return rnd(one_row(t, median=median(t.lineitem, "l_extendedprice")))


@query("agg_median_grouped", "SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem GROUP BY 1, 2")
def _(t):
    return rnd(grouped_quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", [0.5], ["median"]))


@query("agg_var_sd", "SELECT o_orderpriority, round(var_samp(o_totalprice / 1000), 5) AS variance, round(stddev_samp(o_totalprice / 1000), 6) AS sd FROM orders GROUP BY 1")
def _(t):
    x = F.col("o_totalprice") / 1000
    return rnd(t.orders.groupBy("o_orderpriority").agg(F.var_samp(x).alias("variance"), F.stddev_samp(x).alias("sd")), variance=5)


@query("agg_share_true", f"WITH {SHIP} SELECT month, round(avg((dep_delay > 5)::INT) * 100, 6) AS pct FROM ship GROUP BY 1")
def _(t):
    return rnd(ship(t).groupBy("month").agg(d.share_true(F.col("dep_delay") > 5).alias("pct")))


@query("agg_cv", "SELECT p_type, round(stddev_samp(p_retailprice) / avg(p_retailprice) * 100, 6) AS cv FROM part GROUP BY 1")
def _(t):
    return rnd(t.part.groupBy("p_type").agg(d.coefficient_of_variation(F.col("p_retailprice")).alias("cv")))


@query("agg_iqr", "SELECT round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr FROM events")
def _(t):
    q1, q3 = quantiles(t.events, ["value"], [0.25, 0.75])["value"]
    return rnd(one_row(t, iqr=q3 - q1))


PROBS = [0.0, 0.1, 0.2, 0.25, 0.4, 0.5, 0.6, 0.75, 0.8, 0.9, 1.0]


@query("agg_quantiles", f"SELECT p::DOUBLE AS p, round(q, 6) AS q FROM (SELECT unnest({PROBS}) AS p, unnest(quantile_cont(value, {PROBS})) AS q FROM events)")
def _(t):
    got = quantiles(t.events, ["value"], PROBS)["value"]
    return rnd(t.spark.createDataFrame(list(zip(PROBS, got)), "p double, q double"))


def _five_sql(table, cols):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, min({c})::DOUBLE AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q1,
 round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median, round(avg({c}), 6) AS mean,
 round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q3, max({c})::DOUBLE AS max FROM {table}""" for c in cols)


@query("five_number_summary", _five_sql("events", ["value"]))
def _(t):
    return rnd(d.five_number(t.events, ["value"]))


LINE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("summary_all_columns", _five_sql("lineitem", LINE_NUMERIC))
def _(t):
    return rnd(d.five_number(t.lineitem, fr.numeric_columns(t.lineitem)))


@query("weighted_mean", "SELECT round(sum(l_discount * l_quantity) / sum(l_quantity), 8) AS wm FROM lineitem")
def _(t):
    return rnd(t.lineitem.agg(d.weighted_mean(F.col("l_discount"), F.col("l_quantity")).alias("wm")), 8)


@query("trimmed_mean", """WITH r AS (SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events)
SELECT round(avg(value), 6) AS trimmed FROM r WHERE i > floor(n * 0.1) AND i <= n - floor(n * 0.1)""")
def _(t):
    return rnd(one_row(t, trimmed=trimmed_mean(t.events, "value", 0.1)))


@query("mode_numeric", """SELECT p_size AS p_size_mode FROM part GROUP BY 1 ORDER BY count(*) DESC, p_size LIMIT 1""")
def _(t):
    return d.mode(t.part, "p_size")


@query("mode_categorical", """SELECT p_type, p_brand AS p_brand_mode FROM (SELECT p_type, p_brand,
 row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS r FROM part GROUP BY 1, 2) WHERE r = 1""")
def _(t):
    return d.mode(t.part, "p_brand", by=["p_type"])


# SQL moments are spelled out: DuckDB's skewness is bias-corrected.
def skew_sql(x):
    return (f"(avg(pow({x}, 3)) - 3 * avg({x}) * avg(pow({x}, 2)) + 2 * pow(avg({x}), 3)) / pow(var_pop({x}), 1.5)")


@query("agg_skewness", f"SELECT event_type, round({skew_sql('value')}, 6) AS skewness FROM events GROUP BY 1")
def _(t):
    return rnd(t.events.groupBy("event_type").agg(F.skewness("value").alias("skewness")))


@query("agg_kurtosis", "SELECT event_type, round(kurtosis_pop(value) + 3, 6) AS kurtosis_raw, round(kurtosis_pop(value), 6) AS kurtosis_excess FROM events GROUP BY 1")
def _(t):
    return rnd(t.events.groupBy("event_type").agg(
        d.kurtosis_raw(F.col("value")).alias("kurtosis_raw"), F.kurtosis("value").alias("kurtosis_excess")))


@query("mean_median_gap", "SELECT round(avg(value) - quantile_cont(value, 0.5), 6) AS gap FROM events")
def _(t):
    med = median(t.events, "value")
    return rnd(t.events.agg((F.avg("value") - med).alias("gap")))


@query("skew_by_transform", f"""SELECT 'raw' AS scale, round({skew_sql('value')}, 6) AS skewness FROM events
UNION ALL SELECT 'log', round({skew_sql('ln(value + 1)')}, 6) FROM events UNION ALL SELECT 'sqrt', round({skew_sql('sqrt(value)')}, 6) FROM events""")
def _(t):
    v = F.col("value")
    row = t.events.agg(F.skewness(v).alias("raw"), F.skewness(F.log1p(v)).alias("log"), F.skewness(F.sqrt(v)).alias("sqrt"))
    return rnd(row.unpivot([], ["raw", "log", "sqrt"], "scale", "skewness"))


# ── frequencies ──────────────────────────────────────────────────────────────


@query("count_by", f"WITH {PART_NA} SELECT type, count(*) AS n FROM part_na GROUP BY 1")
def _(t):
    return d.value_counts(part_na(t), ["type"])


@query("count_by_sorted", "SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(t):
    return d.value_counts(t.lineitem, ["l_suppkey", "l_linenumber"]).orderBy(F.desc("n"), "l_suppkey", "l_linenumber")


@query("freq_table", f"WITH {PART_NA} SELECT type, count(*) AS n FROM part_na WHERE type IS NOT NULL GROUP BY 1")
def _(t):
    return d.value_counts(part_na(t), ["type"], keep_null=False)


@query("freq_share", f"""WITH {PART_NA} SELECT type, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 8) AS share
FROM part_na WHERE type IS NOT NULL GROUP BY 1""")
def _(t):
    return rnd(d.with_share(d.value_counts(part_na(t), ["type"], keep_null=False), name="share", scale=1.0), 8)


STATUSES = ["F", "O", "P"]


@query("crosstab", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
 count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def _(t):
    return d.crosstab(t.orders, "o_orderpriority", "o_orderstatus")


@query("tabyl", f"""WITH {PART_NA} SELECT type, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM part_na), 8) AS percent,
 CASE WHEN type IS NOT NULL THEN round(count(*)::DOUBLE / (SELECT count(type) FROM part_na), 8) END AS valid_percent FROM part_na GROUP BY 1""")
def _(t):
    counts = d.value_counts(part_na(t), ["type"])
    valid = counts.agg(F.sum(F.when(F.col("type").isNotNull(), F.col("n")))).scalar()
    out = d.with_share(counts, name="percent", scale=1.0)
    return rnd(out.withColumn("valid_percent", F.when(F.col("type").isNotNull(), F.col("n") / valid)), 8)


@query("crosstab_row_pct", """SELECT o_orderpriority, format('{:.1f}%', round(F * 100.0::DOUBLE / (F + O + P), 1)) AS F,
 format('{:.1f}%', round(O * 100.0::DOUBLE / (F + O + P), 1)) AS O, format('{:.1f}%', round(P * 100.0::DOUBLE / (F + O + P), 1)) AS P FROM (
 SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
 count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1)""")
def _(t):
    return d.row_percent(d.crosstab(t.orders, "o_orderpriority", "o_orderstatus", STATUSES), STATUSES)


@query("distinct_values", "SELECT DISTINCT l_suppkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey").distinct()


# ── several columns at once ──────────────────────────────────────────────────

ACROSS = ["l_quantity", "l_discount", "l_tax"]


@query("summarise_across", "SELECT " + ", ".join(
    f"round(avg({c}), 2) AS {c}_mean, round(stddev_samp({c}), 4) AS {c}_sd, min({c}) AS {c}_min, max({c}) AS {c}_max, "
    f"round(quantile_cont({c}, 0.5), 6) AS {c}_median" for c in ACROSS) + " FROM lineitem")
def _(t):
    q = quantiles(t.lineitem, ACROSS, [0.5])
    out = fr.summarise_across(t.lineitem, ACROSS, {
        "mean": lambda x: F.round(F.avg(x), 2), "sd": lambda x: F.round(F.stddev_samp(x), 4), "min": F.min, "max": F.max})
    return out.withColumns({f"{c}_median": F.lit(q[c][0]) for c in ACROSS})


def _hist_text_sql(c, source="orders"):
    return f"""(WITH l AS (SELECT min({c})::DOUBLE AS lo, (max({c})::DOUBLE - min({c})::DOUBLE) / 8 AS w FROM {source}),
 h AS (SELECT least(floor(({c} - lo) / w), 7)::BIGINT AS bin, count(*) AS n FROM {source}, l WHERE {c} IS NOT NULL GROUP BY 1)
 SELECT string_agg(substring('▁▂▃▄▅▆▇█', 1 + least(7, floor(8.0::DOUBLE * coalesce(n, 0) / (SELECT max(n) FROM h)))::INT, 1), '' ORDER BY b)
 FROM range(8) r(b) LEFT JOIN h ON bin = b)"""


_SKIM_ORDERS = " UNION ALL ".join([f"""SELECT 'numeric' AS type, '{c}' AS variable, count(*) - count({c}) AS n_missing,
 1.0::DOUBLE AS complete_rate, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS sd, min({c})::DOUBLE AS p0,
 round(quantile_cont({c}::DOUBLE, 0.25), 5) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 5) AS p50,
 round(quantile_cont({c}::DOUBLE, 0.75), 5) AS p75, max({c})::DOUBLE AS p100, {_hist_text_sql(c)} AS hist,
 NULL::BIGINT AS n_unique, NULL::VARCHAR AS top_counts FROM orders""" for c in ("o_totalprice", "o_custkey")] + [
    f"""SELECT 'character', '{c}', 0, 1.0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}),
 (SELECT string_agg({c} || ': ' || n, ', ' ORDER BY n DESC, {c}) FROM
 (SELECT {c}, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 4)) FROM orders""" for c in ("o_orderstatus", "o_orderpriority")])


@query("profile_skim", _SKIM_ORDERS)
def _(t):
    return rnd(d.skim(t.orders.select("o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority")), 5)


_SKIM_PART = " UNION ALL ".join(f"""SELECT 'numeric' AS type, '{c}' AS variable, count(*) FILTER ({c} IS NULL) AS n_missing,
 round(count({c})::DOUBLE / count(*), 6) AS complete_rate, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd,
 min({c})::DOUBLE AS p0, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
 round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, max({c})::DOUBLE AS p100, {_hist_text_sql(c, "part_na")} AS hist, NULL::BIGINT AS n_unique, NULL::VARCHAR AS top_counts FROM part_na"""
                                for c in ("price", "size")) + """
UNION ALL SELECT 'character', 'type', count(*) FILTER (type IS NULL), round(count(type)::DOUBLE / count(*), 6), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
 count(DISTINCT type), (SELECT string_agg(type || ': ' || n, ', ' ORDER BY n DESC, type) FROM
 (SELECT type, count(*) AS n FROM part_na WHERE type IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 4)) FROM part_na"""


@query("profile_skim_nulls", f"WITH {PART_NA} {_SKIM_PART}")
def _(t):
    return rnd(d.skim(part_na(t).select("price", "size", "type")))


def _skim_group_sql(c):
    """A group's numeric row; bins as in the whole-table profile."""
    return f"""SELECT g.type, 'numeric' AS kind, '{c}' AS variable, n_missing, round(known::DOUBLE / n, 6) AS complete_rate, round(mean, 6) AS mean,
 round(sd, 6) AS sd, lo AS p0, round(q[1], 6) AS p25, round(q[2], 6) AS p50, round(q[3], 6) AS p75, hi AS p100,
 array_to_string(list_transform(range(8), lambda b: substring('▁▂▃▄▅▆▇█', 1 + least(7, floor(8.0::DOUBLE
  * len(list_filter(xs, lambda x: least(floor((x - lo) / w), 7) = b)) / greatest(list_max(list_transform(range(8), lambda d:
  len(list_filter(xs, lambda x: least(floor((x - lo) / w), 7) = d)))), 1)))::INT, 1)), '') AS hist,
 NULL::BIGINT AS n_unique, NULL::VARCHAR AS top_counts FROM (SELECT type, count(*) AS n, count({c}) AS known, count(*) - count({c}) AS n_missing, avg({c}) AS mean,
 stddev_samp({c}) AS sd, min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, CASE WHEN max({c}) > min({c}) THEN (max({c})::DOUBLE - min({c})::DOUBLE) / 8 ELSE 1 END AS w,
 quantile_cont({c}::DOUBLE, [0.25, 0.5, 0.75]) AS q, list({c}::DOUBLE) FILTER ({c} IS NOT NULL) AS xs FROM part_na GROUP BY type) g"""


@query("profile_skim_grouped", f"WITH {PART_NA} " + " UNION ALL ".join(map(_skim_group_sql, ("price", "size"))) + """
UNION ALL SELECT type, 'character', 'p_brand', sum(c) FILTER (p_brand IS NULL), 1.0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(p_brand),
 string_agg(p_brand || ': ' || c, ', ' ORDER BY c DESC, p_brand) FILTER (r <= 3) FROM (SELECT type, p_brand, count(*) AS c,
 row_number() OVER (PARTITION BY type ORDER BY count(*) DESC, p_brand) AS r FROM part_na GROUP BY 1, 2) GROUP BY type""".replace(
     "sum(c) FILTER (p_brand IS NULL)", "coalesce(sum(c) FILTER (p_brand IS NULL), 0)::BIGINT"))
def _(t):
    return rnd(d.grouped_profile(part_na(t), ["type"], ["price", "size"], ["p_brand"], top=3))


@query("grouped_stats", """SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 6) AS price_mean, round(stddev_samp(p_retailprice), 6) AS price_sd,
 round(quantile_cont(p_retailprice, 0.5), 6) AS price_median, round(avg((p_retailprice > 950)::INT) * 100, 6) AS pct_above FROM part GROUP BY 1""")
def _(t):
    x = F.col("p_retailprice")
    stats = t.part.groupBy("p_brand").agg(
        F.count("*").alias("n"), F.avg(x).alias("price_mean"), F.stddev_samp(x).alias("price_sd"),
        d.share_true(x > 950).alias("pct_above"))
    med = grouped_quantiles(t.part, ["p_brand"], "p_retailprice", [0.5], ["price_median"]).withColumnRenamed("p_brand", "brand")
    both = stats.join(med, F.col("p_brand").eqNullSafe(F.col("brand"))).drop("brand")     # one row a brand on both sides
    return rnd(both.orderBy(F.desc("price_mean"), "p_brand"))


# ── missing values ───────────────────────────────────────────────────────────


@query("na_total", f"WITH {PART_NA} SELECT (count(*) * 5 - count(p_partkey) - count(p_brand) - count(price) - count(size) - count(type)) AS n FROM part_na")
def _(t):
    return d.null_counts(part_na(t)).agg(F.sum("n_miss").alias("n"))


@query("na_by_column", f"WITH {PART_NA} SELECT 0::BIGINT AS p_partkey, 0::BIGINT AS p_brand, count(*) - count(price) AS price, count(*) - count(size) AS size, count(*) - count(type) AS type FROM part_na")
def _(t):
    df = part_na(t)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


@query("na_pct_by_column", f"""WITH {PART_NA} SELECT round((1 - count(price)::DOUBLE / count(*)) * 100, 6) AS price,
 round((1 - count(size)::DOUBLE / count(*)) * 100, 6) AS size, round((1 - count(type)::DOUBLE / count(*)) * 100, 6) AS type FROM part_na""")
def _(t):
    return rnd(fr.summarise_across(part_na(t), ["price", "size", "type"], {"": lambda x: d.share_true(x.isNull())})
               .toDF("price", "size", "type"))


@query("na_report_long", f"WITH {PART_NA} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS n_miss, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS pct_miss FROM part_na"
    for c in ("p_partkey", "p_brand", "price", "size", "type")))
def _(t):
    return rnd(d.null_counts(part_na(t)))


@query("argmax_value", "SELECT c_mktsegment, arg_max(c_name, c_acctbal) AS richest FROM customer GROUP BY 1")
def _(t):
    return t.customer.groupBy("c_mktsegment").agg(F.max_by("c_name", "c_acctbal").alias("richest"))


# ── outliers ─────────────────────────────────────────────────────────────────


@query("outlier_iqr_flag", """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
SELECT event_id, value, value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS outlier FROM events, q""")
def _(t):
    fence = d.outlier_fences(t.events, ["value"])["value"]
    return t.events.select("event_id", "value", d.outside(F.col("value"), fence).alias("outlier"))


@query("outlier_iqr_counts", " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, count(*) FILTER ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS n_outliers FROM {tb},
 (SELECT quantile_cont({c}::DOUBLE, 0.25) AS a, quantile_cont({c}::DOUBLE, 0.75) AS b FROM {tb})"""
    for tb, c in (("events", "value"), ("events", "user_id"), ("events", "event_id"))))
def _(t):
    cols = fr.numeric_columns(t.events)
    fences = d.outlier_fences(t.events, cols)
    row = t.events.agg(*[F.count_if(d.outside(F.col(c), fences[c])).alias(c) for c in cols])
    return row.unpivot([], cols, "variable", "n_outliers").orderBy(F.desc("n_outliers"), "variable")


@query("outlier_zscore", """SELECT event_id, value FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
WHERE abs((value - m) / s) > 3""")
def _(t):
    m, s = fit_zscore(t.events, ["value"])["value"]
    return t.events.where(F.abs((F.col("value") - m) / s) > 3).select("event_id", "value")


@query("boxplot_outliers", """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
SELECT value FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""")
def _(t):
    fence = d.outlier_fences(t.events, ["value"])["value"]
    return t.events.where(d.outside(F.col("value"), fence)).select("value")


# ── association ──────────────────────────────────────────────────────────────

CORR = ["charge", "price", "disc", "tax", "qty"]


def corr_sql(cols):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS row, '{b}' AS col, round(corr({a}, {b}), 6) AS r FROM reg" for a in cols for b in cols)


@query("corr_matrix", f"WITH {REG} {corr_sql(CORR)}")
def _(t):
    return rnd(assoc.correlation_long(t.spark, assoc.correlation(reg(t), CORR)))


@query("corr_submatrix", f"WITH {REG} {corr_sql(['price', 'qty', 'disc'])}")
def _(t):
    m = assoc.correlation(reg(t), CORR)
    return rnd(assoc.correlation_long(t.spark, m.pick(["price", "qty", "disc"])))


@query("corr_with_target", f"WITH {REG} " + " UNION ALL ".join(
    f"SELECT '{a}' AS variable, round(corr({a}, charge), 6) AS correlation FROM reg" for a in CORR[1:]))
def _(t):
    long = assoc.correlation_long(t.spark, assoc.correlation(reg(t), CORR))
    picked = long.where("col = 'charge' AND row <> 'charge'").select(F.col("row").alias("variable"), F.col("r").alias("correlation"))
    return rnd(picked.orderBy("correlation"))


@query("corr_strength", f"""WITH {REG}, c AS ({corr_sql(CORR)}) SELECT row, col, CASE WHEN abs(r) < 0.2 THEN 'negligible' WHEN abs(r) < 0.4 THEN 'weak'
 WHEN abs(r) < 0.6 THEN 'moderate' WHEN abs(r) < 0.8 THEN 'strong' ELSE 'very strong' END AS strength FROM c""")
def _(t):
    long = assoc.correlation_long(t.spark, assoc.correlation(reg(t), CORR))
    return long.select("row", "col", assoc.strength(F.col("r")).alias("strength"))


# Four columns and their ten products: wide enough for the block product.
_BASE4 = ["price", "disc", "tax", "qty"]
_PRODUCTS = {f"{a}_{b}": (a, b) for i, a in enumerate(_BASE4) for b in _BASE4[i:]}


@query("corr_matrix_wide", f"WITH {REG}, wide AS (SELECT price, disc, tax, qty, "
       + ", ".join(f"{a} * {b} AS {nm}" for nm, (a, b) in _PRODUCTS.items()) + " FROM reg) "
       + " UNION ALL ".join(f"SELECT '{a}' AS row, '{b}' AS col, round(corr({a}, {b}), 6) AS r FROM wide"
                            for a in [*_BASE4, *_PRODUCTS] for b in [*_BASE4, *_PRODUCTS]))
def _(t):
    df = reg(t).withColumns({nm: F.col(a) * F.col(b) for nm, (a, b) in _PRODUCTS.items()})
    return rnd(assoc.correlation_long(t.spark, assoc.correlation(df, [*_BASE4, *_PRODUCTS])))
