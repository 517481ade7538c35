"""Aggregated data behind charts, and group tests."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from tallyframe.catalog.describe import skew_sql
from tallyframe.catalog.models import AUG, XS, full_fit
from tallyframe.catalog.registry import REG, SHIP, query, reg, rnd, rnd_rows, ship
from tallyframe.catalog.sqlkit import f_tail, t_crit, t_tail
from tallyframe.functions import scalars as S
from tallyframe.operators import associate as assoc
from tallyframe.operators import chartdata as ch
from tallyframe.operators import describe as d
from tallyframe.operators.ordering import row_numbers
from tallyframe.session import State


def _hist_sql(src, x, bins):
    return f"""r AS (SELECT min({x}) AS lo, (max({x}) - min({x})) / {bins} AS w FROM {src}),
h AS (SELECT least(floor(({x} - lo) / w), {bins - 1})::BIGINT AS bin, count(*) AS n FROM {src}, r WHERE {x} IS NOT NULL GROUP BY 1)"""


@query("hist_bins", f"WITH {_hist_sql('events', 'value', 30)} SELECT bin, round(lo + bin * w, 6) AS left, round(lo + (bin + 1) * w, 6) AS right, n FROM h, r")
def _(t):
    return rnd(ch.histogram(t.events, "value", 30).drop("density"))


@query("hist_binwidth", "SELECT floor(l_quantity / 2)::BIGINT AS bin, floor(l_quantity / 2) * 2 AS left, (floor(l_quantity / 2) + 1) * 2 AS right, count(*) AS n FROM lineitem GROUP BY 1, 2, 3")
def _(t):
    return ch.histogram_width(t.lineitem, "l_quantity", 2.0)


@query("hist_density", f"WITH {_hist_sql('events', 'ln(1 + value)', 50)} SELECT bin, round(n / ((SELECT sum(n) FROM h) * w), 6) AS density FROM h, r")
def _(t):
    df = t.events.select(F.log1p("value").alias("log_value"))
    return rnd(ch.histogram(df, "log_value", 50).select("bin", "density"))


def _kde_sql(by):
    g, gb, on = (f"{by} AS g, ", " GROUP BY 1", "USING (g)") if by else ("0 AS g, ", "", "USING (g)")
    return f"""WITH r AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 512 AS w FROM events),
c AS (SELECT {g}least(floor((value - lo) / w), 511) AS b, count(*) AS c FROM events, r GROUP BY 1, 2),
s AS (SELECT {g}count(*) AS n, 0.9 * least(stddev_samp(value), (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34) * pow(count(*), -0.2) AS bw FROM events{gb})
SELECT {'g AS ' + by + ', ' if by else ''}point::INT AS point, round(lo + point * (hi - lo) / 63, 6) AS x,
 round(sum(c * exp(-0.5 * pow(((lo + point * (hi - lo) / 63) - (lo + (b + 0.5) * w)) / bw, 2)) / (n * bw * sqrt(2 * pi()))), 8) AS density
FROM c JOIN s {on}, r, range(64) p(point) GROUP BY ALL"""


@query("density_grid", _kde_sql(None))
def _(t):
    return rnd(ch.density(t.events, "value"), 6, density=8)


@query("density_grid_grouped", _kde_sql("event_type"))
def _(t):
    return rnd(ch.density(t.events, "value", by=["event_type"]), 6, density=8)


@query("box_stats", """WITH q AS (SELECT event_type, quantile_cont(value, [0.25, 0.5, 0.75]) AS q FROM events GROUP BY 1)
SELECT event_type, round(any_value(q[1]), 6) AS q1, round(any_value(q[2]), 6) AS median, round(any_value(q[3]), 6) AS q3,
 min(value) FILTER (value >= q[1] - 1.5 * (q[3] - q[1])) AS whisker_low, max(value) FILTER (value <= q[3] + 1.5 * (q[3] - q[1])) AS whisker_high,
 count(*) FILTER (value < q[1] - 1.5 * (q[3] - q[1]) OR value > q[3] + 1.5 * (q[3] - q[1])) AS n_outliers
FROM events JOIN q USING (event_type) GROUP BY 1""")
def _(t):
    return rnd(ch.box_stats(t.events, ["event_type"], "value"))


@query("box_stats_two_keys", """WITH q AS (SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, round(any_value(q[1]), 6) AS q1, round(any_value(q[2]), 6) AS median, round(any_value(q[3]), 6) AS q3,
 min(l_extendedprice) FILTER (l_extendedprice >= q[1] - 1.5 * (q[3] - q[1])) AS whisker_low, max(l_extendedprice) FILTER (l_extendedprice <= q[3] + 1.5 * (q[3] - q[1])) AS whisker_high,
 count(*) FILTER (l_extendedprice < q[1] - 1.5 * (q[3] - q[1]) OR l_extendedprice > q[3] + 1.5 * (q[3] - q[1])) AS n_outliers
FROM lineitem JOIN q USING (l_returnflag, l_linestatus) GROUP BY 1, 2""")
def _(t):
    return rnd(ch.box_stats(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice"))


@query("bin2d_counts", """WITH r AS (SELECT min(l_quantity) AS a, (max(l_quantity) - min(l_quantity)) / 60 AS wa, min(l_extendedprice) AS b, (max(l_extendedprice) - min(l_extendedprice)) / 60 AS wb FROM lineitem)
SELECT least(floor((l_quantity - a) / wa), 59)::BIGINT AS x_bin, least(floor((l_extendedprice - b) / wb), 59)::BIGINT AS y_bin, count(*) AS n FROM lineitem, r GROUP BY 1, 2""")
def _(t):
    return ch.bin2d(t.lineitem, "l_quantity", "l_extendedprice", 60)


@query("bar_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return d.value_counts(t.events, ["event_type"])


@query("bar_share", "SELECT event_type, round(count(*)::DOUBLE / sum(count(*)) OVER (), 8) AS share FROM events GROUP BY 1")
def _(t):
    return rnd(d.with_share(d.value_counts(t.events, ["event_type"]), name="share", scale=1.0).drop("n"), 8)


@query("bar_stack", "SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2")
def _(t):
    return d.value_counts(t.part, ["p_type", "p_brand"])


@query("bar_fill", "SELECT p_type, p_brand, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY p_type), 8) AS share FROM part GROUP BY 1, 2")
def _(t):
    cells = d.value_counts(t.part, ["p_type", "p_brand"])
    bars = cells.groupBy("p_type").agg(F.sum("n").alias("total"))
    return rnd(State(bars, ["p_type"]).attach(cells).select("p_type", "p_brand", (F.col("n") / F.col("total")).alias("share")), 8)


@query("col_means", "SELECT p_type, round(avg(p_retailprice), 6) AS mean_price FROM part GROUP BY 1")
def _(t):
    return rnd(t.part.groupBy("p_type").agg(F.avg("p_retailprice").alias("mean_price")).orderBy("mean_price"))


@query("line_series", f"""WITH {SHIP}, top AS (SELECT l_suppkey FROM ship GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 5)
SELECT s_name, month, round(avg(dep_delay), 6) AS mean_delay FROM ship JOIN supplier ON l_suppkey = s_suppkey
WHERE dep_delay IS NOT NULL AND l_suppkey IN (SELECT l_suppkey FROM top) GROUP BY 1, 2""")
def _(t):
    df = ship(t)
    top = d.value_counts(df, ["l_suppkey"]).orderBy(F.desc("n"), "l_suppkey").limit(5).select("l_suppkey")
    few = df.where(F.col("dep_delay").isNotNull()).join(F.broadcast(top), "l_suppkey", "left_semi")   # five rows
    means = few.groupBy("l_suppkey", "month").agg(F.avg("dep_delay").alias("mean_delay"))
    return rnd(means.join(t.supplier, means.l_suppkey == t.supplier.s_suppkey, "left").select("s_name", "month", "mean_delay"))


@query("line_series_total", f"WITH {SHIP} SELECT month, round(avg(dep_delay), 6) AS mean_delay FROM ship WHERE dep_delay IS NOT NULL GROUP BY 1")
def _(t):
    return rnd(ship(t).where("dep_delay IS NOT NULL").groupBy("month").agg(F.avg("dep_delay").alias("mean_delay")).orderBy("month"))


@query("hourly_means", "SELECT hour(ts)::INT AS hour_of_day, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def _(t):
    return rnd(t.events.groupBy(F.hour("ts").alias("hour_of_day")).agg(F.avg("value").alias("mean_value")).orderBy("hour_of_day"))


def _trend_sql(keys):
    k = ", ".join(keys)
    return f"""WITH {REG} SELECT {k}, round(regr_slope(charge, price), 8) AS slope, round(regr_intercept(charge, price), 6) AS intercept,
 round(regr_r2(charge, price), 8) AS r2, count(*) AS n FROM reg GROUP BY {k}"""


@query("grouped_trend", _trend_sql(["l_returnflag"]))
def _(t):
    return rnd(ch.linear_trends(reg(t), ["l_returnflag"], "price", "charge"), 8, intercept=6)


@query("grouped_trend_two_keys", _trend_sql(["l_returnflag", "l_linestatus"]))
def _(t):
    return rnd(ch.linear_trends(reg(t), ["l_returnflag", "l_linestatus"], "price", "charge"), 8, intercept=6)


def _band_sql(keys, points):
    """The band from the textbook formula; all groups are large, so the quantile's expansion
    around the normal one serves."""
    k = "".join(f"{c}, " for c in keys)
    return f"""WITH {REG}, g AS (SELECT {k}count(*) AS n, min(price) AS lo, max(price) AS hi, avg(price) AS mx, avg(charge) AS my,
 var_pop(price) * count(*) AS sxx, var_pop(charge) * count(*) AS syy, covar_pop(charge, price) * count(*) AS sxy FROM reg {"GROUP BY " + k[:-2] if k else ""}),
s AS (SELECT *, sxy / sxx AS b, sqrt((syy - sxy * sxy / sxx) / (n - 2)) AS sigma, {t_crit("(n - 2)")} AS t FROM g),
p AS (SELECT *, lo + i * (hi - lo) / {points - 1} AS x FROM s, range({points}) r(i)),
h AS (SELECT *, my + b * (x - mx) AS fit, t * sigma * sqrt(1.0::DOUBLE / n + pow(x - mx, 2) / sxx) AS half FROM p)
SELECT {k}round(x, 6) AS x, round(fit, 6) AS fit, round(fit - half, 6) AS lower, round(fit + half, 6) AS upper FROM h"""


@query("trend_band", _band_sql([], 80))
def _(t):
    return rnd(ch.trend_band(reg(t), [], "price", "charge"))


@query("trend_band_grouped", _band_sql(["l_returnflag", "l_linestatus"], 20))
def _(t):
    return rnd(ch.trend_band(reg(t), ["l_returnflag", "l_linestatus"], "price", "charge", points=20))


_CUTS = [k / 20 for k in range(1, 20)]


@query("binned_trend", f"""WITH {REG}, q AS (SELECT quantile_cont(price, {_CUTS}) AS e FROM reg)
SELECT (1 + len(list_filter(e, lambda b: b < price)))::INT AS band, round(avg(price), 6) AS x_mean, round(avg(charge), 6) AS y_mean, count(*) AS n FROM reg, q GROUP BY 1""")
def _(t):
    return rnd(ch.binned_trend(reg(t), "price", "charge", 20))


_QQ_P = [(i + 1) / 100 for i in range(99)]
_QQ_Z = [NormalDist().inv_cdf(p) for p in _QQ_P]


@query("qq_points", f"""WITH {AUG} SELECT unnest({_QQ_P})::DOUBLE AS p, round(unnest({_QQ_Z})::DOUBLE, 6) AS theoretical, round(unnest(quantile_cont(resid, {_QQ_P})), 6) AS sample,
 round(quantile_cont(resid, 0.25) + (quantile_cont(resid, 0.75) - quantile_cont(resid, 0.25)) / 2 * (1 + unnest({_QQ_Z})::DOUBLE / {_QQ_Z[74]}), 6) AS line FROM aug""")
def _(t):
    df = reg(t)
    f = full_fit(df)
    return rnd(ch.qq_points(df.select((f.y - f.prediction()).alias("resid")), "resid"))


@query("residual_by_predictor", f"WITH {AUG} SELECT round(resid, 5) + 0.0 AS residual, predictor, round(value, 5) AS value FROM (SELECT resid, price, disc, tax FROM aug) UNPIVOT (value FOR predictor IN (price, disc, tax))")
def _(t):
    df = reg(t)
    f = full_fit(df)
    long = df.select((f.y - f.prediction()).alias("residual"), *XS).unpivot(["residual"], XS, "predictor", "value")
    return rnd_rows(long)


@query("actual_vs_predicted", f"WITH {AUG} SELECT round(charge, 5) AS actual, round(fitted, 5) AS predicted, round(resid, 5) + 0.0 AS residual FROM aug")
def _(t):
    df = reg(t)
    return rnd_rows(full_fit(df).predict(df, "predicted").select(
        F.col("charge").alias("actual"), "predicted", (F.col("charge") - F.col("predicted")).alias("residual")))


@query("sorted_actual_predicted", f"""WITH {AUG} SELECT row_number() OVER (ORDER BY charge, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS obs,
 round(charge, 5) AS actual, round(fitted, 5) AS predicted FROM aug""")
def _(t):
    df = reg(t)
    out = full_fit(df).predict(df, "predicted").select("charge", "predicted", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    numbered = row_numbers(out, ["charge", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return rnd_rows(numbered.select("obs", F.col("charge").alias("actual"), "predicted"))


_PAIR = ["charge", "price", "qty"]


def _pair_hist_sql(c):
    return f"""SELECT '{c}', '{c}', NULL, bin, count(*) FROM (SELECT least(floor(({c} - lo) / w), 9)::INT + 1 AS bin FROM reg,
 (SELECT min({c}) AS lo, (max({c}) - min({c})) / 10 AS w FROM reg)) GROUP BY bin"""


@query("pair_summary", f"WITH {REG} " + " UNION ALL ".join(
    [f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r, NULL::INT AS bin, NULL::BIGINT AS n FROM reg" for i, a in enumerate(_PAIR) for b in _PAIR[i + 1:]]
    + [_pair_hist_sql(c) for c in _PAIR]))
def _(t):
    df = reg(t)
    long = assoc.correlation_long(t.spark, assoc.correlation(df, _PAIR))
    place = {c: i for i, c in enumerate(_PAIR)}
    pos = lambda c: S.case_when(*[(F.col(c) == k, F.lit(v)) for k, v in place.items()])
    pairs = rnd(long.where(pos("row") < pos("col")).toDF("x", "y", "r"))
    pairs = pairs.select("*", F.lit(None).cast("int").alias("bin"), F.lit(None).cast("long").alias("n"))
    return pairs.unionByName(ch.histograms(df, _PAIR, 10).select(
        F.col("variable").alias("x"), F.col("variable").alias("y"), F.lit(None).cast("double").alias("r"), "bin", "n"))


# ── tests ────────────────────────────────────────────────────────────────────


@query("corr_test", f"""WITH {REG}, s AS (SELECT count(*) AS n, corr(qty, price) AS r FROM reg), u AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM s)
SELECT round(r, 8) AS estimate, round(t, 6) AS statistic, n - 2 AS df, {t_tail('t', '(n - 2)')} AS p_value,
 round(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 8) AS conf_low, round(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 8) AS conf_high FROM u""")
def _(t):
    got = assoc.correlation_test(reg(t), "qty", "price")
    out = t.spark.createDataFrame([tuple(got.values())], (
        "estimate double, statistic double, df long, p_value double, conf_low double, conf_high double"))
    return rnd(out, 8, statistic=6, p_value=6)


@query("anova_oneway", f"""WITH g AS (SELECT p_type, count(*) AS n, avg(p_retailprice) AS m, var_pop(p_retailprice) * count(*) AS ss FROM part GROUP BY 1),
a AS (SELECT count(*) - 1 AS d1, sum(n)::BIGINT - count(*) AS d2, sum(ss) AS ssw, sum(n * pow(m - (SELECT avg(p_retailprice) FROM part), 2)) AS ssb FROM g)
SELECT 'p_type' AS term, d1 AS df, round(ssb, 4) AS sum_sq, round(ssb / d1, 4) AS mean_sq, round((ssb / d1) / (ssw / d2), 6) AS statistic,
 {f_tail('((ssb / d1) / (ssw / d2))', 'd1', 'd2')} AS p_value FROM a
UNION ALL SELECT 'Residuals', d2, round(ssw, 4), round(ssw / d2, 4), NULL, NULL FROM a""")
def _(t):
    return rnd(assoc.anova_oneway(t.part, "p_retailprice", "p_type"), 6, sum_sq=4, mean_sq=4)


@query("normality_test", f"""WITH m AS (SELECT count(*) AS n, {skew_sql('p_retailprice')} AS s, kurtosis_pop(p_retailprice) AS k FROM (SELECT p_retailprice / 100 AS p_retailprice FROM part))
SELECT n, round(s, 6) AS skewness, round(k, 6) AS kurtosis, round(n / 6.0 * (s * s + k * k / 4), 4) AS statistic, round(exp(-n / 12.0 * (s * s + k * k / 4)), 8) AS p_value FROM m""")
def _(t):
    return rnd(assoc.jarque_bera(t.part, F.col("p_retailprice") / 100), 6, statistic=4, p_value=8)
