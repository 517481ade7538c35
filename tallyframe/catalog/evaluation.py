"""Splits, error measures, cross-validation, intervals and reports."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallyframe.catalog.models import (
    LADDER, REST, SPLIT, TRAIN, TRAINED, XS, cv_frame, full_fit, half_sql, moment_state, tidy_sql, train_test,
)
from tallyframe.catalog.registry import REG, TRAIN_SQL, query, reg, rnd
from tallyframe.catalog.sqlkit import bucket, hat, key_hash, pred, sweep
from tallyframe.operators import frame as fr
from tallyframe.operators.features import band_by_edges, quantile_edges
from tallyframe.operators.ordering import adjacent_sums, row_numbers
from tallyframe.plans import evaluate as ev
from tallyframe.plans import ols
from tallyframe.plans.moments import moments

P = pred(XS)
E = f"(charge - {P})"


# ── splits ───────────────────────────────────────────────────────────────────


@query("train_test_split", f"""SELECT CASE WHEN {TRAIN_SQL} < 8 THEN 'train' ELSE 'test' END AS part, l_orderkey, l_linenumber, l_partkey FROM lineitem""")
def _(t):
    train, test = ev.split(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), SPLIT)
    return fr.bind_rows(train.select(F.lit("train").alias("part"), "*"), test.select(F.lit("test").alias("part"), "*"))


_KEYS = ", ".join([*SPLIT, *REST])
def _strata(source):
    return f"""qs AS (SELECT quantile_cont(charge, [0.25, 0.5, 0.75]) AS e FROM {source}),
banded AS (SELECT r.*, CASE WHEN charge <= e[1] THEN 1 WHEN charge <= e[2] THEN 2 WHEN charge <= e[3] THEN 3 ELSE 4 END AS stratum,
 {key_hash(SPLIT)} AS h FROM {source} r, qs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, {_KEYS}) AS rank, count(*) OVER (PARTITION BY stratum) AS size FROM banded)"""


STRATA = f"{REG}, {_strata('reg')}"


@query("stratified_split", f"WITH {STRATA} SELECT l_orderkey, l_linenumber, l_partkey, stratum, CASE WHEN rank <= floor(size * 0.8) THEN 'train' ELSE 'test' END AS part FROM ranked")
def _(t):
    out = ev.stratified_split(reg(t), "charge", SPLIT, [*SPLIT, *REST])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "stratum", "part")


# ── error measures on the test rows ──────────────────────────────────────────

SCORED = f"{TRAINED}, mu AS (SELECT avg(charge) AS m FROM train), sc AS (SELECT test.*, {P} AS pred, {E} AS e FROM test, f)"


def scored(t):
    """Test rows with the prediction of a model fitted on the training rows."""
    train, test = train_test(t)
    f = full_fit(train)
    return f.predict(test, "pred"), f, train, test


@query("metrics_manual", f"""WITH {SCORED} SELECT round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
 round(avg(abs(e / charge)) * 100, 6) AS mape, round(1 - sum(e * e) / sum(pow(charge - m, 2)), 8) AS r2_vs_train_mean FROM sc, mu""")
def _(t):
    df, f, _train, _test = scored(t)
    m = ev.metric_columns(F.col("charge"), F.col("pred"), f.ybar)
    return rnd(df.agg(*[m[k].alias(k) for k in ("mae", "mse", "rmse", "mape", "r2_vs_train_mean")]), 6, r2_vs_train_mean=8)


@query("metrics_set", f"""WITH {SCORED} SELECT 'rmse' AS metric, round(sqrt(avg(e * e)), 6) AS estimate FROM sc UNION ALL SELECT 'mae', round(avg(abs(e)), 6) FROM sc
UNION ALL SELECT 'rsq_corr', round(pow(corr(charge, pred), 2), 6) FROM sc UNION ALL SELECT 'mape', round(avg(abs(e / charge)) * 100, 6) FROM sc""")
def _(t):
    return rnd(ev.metric_set(scored(t)[0], "charge", "pred", ["rmse", "mae", "rsq_corr", "mape"]))


@query("eval_regression", f"""WITH {SCORED} SELECT 'OLS' AS model, count(*) AS n, round(avg(abs(e)), 3) AS mae, round(sqrt(avg(e * e)), 3) AS rmse,
 round(avg(abs(e / charge)) * 100, 2) AS mape, round(1 - sum(e * e) / sum(pow(charge - m, 2)), 4) AS r2 FROM sc, mu""")
def _(t):
    df, f, _train, _test = scored(t)
    return ev.eval_regression(df, F.col("charge"), F.col("pred"), "OLS", f.ybar)


@query("adj_r2", f"WITH {SCORED}, r AS (SELECT count(*) AS n, 1 - sum(e * e) / sum(pow(charge - m, 2)) AS r2 FROM sc, mu) SELECT round(1 - (1 - r2) * (n - 1) / (n - 4), 8) AS adj_r2 FROM r")
def _(t):
    df, f, _train, _test = scored(t)
    m = ev.metric_columns(F.col("charge"), F.col("pred"), f.ybar)
    return rnd(df.agg((1 - (1 - m["r2_vs_train_mean"]) * (m["n"] - 1) / (m["n"] - f.p - 1)).alias("adj_r2")), 8)


@query("mase", """WITH s AS (SELECT o_totalprice / 1000 AS y, lag(o_totalprice / 1000) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders),
m AS (SELECT avg(y) AS mu FROM s), a AS (SELECT avg(abs(y - mu)) AS mae FROM s, m), b AS (SELECT avg(abs(y - before)) AS naive FROM s)
SELECT round(mae, 6) AS mae, round(naive, 6) AS naive_mae, round(mae / naive, 6) AS mase FROM a, b""")
def _(t):
    df = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", (F.col("o_totalprice") / 1000).alias("y"))
    mu = df.agg(F.avg("y")).first()[0]
    mae = df.agg(F.avg(F.abs(F.col("y") - mu))).first()[0]
    s = adjacent_sums(df, F.col("y"), ["o_orderdate", "o_orderkey"], by=["o_custkey"])
    naive = s["abs"] / s["pairs"]
    return rnd(t.spark.createDataFrame([(mae, naive, mae / naive)], "mae double, naive_mae double, mase double"))


@query("optimism_bias", f"""WITH {TRAINED}, r AS (SELECT sqrt(avg(pow({E}, 2)) FILTER (WHERE {TRAIN_SQL} < 8)) AS rmse_train,
 sqrt(avg(pow({E}, 2)) FILTER (WHERE {TRAIN_SQL} >= 8)) AS rmse_test FROM reg, f)
SELECT round(rmse_train, 6) AS rmse_train, round(rmse_test, 6) AS rmse_test, round(rmse_test - rmse_train, 6) AS bias,
 round((rmse_test - rmse_train) / rmse_train * 100, 6) AS bias_pct FROM r""")
def _(t):
    df = reg(t)
    train, _test = train_test(t)
    f = full_fit(train)
    e2 = (F.col("charge") - f.prediction()) * (F.col("charge") - f.prediction())
    inside = ev.bucket(SPLIT, 10) < 8
    row = df.agg(F.sqrt(F.avg(F.when(inside, e2))).alias("rmse_train"), F.sqrt(F.avg(F.when(~inside, e2))).alias("rmse_test"))
    gap = F.col("rmse_test") - F.col("rmse_train")
    return rnd(row.select("*", gap.alias("bias"), (gap / F.col("rmse_train") * 100).alias("bias_pct")))


# ── cross-validation ─────────────────────────────────────────────────────────

def _cv_sql(source, fold):
    return f"""folded AS (SELECT *, {fold} AS fold FROM {source}),
others AS (SELECT k.fold AS heldout, r.* FROM folded r JOIN (SELECT DISTINCT fold FROM folded) k ON k.fold <> r.fold),
{sweep('f', 'others', XS, 'charge', by='heldout')},
per AS (SELECT fold, sqrt(avg(pow({E}, 2))) AS rmse, avg(abs({E})) AS mae, 1 - sum(pow({E}, 2)) / sum(pow(charge - f.m3, 2)) AS r2,
 pow(corr(charge, {P}), 2) AS rsq, count(*) AS n FROM folded JOIN f ON g = fold GROUP BY 1)"""


CV = f"{REG}, {_cv_sql('reg', TRAIN_SQL)}"


@query("kfold_cv", f"WITH {CV} SELECT fold, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 8) AS r2 FROM per")
def _(t):
    return rnd(cv_frame(t).select("fold", "rmse", "mae", "r2"), 6, r2=8)


@query("cv_summary_across", f"""WITH {CV} SELECT round(avg(rmse), 6) AS rmse_mean, round(stddev_samp(rmse), 6) AS rmse_sd, round(avg(mae), 6) AS mae_mean,
 round(stddev_samp(mae), 6) AS mae_sd, round(avg(r2), 6) AS r2_mean, round(stddev_samp(r2), 6) AS r2_sd FROM per""")
def _(t):
    return rnd(fr.summarise_across(cv_frame(t), ["rmse", "mae", "r2"], {"mean": F.avg, "sd": F.stddev_samp}))


@query("kfold_cv_stratified", f"""WITH {REG}, {TRAIN}, {_strata('train')},
{_cv_sql('ranked', 'len(list_filter(range(1, 10), lambda j: rank > floor(size * j / 10.0 + 1e-9)))')}, long AS (SELECT metric, value FROM per UNPIVOT (value FOR metric IN (rmse, mae, rsq)))
SELECT metric, round(avg(value), 6) AS mean, count(*) AS n, round(stddev_samp(value) / sqrt(count(*)), 6) AS std_err FROM long GROUP BY 1""")
def _(t):
    train, _test = train_test(t)
    folded = ev.stratified_folds(train, "charge", SPLIT, [*SPLIT, *REST]).select("charge", *XS, "fold")
    folds = ev.k_fold(folded, F.col("charge"), ols.numeric(*XS), F.col("fold"))
    return rnd(ev.collect_metrics(folds, ["rmse", "mae", "rsq"]))


@query("loocv", f"""WITH {REG}, {sweep('f', 'reg', XS, 'charge')}, e AS (SELECT {E} / (1 - {hat(XS)}) AS e FROM reg, f)
SELECT count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae FROM e""")
def _(t):
    df = reg(t)
    return rnd(ev.leave_one_out(df, full_fit(df)))


# ── comparison, bands, intervals ─────────────────────────────────────────────

def _eval_sql(nm, cte, xs):
    e = f"(charge - {pred(xs, cte)})"
    return f"""SELECT '{nm}' AS model, count(*) AS n, round(avg(abs({e})), 3) AS mae, round(sqrt(avg(pow({e}, 2))), 3) AS rmse,
 round(avg(abs({e} / charge)) * 100, 2) AS mape, round(1 - sum(pow({e}, 2)) / sum(pow(charge - m, 2)), 4) AS r2 FROM test, {cte}, mu"""


_LADDER_SQL = ", ".join(sweep(f"f{i}", "train", xs, "charge") for i, (_, xs) in enumerate(LADDER, 1))


@query("model_compare_test", f"WITH {REG}, {TRAIN}, mu AS (SELECT avg(charge) AS m FROM train), {_LADDER_SQL} "
       + " UNION ALL ".join(_eval_sql(nm, f"f{i}", xs) for i, (nm, xs) in enumerate(LADDER, 1)))
def _(t):
    train, test = train_test(t)
    m, terms, y = moment_state(train, XS)
    fits = {nm: ols.solve(m, terms, y, xs) for nm, xs in LADDER}
    return ev.compare_on_test(test, fits, F.col("charge"), next(iter(fits.values())).ybar).orderBy("rmse")


@query("error_by_band", f"""WITH {SCORED}, q AS (SELECT quantile_cont(charge, [0.25, 0.5, 0.75]) AS b FROM sc)
SELECT CASE WHEN charge <= b[1] THEN 1 WHEN charge <= b[2] THEN 2 WHEN charge <= b[3] THEN 3 ELSE 4 END AS band,
 round(avg(abs(e) / charge * 100), 6) AS mean_error_pct, count(*) AS n FROM sc, q GROUP BY 1""")
def _(t):
    df = scored(t)[0]
    band = band_by_edges(F.col("charge"), quantile_edges(df, "charge"), [1, 2, 3, 4])
    pct = F.try_divide(F.abs(F.col("charge") - F.col("pred")), F.col("charge")) * 100
    return rnd(df.groupBy(band.alias("band")).agg(F.avg(pct).alias("mean_error_pct"), F.count("*").alias("n")))


PI = f"{SCORED}, pi AS (SELECT sc.*, pred - {half_sql(1)} AS pi_low, pred + {half_sql(1)} AS pi_high FROM sc, f)"


def with_interval(t):
    train, test = train_test(t)
    out = full_fit(train).predict_interval(test, "prediction", names=("pred", "pi_low", "pi_high"))
    return out.withColumn("in_interval", F.col("charge").between(F.col("pi_low"), F.col("pi_high")))


@query("pi_coverage", f"WITH {PI} SELECT round(avg((charge BETWEEN pi_low AND pi_high)::INT) * 100, 6) AS coverage_pct, round(avg(pi_high - pi_low), 6) AS mean_width FROM pi")
def _(t):
    return rnd(with_interval(t).agg((F.avg(F.col("in_interval").cast("double")) * 100).alias("coverage_pct"),
                                    F.avg(F.col("pi_high") - F.col("pi_low")).alias("mean_width")))


@query("pi_sample", f"""WITH {PI}, s AS (SELECT * FROM pi ORDER BY {key_hash(SPLIT)}, {_KEYS} LIMIT 30)
SELECT row_number() OVER (ORDER BY pred, {_KEYS}) AS obs, round(charge, 6) AS charge, round(pred, 6) AS pred, round(pi_low, 6) AS pi_low,
 round(pi_high, 6) AS pi_high, charge BETWEEN pi_low AND pi_high AS in_interval FROM s""")
def _(t):
    picked = fr.sample_n(with_interval(t), 30, ev.key_hash(SPLIT), [*SPLIT, *REST])
    return rnd(row_numbers(picked, ["pred", *SPLIT, *REST]).select("obs", "charge", "pred", "pi_low", "pi_high", "in_interval"))


# ── learning curve and report ────────────────────────────────────────────────

REPS, PARTS, HOLD = 5, 20, 4
_LC_BUCKET = bucket(SPLIT, PARTS, "r.rep")


@query("learning_curve", f"""WITH {REG}, rb AS (SELECT r.rep, {_LC_BUCKET} AS b, charge, price, disc, tax FROM reg, range({REPS}) r(rep)),
sized AS (SELECT rep * 100 + k AS g0, rb.* FROM rb JOIN range({PARTS - HOLD}) z(k) ON b <= k), {sweep('f', 'sized', XS, 'charge', by='g0')},
tr AS (SELECT g, sqrt(avg(pow({E}, 2))) AS train_rmse, count(*) AS n_train FROM sized JOIN f ON g = g0 GROUP BY 1),
va AS (SELECT g, sqrt(avg(pow({E}, 2))) AS val_rmse FROM rb JOIN f ON g // 100 = rep WHERE b >= {PARTS - HOLD} GROUP BY 1)
SELECT round((g % 100 + 1) / {PARTS}.0::DOUBLE, 6) AS fraction, round(avg(n_train), 4) AS n_train, round(avg(train_rmse), 6) AS train_rmse, round(avg(val_rmse), 6) AS val_rmse
FROM tr JOIN va USING (g) GROUP BY 1""")
def _(t):
    lc = ev.learning_curve(t.spark, reg(t), F.col("charge"), ols.numeric(*XS), SPLIT, PARTS, HOLD, REPS)
    return rnd(lc.groupBy("fraction").agg(F.avg("n_train").alias("n_train"), F.avg("train_rmse").alias("train_rmse"),
                                          F.avg("val_rmse").alias("val_rmse")), 6, n_train=4)


_WORST = f"(SELECT * FROM sc ORDER BY abs(e) DESC, {_KEYS} LIMIT 10)"


@query("worst_errors", f"""WITH {SCORED} SELECT l_orderkey, l_linenumber, round(charge, 6) AS charge, round(pred, 6) AS pred, round(abs(e), 6) AS abs_error,
 round(abs(e) / charge * 100, 4) AS pct_error FROM {_WORST}""")
def _(t):
    return worst(scored(t)[0])


def worst(df):
    e = F.abs(F.col("charge") - F.col("pred"))
    return rnd(df.withColumn("abs_error", e).withColumn("pct_error", F.try_divide(e, F.col("charge")) * 100).orderBy(
        F.desc("abs_error"), *SPLIT, *REST).limit(10).select(
        "l_orderkey", "l_linenumber", "charge", "pred", "abs_error", "pct_error"), 6, pct_error=4)


@query("eval_report", f"""WITH {SCORED}
SELECT 'size' AS section, 'train' AS item, count(*)::DOUBLE AS value FROM train UNION ALL SELECT 'size', 'test', count(*)::DOUBLE FROM test
UNION ALL SELECT 'model', 'r_squared', round(1 - rss / tss, 6) FROM f UNION ALL SELECT 'model', 'adj_r_squared', round(1 - (rss / tss) * (n - 1) / (n - 4), 6) FROM f
UNION ALL SELECT 'model', 'sigma', round(sqrt(rss / (n - 4)), 6) FROM f UNION ALL SELECT 'model', 'aic', round(n * (ln(2 * pi() * rss / n) + 1) + 10, 2) FROM f
UNION ALL SELECT 'test', 'mae', round(avg(abs(e)), 6) FROM sc UNION ALL SELECT 'test', 'rmse', round(sqrt(avg(e * e)), 6) FROM sc
UNION ALL SELECT 'test', 'mape', round(avg(abs(e / charge)) * 100, 6) FROM sc
UNION ALL SELECT 'test', 'r2', round(1 - sum(e * e) / sum(pow(charge - m, 2)), 6) FROM sc, mu
UNION ALL SELECT 'coefficient', term, estimate FROM ({tidy_sql(XS)}) UNION ALL SELECT 'significant', term, (p_value < 0.05)::INT::DOUBLE FROM ({tidy_sql(XS)})
UNION ALL SELECT section, term, value FROM ({tidy_sql(XS)}) UNPIVOT (value FOR section IN (std_error, conf_low, conf_high, p_value)) UNION ALL SELECT 'size', 'predictors', 3
UNION ALL SELECT section, i::VARCHAR, round(value, 6) FROM (SELECT row_number() OVER (ORDER BY abs(e) DESC, {_KEYS}) AS i, abs(e) AS worst,
 charge AS worst_actual, pred AS worst_predicted, e AS worst_residual FROM {_WORST}) UNPIVOT (value FOR section IN (worst, worst_actual, worst_predicted, worst_residual))""")
def _(t):
    train, test = train_test(t)
    f = full_fit(train)
    g, df = f.glance_row(), f.predict(test, "pred")
    m = ev.metric_columns(F.col("charge"), F.col("pred"), f.ybar)
    got = df.agg(*[m[k].alias(k) for k in ("n", "mae", "rmse", "mape", "r2_vs_train_mean")]).first()
    rows = [("size", "train", float(f.n)), ("size", "test", float(got["n"])), ("size", "predictors", float(f.p))]
    rows += [("model", k, g[k]) for k in ("r_squared", "adj_r_squared", "sigma")]
    rows += [("test", k, got[k]) for k in ("mae", "rmse", "mape")] + [("test", "r2", got["r2_vs_train_mean"])]
    for r in f.tidy_rows():
        rows += [("coefficient", r[0], r[1]), ("significant", r[0], 1.0 if r[4] < 0.05 else 0.0), ("std_error", r[0], r[2]),
                 ("p_value", r[0], r[4]), ("conf_low", r[0], r[5]), ("conf_high", r[0], r[6])]
    for i, r in enumerate(worst(df).collect(), 1):
        rows += [("worst", str(i), r["abs_error"]), ("worst_actual", str(i), r["charge"]), ("worst_predicted", str(i), r["pred"]),
                 ("worst_residual", str(i), math.copysign(r["abs_error"], r["charge"] - r["pred"]))]
    schema = "section string, item string, value double"
    out = rnd(t.spark.createDataFrame(rows, schema))
    return out.unionByName(rnd(t.spark.createDataFrame([("model", "aic", g["aic"])], schema), 2))
