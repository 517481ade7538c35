"""Linear models: fits, inference, diagnostics, comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.catalog.registry import LINE_KEY, REG, TRAIN_SQL, query, reg, rnd, rnd_rows
from tallyframe.catalog.sqlkit import chi2_tail_3, f_tail, hat, intercept_var, pred, sweep, t_crit, t_tail
from tallyframe.operators.chartdata import column_range
from tallyframe.plans import evaluate as ev
from tallyframe.plans import ols
from tallyframe.plans.moments import moments
from tallyframe.sources.tables import grid_frame

XS = ["price", "disc", "tax"]
SPLIT = ["l_orderkey", "l_linenumber"]
REST = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
FULL = sweep("f", "reg", XS, "charge")


def full_fit(df: DataFrame) -> ols.Fit:
    return ols.fit(df, "charge", ols.numeric(*XS))


def moment_state(df: DataFrame, names):
    """Moments of several candidate columns, for fits that differ in terms only."""
    terms = ols.numeric(*names)
    y = F.col("charge")
    return moments(df, {**terms, ols.Y: y}), terms, y


def cv_frame(t):
    return ev.k_fold(reg(t), F.col("charge"), ols.numeric(*XS), ev.bucket(SPLIT, 10))


def train_test(t):
    return ev.split(reg(t), SPLIT)


# ── fits ─────────────────────────────────────────────────────────────────────


@query("ols_simple", f"WITH {REG} SELECT l_returnflag, round(regr_slope(charge, price), 8) AS slope, round(regr_intercept(charge, price), 6) AS intercept, round(regr_r2(charge, price), 8) AS r2 FROM reg GROUP BY 1")
def _(t):
    y, x = F.col("charge"), F.col("price")
    return rnd(reg(t).groupBy("l_returnflag").agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")),
        8, intercept=6)


def coef_frame(t, f: ols.Fit, digits=6):
    return rnd(t.spark.createDataFrame(list(f.coef.items()), "term string, estimate double"), digits)


def coef_sql(names, f="f"):
    rows = [f"SELECT '(Intercept)' AS term, round(a, 6) AS estimate FROM {f}"]
    rows += [f"SELECT '{nm}', round(b{i}, 6) FROM {f}" for i, nm in enumerate(names)]
    return " UNION ALL ".join(rows)


@query("ols_multi", f"WITH {REG}, {FULL} {coef_sql(XS)}")
def _(t):
    return coef_frame(t, full_fit(reg(t)))


FLAGS = ["(l_returnflag = 'N')::INT", "(l_returnflag = 'R')::INT"]


@query("ols_factor", f"WITH {REG}, {sweep('f', 'reg', ['price', *FLAGS], 'charge')} {coef_sql(['price', 'l_returnflagN', 'l_returnflagR'])}")
def _(t):
    terms = {**ols.numeric("price"), **ols.factor("l_returnflag", ["A", "N", "R"])}
    return coef_frame(t, ols.fit(reg(t), "charge", terms))


@query("ols_interaction", f"WITH {REG}, {sweep('f', 'reg', ['price', 'disc', 'price * disc'], 'charge')} {coef_sql(['price', 'disc', 'price:disc'])}")
def _(t):
    return coef_frame(t, ols.fit(reg(t), "charge", ols.crossed(ols.numeric("price"), ols.numeric("disc"))))


@query("ols_interaction_factor", f"WITH {REG}, {sweep('f', 'reg', ['price', *FLAGS, *[f'price * {x}' for x in FLAGS]], 'charge')} {coef_sql(['price', 'l_returnflagN', 'l_returnflagR', 'price:l_returnflagN', 'price:l_returnflagR'])}")
def _(t):
    terms = ols.crossed(ols.numeric("price"), ols.factor("l_returnflag", ["A", "N", "R"]))
    return coef_frame(t, ols.fit(reg(t), "charge", terms))


@query("ols_poly", f"""WITH {REG}, {sweep('f', 'reg', ['price', 'price * price'], 'charge')}
SELECT 'Linear' AS model, round(regr_r2(charge, price), 8) AS r_squared FROM reg UNION ALL SELECT 'Quadratic', round(1 - rss / tss, 8) FROM f""")
def _(t):
    df = reg(t)
    basis = ols.polynomial("price", ols.polynomial_state(df, "price", 2))
    y = F.col("charge")
    m = moments(df, {**basis, ols.Y: y})
    rows = [("Linear", ols.solve(m, basis, y, ["price_1"]).r2), ("Quadratic", ols.solve(m, basis, y).r2)]
    return rnd(t.spark.createDataFrame(rows, "model string, r_squared double"), 8)


@query("ols_transformed", f"""WITH {REG}, {sweep('f', 'reg', ['ln(price)', 'disc', 'tax'], 'ln(charge)')}
SELECT l_orderkey, l_linenumber, l_partkey, round(exp({pred(['ln(price)', 'disc', 'tax'])}), 5) AS fitted FROM reg, f""")
def _(t):
    df = reg(t)
    terms = {"log(price)": F.ln("price"), **ols.numeric("disc", "tax")}
    f = ols.fit(df, F.ln("charge"), terms)
    return rnd_rows(df.select("l_orderkey", "l_linenumber", "l_partkey", F.exp(f.prediction()).alias("fitted")))


# ── tables of a fit ──────────────────────────────────────────────────────────


def tidy_sql(names, f="f"):
    p = len(names)
    df, s2 = f"(n - {p + 1})", f"(rss / (n - {p + 1}))"
    rows = []
    for nm, b, v in [("(Intercept)", "a", intercept_var(p)), *[(nm, f"b{i}", f"c{i}{i}") for i, nm in enumerate(names)]]:
        se = f"sqrt({s2} * {v})"
        rows.append(f"""SELECT '{nm}' AS term, round({b}, 6) AS estimate, round({se}, 6) AS std_error, round({b} / {se}, 4) AS statistic,
 {t_tail(f'({b} / {se})', df)} AS p_value, round({b} - {t_crit(df)} * {se}, 6) AS conf_low, round({b} + {t_crit(df)} * {se}, 6) AS conf_high FROM {f}""")
    return " UNION ALL ".join(rows)


QTY = ["qty", "disc"]


@query("ols_tidy", f"""WITH {REG}, {sweep('f', 'reg', QTY, 'price')}, tidy AS ({tidy_sql(QTY)})
SELECT *, CASE WHEN p_value < 0.001 THEN '***' WHEN p_value < 0.01 THEN '**' WHEN p_value < 0.05 THEN '*' WHEN p_value < 0.1 THEN '.' ELSE '' END AS stars FROM tidy""")
def _(t):
    f = ols.fit(reg(t), "price", ols.numeric(*QTY))
    return rnd(f.tidy(t.spark).withColumn("stars", ols.stars(F.col("p_value"))), 6, statistic=4)


def glance_sql(p, f="f"):
    return f"""round(1 - rss / tss, 8) AS r_squared, round(1 - (rss / tss) * (n - 1) / (n - {p + 1}), 8) AS adj_r_squared,
 round(sqrt(rss / (n - {p + 1})), 6) AS sigma, round(((tss - rss) / {p}) / (rss / (n - {p + 1})), 0) AS statistic,
 {f_tail(f'(((tss - rss) / {p}) / (rss / (n - {p + 1})))', str(p), f'(n - {p + 1})')} AS p_value, {p}::INT AS df,
 round(n * (ln(2 * pi() * rss / n) + 1) + 2 * ({p} + 2), 2) AS aic, round(n * (ln(2 * pi() * rss / n) + 1) + ln(n) * ({p} + 2), 2) AS bic,
 (n - {p + 1})::BIGINT AS df_residual, n::BIGINT AS nobs"""


def glance_rnd(df):
    return rnd(df, 8, sigma=6, statistic=0, p_value=6, aic=2, bic=2)


@query("ols_glance", f"WITH {REG}, {FULL} SELECT {glance_sql(3)} FROM f")
def _(t):
    return glance_rnd(full_fit(reg(t)).glance(t.spark))


@query("ols_summary", f"""WITH {REG}, {FULL}, e AS (SELECT charge - {pred(XS)} AS r FROM reg, f)
SELECT 'residual' AS section, unnest(['min', 'q1', 'median', 'q3', 'max']) AS item, round(unnest(quantile_cont(r, [0, 0.25, 0.5, 0.75, 1])), 6) AS value FROM e
UNION ALL SELECT 'estimate', term, estimate FROM ({tidy_sql(XS)}) UNION ALL SELECT 'std_error', term, std_error FROM ({tidy_sql(XS)})
UNION ALL SELECT 'statistic', term, statistic FROM ({tidy_sql(XS)}) UNION ALL SELECT 'p_value', term, p_value FROM ({tidy_sql(XS)})
UNION ALL SELECT 'model', 'rse', sigma FROM (SELECT {glance_sql(3)} FROM f) UNION ALL SELECT 'model', 'r_squared', r_squared FROM (SELECT {glance_sql(3)} FROM f)
UNION ALL SELECT 'model', 'adj_r_squared', adj_r_squared FROM (SELECT {glance_sql(3)} FROM f) UNION ALL SELECT 'model', 'f', statistic FROM (SELECT {glance_sql(3)} FROM f)
UNION ALL SELECT 'model', 'p_value', p_value FROM (SELECT {glance_sql(3)} FROM f)""")
def _(t):
    df = reg(t)
    f = full_fit(df)
    digits = {"residual": 6, "estimate": 6, "std_error": 6, "statistic": 4, "p_value": 6}
    rows = [("residual", nm, v, 6) for nm, v in zip(("min", "q1", "median", "q3", "max"), ols.residual_summary(df, f))]
    for part, i in (("estimate", 1), ("std_error", 2), ("statistic", 3), ("p_value", 4)):
        rows += [(part, r[0], r[i], digits[part]) for r in f.tidy_rows()]
    g = f.glance_row()
    rows += [("model", nm, g[k], dg) for nm, k, dg in (
        ("rse", "sigma", 6), ("r_squared", "r_squared", 8), ("adj_r_squared", "adj_r_squared", 8),
        ("f", "statistic", 0), ("p_value", "p_value", 6))]
    out = t.spark.createDataFrame(rows, "section string, item string, value double, dg int")
    m = F.pow(F.lit(10.0), F.col("dg"))
    return out.select("section", "item", (F.signum("value") * F.floor(F.abs("value") * m + 0.5) / m).alias("value"))


@query("ols_parts", f"""WITH {REG}, {FULL} SELECT l_orderkey, l_linenumber, l_partkey, round({pred(XS)}, 5) AS fitted, round(charge - {pred(XS)}, 5) + 0.0 AS residual,
 round(sqrt(f.rss / (f.n - 4)), 5) AS sigma FROM reg, f""")
def _(t):
    df = reg(t)
    f = full_fit(df)
    return rnd_rows(df.select("l_orderkey", "l_linenumber", "l_partkey", f.prediction().alias("fitted"),
                         (f.y - f.prediction()).alias("residual"), F.lit(f.sigma).alias("sigma")))


def compare_sql(parts):
    return " UNION ALL ".join(f"SELECT '{nm}' AS model, {glance_sql(p)} FROM {cte}" for nm, cte, p in parts)


NESTED = ",\n".join([sweep("f1", "reg", XS[:1], "charge"), sweep("f2", "reg", XS[:2], "charge"), sweep("f3", "reg", XS, "charge")])
LADDER = [("price", XS[:1]), ("price + disc", XS[:2]), ("price + disc + tax", XS)]


def ladder_fits(t):
    m, terms, y = moment_state(reg(t), XS)
    return {nm: ols.solve(m, terms, y, xs) for nm, xs in LADDER}


@query("model_compare_glance", f"WITH {REG}, {NESTED} SELECT model, r_squared, adj_r_squared, sigma, aic, bic FROM ({compare_sql([(nm, f'f{i}', i) for i, (nm, _) in enumerate(LADDER, 1)])})")
def _(t):
    rows = [(nm, g["r_squared"], g["adj_r_squared"], g["sigma"], g["aic"], g["bic"])
            for nm, g in ((nm, f.glance_row()) for nm, f in ladder_fits(t).items())]
    out = t.spark.createDataFrame(rows, "model string, r_squared double, adj_r_squared double, sigma double, aic double, bic double")
    return glance_rnd(out.orderBy("aic"))


@query("anova_nested", f"""WITH {REG}, {NESTED} SELECT 'price → price + disc' AS step, 1::INT AS df, round(f1.rss - f2.rss, 2) AS sum_sq,
 round((f1.rss - f2.rss) / (f2.rss / (f2.n - 3)), 2) AS statistic, {f_tail('((f1.rss - f2.rss) / (f2.rss / (f2.n - 3)))', '1', '(f2.n - 3)')} AS p_value FROM f1, f2
UNION ALL SELECT 'price + disc → price + disc + tax', 1::INT, round(f2.rss - f3.rss, 2), round((f2.rss - f3.rss) / (f3.rss / (f3.n - 4)), 2),
 {f_tail('((f2.rss - f3.rss) / (f3.rss / (f3.n - 4)))', '1', '(f3.n - 4)')} FROM f2, f3""")
def _(t):
    fits = list(ladder_fits(t).items())
    rows = []
    for (a, small), (b, big) in zip(fits, fits[1:]):
        r = ols.anova_nested(small, big)
        rows.append((f"{a} → {b}", r["df"], r["sum_sq"], r["statistic"], r["p_value"]))
    return rnd(t.spark.createDataFrame(rows, "step string, df int, sum_sq double, statistic double, p_value double"), 2, p_value=6)


STEP_XS = ["price", "qty", "disc", "tax"]
_STEP = ",\n".join(
    sweep(f"s{mask}", "reg", [x for i, x in enumerate(STEP_XS) if mask >> i & 1], "charge") for mask in range(1, 16))
# Backward, forward and two-way search all end at the best subset on this data,
# which the SQL finds by enumeration.
_STEP_ALL = " UNION ALL ".join(
    f"SELECT '{' + '.join(x for i, x in enumerate(STEP_XS) if mask >> i & 1)}' AS terms, "
    f"n * ln(rss / n) + 2 * {bin(mask).count('1') + 1} AS score FROM s{mask}" for mask in range(1, 16))


@query("stepwise_aic", f"""WITH {REG}, {_STEP}, a AS ({_STEP_ALL}), best AS (SELECT terms, round(score, 4) AS score FROM a ORDER BY a.score LIMIT 1)
SELECT d AS direction, terms, score FROM best, (VALUES ('backward'), ('forward'), ('both')) v(d)""")
def _(t):
    m, terms, y = moment_state(reg(t), STEP_XS)
    rows = []
    for direction in ("backward", "forward", "both"):
        f, trace = ols.stepwise(m, terms, y, direction)
        rows.append((direction, " + ".join(x for x in STEP_XS if x in f.kept), trace[-1][1]))
    return rnd(t.spark.createDataFrame(rows, "direction string, terms string, score double"), 4)


# One more column for the error variance; the search scores leave the constant out.
_AIC = "score + n * (ln(2 * pi()) + 1) + 2"


@query("aic_table", f"WITH {REG}, {NESTED}, {_STEP}, a AS ({_STEP_ALL}), best AS (SELECT * FROM a ORDER BY score LIMIT 1) " + " UNION ALL ".join(
    f"SELECT '{nm}' AS model, {i + 2}::INT AS df, round(n * (ln(2 * pi() * rss / n) + 1) + 2 * ({i} + 2), 2) AS aic FROM f{i}"
    for i, (nm, _) in enumerate(LADDER, 1)) + f"""
UNION ALL SELECT 'null', 2, round(n * (ln(2 * pi() * tss / n) + 1) + 4, 2) FROM f1
UNION ALL SELECT 'full', 6, round(n * (ln(2 * pi() * rss / n) + 1) + 12, 2) FROM s15
UNION ALL SELECT d, (len(string_split(terms, ' + ')) + 2)::INT, round({_AIC}, 2) FROM best, (SELECT n FROM s15), (VALUES ('backward'), ('forward'), ('both')) v(d)""")
def _(t):
    rows = [(nm, f.p + 2, f.aic) for nm, f in ladder_fits(t).items()]
    m, terms, y = moment_state(reg(t), STEP_XS)
    rows += [("null", 2, ols.solve(m, terms, y, names=[]).aic), ("full", len(STEP_XS) + 2, ols.solve(m, terms, y).aic)]
    for direction in ("backward", "forward", "both"):
        f, _trace = ols.stepwise(m, terms, y, direction)
        rows.append((direction, f.p + 2, f.aic))
    return rnd(t.spark.createDataFrame(rows, "model string, df int, aic double"), 2)


@query("coef_plot_data", f"WITH {REG}, {FULL} SELECT term, estimate, conf_low, conf_high FROM ({tidy_sql(XS)}) WHERE term <> '(Intercept)'")
def _(t):
    return rnd(full_fit(reg(t)).tidy(t.spark).where("term <> '(Intercept)'").select(
        "term", "estimate", "conf_low", "conf_high").orderBy("estimate"))


# ── prediction ───────────────────────────────────────────────────────────────

TRAIN = f"train AS (SELECT * FROM reg WHERE {TRAIN_SQL} < 8), test AS (SELECT * FROM reg WHERE {TRAIN_SQL} >= 8)"
TRAINED = f"{REG}, {TRAIN}, {sweep('f', 'train', XS, 'charge')}"


@query("predict", f"WITH {TRAINED} SELECT l_orderkey, l_linenumber, l_partkey, round({pred(XS)}, 5) AS fit FROM test, f")
def _(t):
    train, test = train_test(t)
    return rnd_rows(full_fit(train).predict(test).select("l_orderkey", "l_linenumber", "l_partkey", "fit"))


def half_sql(extra, xs=XS, p=3):
    return f"({t_crit(f'(f.n - {p + 1})')} * sqrt(f.rss / (f.n - {p + 1})) * sqrt({extra} + {hat(xs)}))"


@query("predict_interval", f"""WITH {TRAINED} SELECT l_orderkey, l_linenumber, l_partkey, round({pred(XS)}, 5) AS fit,
 round({pred(XS)} - {half_sql(0)}, 5) AS ci_lwr, round({pred(XS)} + {half_sql(0)}, 5) AS ci_upr,
 round({pred(XS)} - {half_sql(1)}, 5) AS pi_lwr, round({pred(XS)} + {half_sql(1)}, 5) AS pi_upr FROM test, f""")
def _(t):
    train, test = train_test(t)
    f = full_fit(train)
    out = f.predict_interval(test, "confidence", names=("fit", "ci_lwr", "ci_upr"))
    out = f.predict_interval(out, "prediction", names=("fit", "pi_lwr", "pi_upr"))
    return rnd_rows(out.select("l_orderkey", "l_linenumber", "l_partkey", "fit", "ci_lwr", "ci_upr", "pi_lwr", "pi_upr"))


@query("interval_grid", f"""WITH {REG}, {FULL}, grid AS (SELECT i AS step, lo + i * (hi - lo) / 80 AS price, 5.0::DOUBLE AS disc, 4.0::DOUBLE AS tax
 FROM range(81) g(i), (SELECT min(price) AS lo, max(price) AS hi FROM reg))
SELECT step, round(price, 6) AS price, round({pred(XS)}, 6) AS fit, round({pred(XS)} - {half_sql(0)}, 6) AS ci_lwr, round({pred(XS)} + {half_sql(0)}, 6) AS ci_upr,
 round({pred(XS)} - {half_sql(1)}, 6) AS pi_lwr, round({pred(XS)} + {half_sql(1)}, 6) AS pi_upr FROM grid, f""")
def _(t):
    df = reg(t)
    f = full_fit(df)
    lo, hi = column_range(df, "price")
    grid = grid_frame(t.spark, "step", 0, 80, 1).select(
        F.col("step").cast("long").alias("step"), (lo + F.col("step") * (hi - lo) / 80).alias("price"),
        F.lit(5.0).alias("disc"), F.lit(4.0).alias("tax"))
    out = f.predict_interval(grid, "confidence", names=("fit", "ci_lwr", "ci_upr"))
    return rnd(f.predict_interval(out, "prediction", names=("fit", "pi_lwr", "pi_upr")).drop("disc", "tax"))


# ── diagnostics ──────────────────────────────────────────────────────────────

_E = f"(charge - {pred(XS)})"
AUG = f"""{REG}, {FULL}, aug AS (SELECT reg.*, {pred(XS)} AS fitted, {_E} AS resid, {hat(XS)} AS hat,
 {_E} / (sqrt(f.rss / (f.n - 4)) * sqrt(1 - {hat(XS)})) AS std_resid,
 pow({_E}, 2) * {hat(XS)} / (4 * (f.rss / (f.n - 4)) * pow(1 - {hat(XS)}, 2)) AS cooksd, f.n AS n, f.rss AS rss FROM reg, f)"""


@query("augment", f"""WITH {AUG} SELECT l_orderkey, l_linenumber, l_partkey, round(fitted, 5) AS fitted, round(resid, 5) + 0.0 AS resid, round(hat, 7) AS hat,
 round(std_resid, 4) + 0.0 AS std_resid, round(cooksd, 7) AS cooksd FROM aug""")
def _(t):
    df = reg(t)
    out = full_fit(df).augment(df)
    return rnd(out.select("l_orderkey", "l_linenumber", "l_partkey", "fitted", "resid", "hat", "std_resid", "cooksd"), 5, std_resid=4, hat=7, cooksd=7)


@query("influence_flags", f"""WITH {AUG} SELECT l_orderkey, l_linenumber, l_partkey, round(hat, 7) AS hat, round(cooksd, 7) AS cooksd,
 hat > 8.0 / n AS high_leverage, cooksd > 4.0 / n AS influential FROM aug WHERE hat > 8.0 / n OR cooksd > 4.0 / n""")
def _(t):
    df = reg(t)
    f = full_fit(df)
    high, infl = F.col("hat") > 2.0 * (f.p + 1) / f.n, F.col("cooksd") > 4.0 / f.n
    out = f.augment(df).withColumns({"high_leverage": high, "influential": infl}).where("high_leverage OR influential")
    return rnd(out.select("l_orderkey", "l_linenumber", "l_partkey", "hat", "cooksd", "high_leverage", "influential")
               .orderBy(F.desc("cooksd")), 7)


@query("outlier_test", f"""WITH {AUG}, r AS (SELECT *, resid / sqrt((rss - resid * resid / (1 - hat)) / (n - 5) * (1 - hat)) AS rs FROM aug),
 top AS (SELECT * FROM r ORDER BY abs(rs) DESC LIMIT 1)
SELECT l_orderkey, l_linenumber, l_partkey, round(rs, 6) AS rstudent, {t_tail('rs', '(n - 5)')} AS p_value,
 round(least(1.0, n * {t_tail('rs', '(n - 5)')}), 0) AS bonferroni_p FROM top""")
def _(t):
    df = reg(t)
    top = ols.outlier_test(df, full_fit(df), LINE_KEY)[0]
    row = (top["l_orderkey"], top["l_linenumber"], top["l_partkey"], top["rstudent"], top["p_value"], top["bonferroni_p"])
    return rnd(t.spark.createDataFrame(
        [row], "l_orderkey long, l_linenumber int, l_partkey long, rstudent double, p_value double, bonferroni_p double"),
        6, bonferroni_p=0)


@query("coef_shift", f"""WITH {AUG}, top AS (SELECT l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4 FROM aug ORDER BY cooksd DESC LIMIT 1),
 rest AS (SELECT reg.* FROM reg, top WHERE NOT (l_orderkey = k1 AND l_linenumber = k2 AND l_partkey = k3 AND l_suppkey = k4)),
 {sweep('g', 'rest', XS, 'charge')}
SELECT '(Intercept)' AS term, round(f.a - g.a, 8) AS shift FROM f, g """ + "".join(
    f" UNION ALL SELECT '{x}', round(f.b{i} - g.b{i}, 8) FROM f, g" for i, x in enumerate(XS)))
def _(t):
    df = reg(t)
    shift = ols.coefficient_shift(df, full_fit(df), LINE_KEY)
    return rnd(t.spark.createDataFrame(list(shift.items()), "term string, shift double"), 8)


@query("durbin_watson", f"""WITH {AUG}, o AS (SELECT resid, lag(resid) OVER (ORDER BY {', '.join(LINE_KEY)}) AS before FROM aug)
SELECT round(sum(pow(resid - before, 2)) / sum(resid * resid), 6) AS statistic FROM o""")
def _(t):
    df = reg(t)
    dw = ols.durbin_watson(df, full_fit(df), LINE_KEY)
    return rnd(t.spark.createDataFrame([(dw,)], "statistic double"))


@query("lag_residual_diff", f"""WITH {AUG}, o AS (SELECT l_suppkey, resid, lag(resid) OVER (PARTITION BY l_suppkey ORDER BY {', '.join(k for k in LINE_KEY if k != 'l_suppkey')}) AS before FROM aug)
SELECT round(sum(pow(resid - before, 2)), 3) AS sum_sq, count(before) AS pairs FROM o""")
def _(t):
    from tallyframe.operators.ordering import adjacent_sums
    df = reg(t)
    f = full_fit(df)
    s = adjacent_sums(df, f.y - f.prediction(), [k for k in LINE_KEY if k != "l_suppkey"], by=["l_suppkey"])
    return rnd(t.spark.createDataFrame([(s["sq"], s["pairs"])], "sum_sq double, pairs long"), 3)


@query("breusch_pagan", f"""WITH {AUG}, e2 AS (SELECT *, resid * resid AS e2 FROM aug), {sweep('h', 'e2', XS, 'e2')}
SELECT round(n * (1 - rss / tss), 4) AS statistic, 3::INT AS df, {chi2_tail_3('(n * (1 - rss / tss))')} AS p_value FROM h""")
def _(t):
    df = reg(t)
    bp = ols.breusch_pagan(df, full_fit(df))
    return rnd(t.spark.createDataFrame([(bp["statistic"], bp["df"], bp["p_value"])], "statistic double, df int, p_value double"), 4, p_value=6)


@query("scale_location", f"WITH {AUG} SELECT round(fitted, 5) AS fitted, round(sqrt(abs(std_resid)), 5) AS root_std_resid FROM aug")
def _(t):
    df = reg(t)
    return rnd_rows(full_fit(df).augment(df).select("fitted", F.sqrt(F.abs("std_resid")).alias("root_std_resid")))


@query("vif", f"WITH {REG}, reg2 AS (SELECT *, price + disc AS mix FROM reg), " + ", ".join(
    sweep(f"v{i}", "reg2", [x for x in ("price", "qty", "mix") if x != nm], nm) for i, nm in enumerate(("price", "qty", "mix")))
    + " " + " UNION ALL ".join(f"SELECT '{nm}' AS term, round(tss / rss, 4) AS vif FROM v{i}" for i, nm in enumerate(("price", "qty", "mix"))))
def _(t):
    df = reg(t).withColumn("mix", F.col("price") + F.col("disc"))
    names = ["price", "qty", "mix"]
    v = ols.variance_inflation(moments(df, ols.numeric(*names)), names)
    return rnd(t.spark.createDataFrame(list(v.items()), "term string, vif double"), 4)
