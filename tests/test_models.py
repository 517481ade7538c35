"""Regression, moments and evaluation against independent computations."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tallyframe.functions import dist
from tallyframe.operators import associate as assoc
from tallyframe.plans import evaluate as ev
from tallyframe.plans import moments as mm
from tallyframe.plans import ols


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    n = 1500
    a, b = rng.normal(50, 3, n), rng.exponential(2, n)
    c = a * 0.5 + rng.normal(0, 1, n)
    y = 3 + 2 * a - 1.5 * b + 0.3 * c + rng.normal(0, 2, n)
    g = rng.integers(0, 3, n)
    rows = [(i, float(a[i]), float(b[i]), float(c[i]), float(y[i]), "uvw"[g[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, g string").cache()
    return df, np.column_stack([a, b, c]), y


TERMS = ["a", "b", "c"]


def test_fit_equals_ml_solver(frame):
    df, _x, _y = frame
    f = ols.fit(df, "y", ols.numeric(*TERMS))
    va = VectorAssembler(inputCols=TERMS, outputCol="x").transform(df)
    m = LinearRegression(featuresCol="x", labelCol="y", solver="normal").fit(va)
    s = m.summary
    assert np.allclose(f.b, m.coefficients.toArray(), rtol=1e-8)
    assert f.intercept == pytest.approx(m.intercept, rel=1e-8)
    se = list(f.std_error.values())
    assert np.allclose(se[1:] + se[:1], s.coefficientStandardErrors, rtol=1e-8)
    assert f.r2 == pytest.approx(s.r2, rel=1e-10)
    p = [r[4] for r in f.tidy_rows()]
    assert np.allclose(p[1:] + p[:1], s.pValues, atol=1e-10)


def test_leverage_cook_and_leave_one_out(frame):
    df, x, y = frame
    f = ols.fit(df, "y", ols.numeric(*TERMS))
    x1 = np.column_stack([np.ones(len(y)), x])
    h = np.einsum("ij,jk,ik->i", x1, np.linalg.inv(x1.T @ x1), x1)
    e = y - x1 @ np.linalg.lstsq(x1, y, rcond=None)[0]
    rows = sorted(f.augment(df).collect(), key=lambda r: r["id"])
    assert np.allclose([r["hat"] for r in rows], h, rtol=1e-8)
    s2 = (e @ e) / (len(y) - 4)
    assert np.allclose([r["cooksd"] for r in rows], e**2 * h / (4 * s2 * (1 - h) ** 2), rtol=1e-7)
    assert ev.leave_one_out(df, f).first()["rmse"] == pytest.approx(math.sqrt(np.mean((e / (1 - h)) ** 2)))
    shift = ols.coefficient_shift(df, f, ["id"])
    top = int(np.argmax(e**2 * h / (1 - h) ** 2))
    less = np.linalg.lstsq(np.delete(x1, top, 0), np.delete(y, top), rcond=None)[0]
    assert np.allclose(list(shift.values()), np.array(list(f.coef.values())) - less, atol=1e-8)


def test_prediction_interval_is_wider_and_covers(frame):
    df, _x, _y = frame
    f = ols.fit(df, "y", ols.numeric(*TERMS))
    out = f.predict_interval(f.predict_interval(df, "confidence"), "prediction", names=("fit", "pl", "pu"))
    row = out.agg(F.min((F.col("pu") - F.col("pl")) - (F.col("upr") - F.col("lwr"))),
                  F.avg(F.col("y").between(F.col("pl"), F.col("pu")).cast("double"))).first()
    assert row[0] > 0 and 0.93 < row[1] < 0.97


def test_block_and_sum_moments_agree(frame, monkeypatch):
    df, _x, _y = frame
    terms = ols.numeric(*TERMS, "y")
    by = F.pmod(F.col("id"), F.lit(4))
    a = mm.grouped_moments(df, terms, by)
    monkeypatch.setattr(mm, "WIDE", 2)
    b = mm.grouped_moments(df, terms, by)
    assert set(a) == set(b) == {0, 1, 2, 3}
    for k in a:
        assert a[k].n == b[k].n
        assert np.allclose(a[k].mean, b[k].mean) and np.allclose(a[k].sxx, b[k].sxx)


def test_moments_keep_digits_far_from_zero(spark):
    x = np.arange(2000) / 7.0
    df = spark.createDataFrame([(float(v) + 1e9, float(v) * 3 + 5) for v in x], "x double, y double")
    f = ols.fit(df, "y", ols.numeric("x"))
    assert f.b[0] == pytest.approx(3.0, rel=1e-6)


def test_alias_is_left_out_and_vif_is_infinite(frame):
    df, _x, _y = frame
    df = df.withColumn("twice", F.col("a") * 2 + 1)
    f = ols.fit(df, "y", ols.numeric("a", "twice", "b"))
    assert f.kept == ["a", "b"] and f.aliased == ["twice"]
    v = ols.variance_inflation(mm.moments(df, ols.numeric("a", "twice", "b")), ["a", "twice", "b"])
    assert math.isinf(v["a"]) and v["b"] == pytest.approx(1.0, abs=0.01)


def test_incomplete_rows_are_left_out_as_a_whole(frame):
    df, _x, _y = frame
    holes = df.withColumn("a", F.when(F.col("id") % 5 != 0, F.col("a"))).withColumn("b", F.when(F.col("id") % 7 != 0, F.col("b")))
    f = ols.fit(holes, "y", ols.numeric("a", "b"))
    g = ols.fit(holes.dropna(), "y", ols.numeric("a", "b"))
    assert f.n == g.n and np.allclose(f.b, g.b)


def test_perfect_fit_and_too_few_rows(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    f = ols.fit(df, "y", ols.numeric("x"))
    assert f.r2 == pytest.approx(1.0) and f.rss == pytest.approx(0.0, abs=1e-9)
    two = ols.fit(df.limit(2), "y", ols.numeric("x"))
    assert two.df_resid == 0 and math.isnan(two.sigma)
    assert two.glance_row()["nobs"] == 2


def test_stepwise_drops_noise(frame):
    df, _x, _y = frame
    df = df.withColumn("noise", F.sin(F.col("id") * 12.9898))
    terms = ols.numeric(*TERMS, "noise")
    m = mm.moments(df, {**terms, ols.Y: F.col("y")})
    for direction in ("backward", "forward", "both"):
        best, trace = ols.stepwise(m, terms, F.col("y"), direction)
        assert {"a", "b"} <= set(best.kept) and "noise" not in best.kept
        assert all(x[1] > y[1] for x, y in zip(trace, trace[1:]))


def test_orthogonal_polynomial_basis(frame):
    df, x, _y = frame
    basis = ols.polynomial("a", ols.polynomial_state(df, "a", 3))
    m = np.array(df.select(*basis.values()).collect())
    assert np.allclose(m.T @ m, np.eye(3), atol=1e-9) and np.allclose(m.sum(axis=0), 0, atol=1e-8)


def test_k_fold_equals_refits(frame):
    df, x, y = frame
    fold = F.pmod(F.col("id"), F.lit(5))
    got = {r["fold"]: r for r in ev.k_fold(df, F.col("y"), ols.numeric(*TERMS), fold).collect()}
    x1, k = np.column_stack([np.ones(len(y)), x]), np.arange(len(y)) % 5
    for i in range(5):
        b = np.linalg.lstsq(x1[k != i], y[k != i], rcond=None)[0]
        e = y[k == i] - x1[k == i] @ b
        assert got[i]["rmse"] == pytest.approx(math.sqrt(np.mean(e**2)), rel=1e-9)
        assert got[i]["r2"] == pytest.approx(1 - (e @ e) / ((y[k == i] - y[k != i].mean()) ** 2).sum(), rel=1e-9)


def test_learning_curve_errors_are_real(spark, frame):
    df, _x, _y = frame
    lc = ev.learning_curve(spark, df.withColumn("z", F.lit(1)), F.col("y"), ols.numeric(*TERMS), ["id", "z"], reps=2)
    last = lc.where("rep = 1").orderBy(F.desc("fraction")).first()
    b = ev.bucket(["id", "z"], 20)
    train, hold = df.withColumn("z", F.lit(1)).where(b < 16), df.withColumn("z", F.lit(1)).where(b >= 16)
    f = ols.fit(train, "y", ols.numeric(*TERMS))
    e = F.col("y") - f.prediction()
    assert last["n_train"] == train.count()
    assert last["train_rmse"] == pytest.approx(train.agg(F.sqrt(F.avg(e * e))).first()[0], rel=1e-9)
    assert last["val_rmse"] == pytest.approx(hold.agg(F.sqrt(F.avg(e * e))).first()[0], rel=1e-9)


def test_split_is_disjoint_and_stable(frame):
    df, _x, _y = frame
    train, test = ev.split(df, ["id"])
    ids = {r["id"] for r in train.collect()}, {r["id"] for r in test.repartition(3).collect()}
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 1500
    assert {r["id"] for r in ev.split(df.repartition(11), ["id"])[0].collect()} == ids[0]


def test_splits_take_null_text_and_many_keys(spark):
    rows = [(i, f"k{i % 50}" if i % 4 else None, i % 3) for i in range(2000)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "a long, b string, c long")
    for keys in (["a"], ["b", "a"], ["c", "b", "a"], ["b", "c"]):
        train, test = ev.split(df, keys)
        assert train.count() + test.count() == len(rows)
        assert train.count() > 0 and test.count() > 0
    share = ev.split(df, ["a"])[0].count() / len(rows)
    assert 0.77 < share < 0.83
    pairs = spark.createDataFrame([("1|2", "3"), ("1", "2|3"), ("12", "3"), ("1", "23"), (None, "123"), ("123", None)], "a string, b string")
    assert pairs.select(ev.key_hash(["a", "b"])).distinct().count() == 6


@pytest.mark.parametrize("listed", [20_000, 30])
def test_hash_cuts_are_exact_with_equal_keys_and_null_stratum(spark, monkeypatch, listed):
    """Every part of every stratum has its exact size, and rows of one key keep together but
    for those at a cut."""
    monkeypatch.setattr(ev, "LISTED", listed)
    rows = [(i if i % 3 else 7, i, None if i % 5 == 0 else i % 2) for i in range(3000)]  # a third of the rows has one key
    df = spark.createDataFrame(rows, "k long, t long, s int").repartition(5)
    shares = [0.0, 0.1, 0.35, 0.8]
    out = ev.cut_by_hash(df, F.col("s"), ["k"], ["t"], shares, "part")
    assert out.columns == ["k", "t", "s", "part"]
    got = {}
    for r in out.collect():
        got.setdefault(r.s, []).append((r.part, r.k, r.t))
    hashes = {r.k: r.h for r in df.select("k", ev.key_hash(["k"]).alias("h")).distinct().collect()}
    for s, some in got.items():
        n = len(some)
        cuts = [math.floor(n * x + 1e-9) for x in shares]
        want = sorted(some, key=lambda r: (hashes[r[1]], r[2]))
        assert [r[0] for r in want] == [sum(i >= c for c in cuts) for i in range(n)]
    assert sum(map(len, got.values())) == 3000
    assert ev.cut_by_hash(df.limit(0), F.col("s"), ["k"], ["t"], shares, "part").count() == 0


def test_stratified_split_takes_exact_share(frame):
    df, _x, _y = frame
    out = ev.stratified_split(df, "y", ["id"], ["id"]).groupBy("stratum").pivot("part", ["train", "test"]).count()
    for r in out.collect():
        assert r["train"] == math.floor(0.8 * (r["train"] + r["test"]))


def test_metric_properties_and_zero_actual(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 5.0)], "a double, p double")
    m = ev.metric_columns(F.col("a"), F.col("p"))
    r = df.agg(*[c.alias(k) for k, c in m.items()]).first()
    assert r["rmse"] >= r["mae"] and r["mse"] == pytest.approx(r["rmse"] ** 2)
    assert r["mape"] == pytest.approx((0.5 + 0.25) / 2 * 100)     # the zero actual has no percent error


def test_breusch_pagan_and_durbin_watson(frame):
    df, x, y = frame
    f = ols.fit(df, "y", ols.numeric(*TERMS))
    x1 = np.column_stack([np.ones(len(y)), x])
    e = y - x1 @ np.linalg.lstsq(x1, y, rcond=None)[0]
    z = e**2
    fitted = x1 @ np.linalg.lstsq(x1, z, rcond=None)[0]
    r2 = 1 - ((z - fitted) ** 2).sum() / ((z - z.mean()) ** 2).sum()
    assert ols.breusch_pagan(df, f)["statistic"] == pytest.approx(len(y) * r2, rel=1e-6)
    assert ols.durbin_watson(df, f, ["id"]) == pytest.approx((np.diff(e) ** 2).sum() / (e @ e), rel=1e-9)


def test_anova_equals_dummy_regression(frame):
    df, _x, _y = frame
    a = assoc.anova_oneway(df, "y", "g").where("term = 'g'").first()
    g = ols.fit(df, "y", ols.factor("g", ["u", "v", "w"])).glance_row()
    assert a["statistic"] == pytest.approx(g["statistic"]) and a["p_value"] == pytest.approx(g["p_value"])


# Points of published distribution tables.
def test_tails_match_tables():
    assert dist.t_quantile(0.975, 10) == pytest.approx(2.228139, abs=1e-6)
    assert dist.t_quantile(0.95, 1) == pytest.approx(6.313752, abs=1e-6)
    assert dist.t_two_sided(2.085963, 20) == pytest.approx(0.05, abs=1e-7)
    assert dist.f_upper(3.325835, 5, 10) == pytest.approx(0.05, abs=1e-6)
    assert dist.chi2_upper(3.841459, 1) == pytest.approx(0.05, abs=1e-7)
    assert dist.chi2_upper(18.307038, 10) == pytest.approx(0.05, abs=1e-7)
    assert dist.chi2_upper(2.0, 2) == pytest.approx(math.exp(-1.0))
    assert dist.normal_quantile(0.975) == pytest.approx(1.959964, abs=1e-6)
    assert dist.t_quantile(0.975, 1e6) == pytest.approx(1.959966, abs=1e-6)
    assert dist.t_two_sided(math.inf, 5) == 0.0
