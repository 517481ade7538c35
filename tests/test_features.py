"""Feature state, recipes, scalars and describe operators at their edges."""

import math

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import scalars as S
from tallyframe.operators import chartdata as ch
from tallyframe.operators import describe as d
from tallyframe.operators import features as fe
from tallyframe.operators import frame as fr
from tallyframe.plans import recipe as rp


def one(df):
    return df.first()[0]


def value(spark, expr):
    return one(spark.range(1).select(expr))


# Small vectors with known results.
GRADES = [85, 90, 78, 92, 88, 76, 95]


def test_grades(spark):
    df = spark.createDataFrame([(float(g),) for g in GRADES], "g double")
    q = d.five_number(df, ["g"]).first()
    assert (q["min"], q["median"], q["max"]) == (76, 88, 95)
    assert one(df.agg(F.sum("g"))) == 604 and one(df.agg(F.count_if(F.col("g") >= 80))) == 5
    letter = S.case_when((F.col("g") >= 90, F.lit("A")), (F.col("g") >= 80, F.lit("B")), default=F.lit("C"))
    assert [r[0] for r in df.select(letter).collect()] == list("BACABCA")


def test_scalar_goldens(spark):
    assert [value(spark, S.celsius_to_fahrenheit(F.lit(c))) for c in (0.0, 100.0, 37.0)] == [32.0, 212.0, pytest.approx(98.6)]
    assert value(spark, S.str_pad(F.lit("42"), 6, "0")) == "000042"
    assert value(spark, S.str_pad(F.lit("1234567"), 6, "0")) == "1234567"
    assert value(spark, S.str_squish(F.lit("too   many   spaces"))) == "too many spaces"
    messy = ["  United  ", "delta", "SOUTHWEST", "American Airlines "]
    assert [value(spark, S.str_title(F.trim(F.lit(m)))) for m in messy] == ["United", "Delta", "Southwest", "American Airlines"]
    assert value(spark, S.str_replace_first(F.lit("a b a"), "a", "X")) == "X b a"
    assert value(spark, S.str_ends(F.lit("Air Incx"), "Inc.")) is True
    df = spark.createDataFrame([(v,) for v in (-4.0, 9.0, 16.0, -25.0)], "v double")
    assert one(df.agg(F.round(F.sqrt(F.abs(F.avg("v"))), 2))) == 1.0


def test_null_rules(spark):
    null = F.lit(None).cast("int")
    assert value(spark, S.if_else(null > 0, F.lit("a"), F.lit("b"))) is None
    assert value(spark, S.case_when((null > 0, F.lit("a")), default=F.lit("b"))) == "b"
    assert value(spark, S.is_in(null, [1, 2])) is False
    df = spark.createDataFrame([("2013", None), ("2014", "7")], "y string, m string")
    assert [r["d"] for r in fr.unite(df, "d", ["y", "m"], "-").collect()] == [None, "2014-7"]


def test_calendar(spark):
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    assert value(spark, S.week_of_year(day("2024-01-07"))) == 1
    assert value(spark, S.week_of_year(day("2024-01-08"))) == 2
    assert value(spark, S.week_of_year(day("2024-12-31"))) == 53
    assert value(spark, S.weekday_monday1(day("2024-01-01"))) == 1
    assert value(spark, S.quarter_label(F.lit(12))) == "Q4"


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,), (None,), (None,), (None,)], "x int")
    assert one(d.mode(df, "x")) == 1


def test_one_row_and_constant_spread(spark):
    df = spark.createDataFrame([(4.0,)], "x double")
    assert one(df.agg(F.stddev_samp("x"))) is None
    const = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    for fit in (fe.fit_zscore, fe.fit_minmax, fe.fit_robust):
        assert [r["x"] for r in fe.rescale(const, fit(const, ["x"])).collect()] == [None, None]


def test_scaling_properties(spark):
    df = spark.createDataFrame([(float(i * i),) for i in range(30)], "x double")
    z = fe.rescale(df, fe.fit_zscore(df, ["x"])).agg(F.avg("x"), F.stddev_samp("x")).first()
    assert z[0] == pytest.approx(0, abs=1e-12) and z[1] == pytest.approx(1)
    m = fe.rescale(df, fe.fit_minmax(df, ["x"])).agg(F.min("x"), F.max("x")).first()
    assert tuple(m) == (0.0, 1.0)


def test_bin_edges_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 1.0, 1.5, 2.0, 3.0, 9.0)], "x double")
    got = [r[0] for r in df.select(fe.band_by_edges(F.col("x"), [0.0, 1.0, 2.0, 3.0], ["a", "b", "c"])).collect()]
    assert got == [None, "a", "a", "b", "b", "c", None]


def test_unseen_category_and_null(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, y double")
    new = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    enc = fe.KeyEncoding(train, "k", F.avg("y"), "e")
    assert {r["k"]: r["e"] for r in enc.apply(new).collect()} == {"a": 2.0, "z": None, None: None}
    hot = fe.one_hot(new, "k", fe.fit_levels(train, "k"), keep=True)
    assert {r["k"]: (r["k_a"], r["k_b"]) for r in hot.collect()} == {"a": (1, 0), "z": (0, 0), None: (None, None)}


def test_group_median_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", None), (None, 7.0), (None, None)], "g string, x double")
    got = sorted((r["g"] or "", r["x"]) for r in fe.GroupMedian(df, ["g"], "x").apply(df).collect())
    assert got == [("", 7.0), ("", 7.0), ("a", 1.0), ("a", 2.5), ("a", 4.0)]


def test_box_cox_finds_log(spark):
    df = spark.createDataFrame([(math.exp(i / 50),) for i in range(-100, 101)], "x double")
    lam, _ = fe.fit_box_cox(df, "x")
    assert lam == 0.0
    neg = spark.createDataFrame([(0.0,), (-1.0,)], "x double")
    assert [r[0] for r in neg.select(fe.box_cox(F.col("x"), 0.0)).collect()] == [None, None]


def test_recipe_state_comes_from_training_rows_only(spark):
    train = spark.createDataFrame([(1, 1.0, "u"), (2, 2.0, "u"), (3, None, None), (4, 9.0, "v")], "id int, x double, c string")
    train = train.withColumn("y", F.col("id") * 1.0)
    test = spark.createDataFrame([(9, None, None, 1.0), (10, 500.0, "w", 1.0)], "id int, x double, c string, y double")
    recipe = (rp.Recipe("y", ["x", "c"], ["id"]).step(rp.impute_median, rp.all_numeric_predictors)
              .step(rp.impute_mode, rp.all_nominal_predictors).step(rp.dummy, rp.all_nominal_predictors)
              .step(rp.normalize, ["x"]))
    prepped = recipe.prep(train)
    a, b = prepped.bake(test), prepped.bake(test.where("id = 9"))
    assert a.columns == prepped.bake().columns
    assert a.where("id = 9").collect() == b.collect()
    assert prepped.bake().agg(F.avg("x")).first()[0] == pytest.approx(0, abs=1e-12)


def test_null_report_and_rows(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r["variable"]: (r["n_miss"], round(r["pct_miss"], 1)) for r in d.null_counts(df).collect()}
    assert got == {"a": (1, 33.3), "b": (2, 66.7)}
    assert df.where(fr.any_null(df.columns)).count() == 2
    assert fr.dense_columns(df, 0.5) == ["a"]


def test_histogram_keeps_every_row(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 5, 10, 10)], "x double")
    h = {r["bin"]: r["n"] for r in ch.histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 1, 2: 1, 4: 2}
    dens = ch.histogram(df, "x", 5).agg(F.sum(F.col("density") * (F.col("right") - F.col("left")))).first()[0]
    assert dens == pytest.approx(1.0)


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(math.sin(i) + math.sin(2.3 * i) + math.sin(5.1 * i),) for i in range(500)], "x double")
    rows = ch.density(df, "x", points=200).orderBy("x").collect()
    step = rows[1]["x"] - rows[0]["x"]
    assert 0.85 < sum(r["density"] for r in rows) * step <= 1.001


def test_skim_reads_every_column(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "a")], "x double, s string")
    rows = {r["variable"]: r for r in d.skim(df).collect()}
    assert rows["x"]["n_missing"] == 1 and rows["x"]["p50"] == 2.0
    assert rows["s"]["n_unique"] == 2 and rows["s"]["top_counts"] == "a: 2, b: 1"


def test_drop_first_by_and_dropping_one_row(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, None)], "id int, v double")
    assert sorted(r["id"] for r in fr.drop_first_by(df, "v", ["id"]).collect()) == [1, 3, 4]


def test_nzv_and_corr_and_other(spark):
    df = spark.createDataFrame([(i, 1 if i == 0 else 0, float(i), float(i) * 2, "abc"[i % 3] if i > 3 else "rare") for i in range(100)],
                               "id int, flag int, u double, w double, s string").withColumn("y", F.lit(1.0))
    r = rp.Recipe("y", ["flag", "u", "w", "s"], ["id"]).step(rp.nzv).step(rp.corr, rp.all_numeric_predictors).step(rp.other, ["s"])
    out = r.prep(df).bake()
    assert "flag" not in out.columns and len({"u", "w"} & set(out.columns)) == 1
    assert {x["s"] for x in out.select("s").distinct().collect()} == {"a", "b", "c", "other"}
