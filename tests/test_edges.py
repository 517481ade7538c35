"""Plain edge data: empty, one row, all NULL, constant, NULL group, perfect fit."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.catalog.registry import rounded
from tallyframe.operators import associate, chartdata, describe, quantiles
from tallyframe.plans import evaluate, ols
from tallyframe.sources.tables import read_csv, write_csv

SCHEMA = "g string, x double, y double"


@pytest.fixture(params=["empty", "one", "nulls", "constant", "null_group"])
def odd(request, spark):
    rows = {"empty": [], "one": [("a", 1.0, 2.0)], "nulls": [("a", None, None)] * 4, "constant": [("a", 3.0, 3.0)] * 5,
            "null_group": [(None, 1.0, 1.0), (None, 2.0, 3.0), ("a", None, None)]}
    return spark.createDataFrame(rows[request.param], SCHEMA)


def test_nothing_raises_and_nothing_is_lost(odd):
    for f in (lambda: chartdata.density(odd, "x", points=4, bins=8), lambda: chartdata.density(odd, "x", ["g"], points=4, bins=8),
              lambda: chartdata.histogram(odd, "x", 3), lambda: chartdata.bin2d(odd, "x", "y", 2), lambda: associate.anova_oneway(odd, "y", "g"),
              lambda: odd.agg(describe.coefficient_of_variation(F.col("x") - F.col("x")), describe.weighted_mean(F.col("x"), F.lit(0.0))),
              lambda: evaluate.eval_regression(odd, F.col("x"), F.col("y"), "m"), lambda: describe.crosstab(odd, "g", "x")):
        f().collect()
    associate.correlation_test(odd, "x", "y") if odd.dropna().count() else None
    got = quantiles.grouped_quantiles(odd, ["g"], "x", [0.5], ["m"]).collect()
    assert sorted(str(r.g) for r in got) == sorted(str(r.g) for r in odd.select("g").distinct().collect())


def test_rounding_keeps_large_and_special_values(spark):
    values = [1e13, 1e300, -1e300, math.inf, -math.inf, math.nan, 2.5000005, -0.1234565, 0.0, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(rounded("v", 6)).collect()]
    assert got[:5] == values[:5] and math.isnan(got[5]) and got[6:] == [2.500001, -0.123457, 0.0, None]


def test_correlation_and_anova_at_the_limit(spark):
    line = spark.createDataFrame([("a" if i % 2 else "b", float(i), -2.0 * i) for i in range(6)], SCHEMA)
    got = associate.correlation_test(line, "x", "y")
    assert (got["estimate"], got["conf_low"], got["conf_high"]) == (-1.0, -1.0, -1.0) and got["p_value"] == 0.0
    flat = spark.createDataFrame([("a", 0.0, 1.0)] * 3 + [("b", 0.0, 2.0)] * 3, SCHEMA)
    assert associate.anova_oneway(flat, "y", "g").first()["statistic"] == math.inf


def test_perfect_fit_unknown_level_and_self_fitting_row(spark):
    rows = [("a", float(i), 2.0 * i) for i in range(5)] + [("b", 9.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    f = ols.fit(df, "y", {**ols.numeric("x"), **ols.factor("g", ["a", "b"])})
    last = f.augment(df).where("g = 'b'").first()
    assert last["std_resid"] is None and last["cooksd"] is None
    new = spark.createDataFrame([("z", 1.0, None)], SCHEMA)
    assert new.select(f.prediction().alias("p")).first()["p"] is None
    assert math.isnan(ols.anova_nested(f, f)["statistic"])


def test_bucket_takes_large_keys_and_many(spark):
    df = spark.range(2000).select((F.col("id") * 4_000_000_000_000_000).alias("a"), "id", (F.col("id") % 7).alias("c"))
    both = df.select(evaluate.bucket(["a", "id"], 10).alias("b"), evaluate.bucket(["a", "id", "c"], 10).alias("d"))
    assert both.where("b <> d").count() > 0 and both.select("b").distinct().count() > 1


def test_crosstab_keeps_all_rows(spark):
    df = spark.createDataFrame([("r", "a"), ("r", "b"), ("r", "q"), ("s", "q"), (None, "a")], "k string, v string")
    got = {r.k: (r.a, r.b, r.rest) for r in describe.crosstab(df, "k", "v", ["a", "b"], other="rest").collect()}
    assert got == {"r": (1, 1, 1), "s": (0, 0, 1)}
    text = describe.row_percent(describe.crosstab(df, "k", "v"), ["a", "b", "q"], 3).where("k = 'r'").first()
    assert text["a"] == "33.333%"


def test_csv_brings_every_text_back(spark, tmp_path):
    rows = [(1, "a\nb"), (2, 'say "x", \\y'), (3, ""), (4, None), (5, "  blanks  "), (6, "é,;\r\n|")]
    df = spark.createDataFrame(rows, "i int, t string")
    write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "c"), "i int, t string").collect())) == rows


def test_a_large_csv_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    """Split borders fall into lines, texts and quotes; a text may span several splits."""
    rnd = random.Random(5)
    bits = ["a", '"', ",", "\n", "\r\n", " ", "é", '""', "\n\n", "x,y", '"\n"']
    rows = [(i, None if i % 9 == 0 else "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))), i / 4) for i in range(3000)]
    rows += [(9000, "long " + "line\n" * 3000, 1.0), (9001, None, None), (9002, 'i,t,v', 2.0)]
    df = spark.createDataFrame(rows, "i int, t string, v double").coalesce(2)
    write_csv(df, str(tmp_path / "c"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("3000", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", size)
            got = read_csv(spark, str(tmp_path / "c"), "i int, t string, v double")
            assert sorted(map(tuple, got.collect())) == sorted(rows)
            tasks = spark.read.text(str(tmp_path / "c")).rdd.getNumPartitions()
            assert tasks > 10 if size == "3000" else tasks <= 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    with pytest.raises(Exception):
        write_csv(spark.createDataFrame([("x",)], "t string"), str(tmp_path / "bad"))
        read_csv(spark, str(tmp_path / "bad"), "i int, j int").collect()
    write_csv(df.limit(0), str(tmp_path / "none"))
    assert read_csv(spark, str(tmp_path / "none"), "i int, t string, v double").count() == 0
