"""The paths taken for large, skewed or tied data, forced on small data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import frame as fr
from tallyframe.operators import neighbors, ordering, quantiles
from tallyframe.session import State


@pytest.fixture
def tight(monkeypatch):
    """Small limits, so brackets and refinement are used on test-sized data."""
    monkeypatch.setattr(quantiles, "WHOLE", 10)
    monkeypatch.setattr(quantiles, "ACCURACY", 200)
    monkeypatch.setattr(quantiles, "MARGIN", 2.5 / 200)
    monkeypatch.setattr(quantiles, "INSIDE_LIMIT", 50)
    monkeypatch.setattr(quantiles, "RANKED", 20)


def skewed(spark, n=6000):
    """A third of the rows share one value, the rest has a heavy tail; some NULL."""
    rng = np.random.default_rng(5)
    x = np.exp(rng.normal(0, 2, n))
    x[rng.random(n) < 1 / 3] = 7.0
    rows = [(i, int(g), None if i % 97 == 0 else float(v)) for i, (g, v) in
            enumerate(zip(np.where(rng.random(n) < 0.4, 0, rng.integers(1, 6, n)), x))]
    return spark.createDataFrame(rows, "id long, g int, x double").repartition(7), rows


PROBS = [0.0, 0.01, 0.25, 0.5, 0.6, 0.75, 0.99, 1.0]


def test_bracketed_quantiles_are_exact(spark, tight):
    df, rows = skewed(spark)
    known = np.array([r[2] for r in rows if r[2] is not None])
    got = quantiles.quantiles(df, ["x", "id"], PROBS)
    assert np.allclose(got["x"], np.quantile(known, PROBS), rtol=1e-12)
    assert np.allclose(got["id"], np.quantile(np.arange(len(rows)), PROBS))


def test_refinement_runs(spark, tight, monkeypatch):
    df, rows = skewed(spark)
    calls = []
    real = quantiles._refine
    monkeypatch.setattr(quantiles, "_refine", lambda *a: calls.append(1) or real(*a))
    known = np.array([r[2] for r in rows if r[2] is not None])
    assert quantiles.median(df, "x") == pytest.approx(np.median(known))
    assert calls


def test_many_brackets_are_refined_with_one_sketch_a_row(spark, tight, monkeypatch):
    """The work on a row does not grow with the number of brackets."""
    df, rows = skewed(spark)
    built, rounds = [], []
    sketch, real = quantiles.F.percentile_approx, quantiles._refine
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *a: built.append(1) or sketch(*a))
    monkeypatch.setattr(quantiles, "_refine", lambda *a: rounds.append(1) or real(*a))
    known = np.array([r[2] for r in rows if r[2] is not None])
    probs = [k / 30 for k in range(31)]
    got = quantiles.quantiles(df, ["x", "id"], probs)
    assert np.allclose(got["x"], np.quantile(known, probs), rtol=1e-12)
    assert np.allclose(got["id"], np.quantile(np.arange(len(rows)), probs))
    assert rounds and len(built) == 2 + len(rounds)


def test_grouped_quantiles_with_hot_and_null_group(spark, tight):
    df, rows = skewed(spark)
    df = df.withColumn("g", F.when(F.col("g") != 5, F.col("g")))
    got = {r["g"]: r for r in quantiles.grouped_quantiles(df, ["g"], "x", [0.25, 0.5, 0.9], ["a", "b", "c"]).collect()}
    for g in (0, 1, 2, 3, 4, None):
        vals = [r[2] for r in rows if (r[1] if r[1] != 5 else None) == g and r[2] is not None]
        assert np.allclose(list(got[g])[1:], np.quantile(vals, [0.25, 0.5, 0.9]), rtol=1e-12)


def test_a_large_group_is_ranked_in_small_runs(spark, monkeypatch):
    """A million distinct values in one group: brackets hold few of them in the end."""
    monkeypatch.setattr(quantiles, "RANKED", 500)
    df = spark.range(1_000_000).select(F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(-1).alias("g"),
                                       (F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / 3.0).alias("x"))
    df = df.union(spark.range(40).select(F.lit(99).alias("g"), F.lit(None).cast("double").alias("x")))
    probs = [0.0, 0.25, 0.5, 0.99]
    state = quantiles.group_brackets(df, ["g"], "x", probs)
    for r in state.df.collect():
        if r["__n"] > quantiles.WHOLE:
            for j in range(len(probs)):
                held = df.where((F.col("g") == r["g"]) & F.col("x").between(r[f"__lo{j}"], r[f"__hi{j}"])).count()
                assert 1 <= held <= 2 * 500, (r["g"], j, held)
    got = {r.g: list(r)[1:] for r in quantiles.grouped_quantiles(df, ["g"], "x", probs, list("abcd"), count="n").collect()}
    local = df.toPandas()
    for g, part in local.groupby("g"):
        known = part["x"].dropna().to_numpy()
        assert got[g][0] == len(known)
        assert got[g][1:] == [None] * 4 if not len(known) else np.allclose(got[g][1:], np.quantile(known, probs), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert quantiles.quantiles(empty, ["x"], [0.5]) == {"x": [None]}
    nulls = spark.createDataFrame([(None, 1.0), (None, 4.0)], "x double, y double")
    assert quantiles.quantiles(nulls, ["x", "y"], [0.5]) == {"x": [None], "y": [2.5]}
    assert quantiles.trimmed_mean(empty, "x") is None


@pytest.mark.parametrize("trim", [0.0, 0.1, 0.34, 0.45])
def test_trimmed_mean_with_ties(spark, tight, trim):
    df, rows = skewed(spark)
    x = np.sort([r[2] for r in rows if r[2] is not None])
    k = int(len(x) * trim)
    assert quantiles.trimmed_mean(df, "x", trim) == pytest.approx(x[k: len(x) - k].mean())


@pytest.mark.parametrize("max_rows,salted", [(1, False), (1, True), (1000, False)])
def test_state_join_is_whole_and_matches_null(spark, max_rows, salted, monkeypatch):
    if salted:
        monkeypatch.setattr("tallyframe.session.SMALL_ROWS", 0)
    monkeypatch.setattr("tallyframe.session.HOT_KEYS", 2)
    rows = [(1, i) for i in range(300)] + [(None, i) for i in range(200)] + [(k, k) for k in range(2, 40)] + [(99, 0)]
    df = spark.createDataFrame(rows, "k int, v long")
    stats = df.where("k IS NULL OR k <> 99").groupBy("k").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    state = State(stats, ["k"], max_rows)
    assert state.small == (max_rows > 1)
    sums = {}
    for k, v in rows:
        sums[k] = sums.get(k, 0) + v
    sums[99] = None
    for how, size in (("left", len(rows)), ("inner", len(rows) - 1)):
        out = state.attach(df, how=how).collect()
        assert len(out) == size
        assert all(r["s"] == sums[r["k"]] for r in out)


def test_hot_null_and_unknown_keys_do_not_fill_one_task(spark):
    """60 % of one key, 20 % NULL, 10 % of a key without state: no task gathers them."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(saved, ("false", "-1")):
            spark.conf.set(k, v)
        i = F.col("id")
        key = F.when(i % 10 < 6, F.lit(1)).when(i % 10 < 8, None).when(i % 10 == 8, F.lit(-5)).otherwise((i / 10).cast("int") + 10)
        df = spark.range(40_000, numPartitions=8).select(key.cast("int").alias("k"), i.alias("v"))
        state = State(df.where("k > 0").groupBy("k").agg(F.count("*").alias("n")), ["k"], 1)
        out = state.attach(df)
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) <= 2 * 40_000 / 8
        assert out.where("k = 1").agg(F.min("n"), F.max("n")).first() == (24_000, 24_000)
        assert out.where("n IS NULL").count() == 12_000
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_written_tables_are_removed(spark):
    import os

    from tallyframe.session import checkpoint_root, materialize, release, scratch

    release(spark)
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    with scratch(spark):
        materialize(spark.range(5))
    kept = materialize(spark.range(3))
    assert kept.count() == 3 and len(set(os.listdir(root)) - before) == 1
    assert release(spark) == 1 and set(os.listdir(root)) == before


def test_row_numbers_over_many_parts_and_hot_group(spark):
    rng = np.random.default_rng(2)
    rows = [(0 if rng.random() < 0.6 else int(rng.integers(1, 50)), int(v), i) for i, v in
            enumerate(rng.integers(0, 40, 3000))]
    df = spark.createDataFrame(rows, "g int, v int, id int").repartition(9)
    got = {r["id"]: r["obs"] for r in ordering.row_numbers(df, ["v", "id"]).collect()}
    for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), 1):
        assert got[r[2]] == i
    got = {r["id"]: r["obs"] for r in ordering.row_numbers(df, ["v", "id"], by=["g"]).collect()}
    seen = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        seen[r[0]] = seen.get(r[0], 0) + 1
        assert got[r[2]] == seen[r[0]]


def test_adjacent_sums_cross_part_borders(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), i, float(v)) for i, (g, v) in enumerate(zip(rng.integers(0, 3, 2000), rng.normal(0, 1, 2000)))]
    df = spark.createDataFrame(rows, "g int, id int, v double").repartition(5)
    v = np.array([r[2] for r in rows])
    got = ordering.adjacent_sums(df, F.col("v"), ["id"])
    assert got["sq"] == pytest.approx((np.diff(v) ** 2).sum()) and got["pairs"] == 1999
    got = ordering.adjacent_sums(df, F.col("v"), ["id"], by=["g"])
    want = sum((np.diff([r[2] for r in rows if r[0] == g]) ** 2).sum() for g in range(3))
    assert got["sq"] == pytest.approx(want) and got["pairs"] == 1997


def test_neighbor_means_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 3, 400), 1)
    y = rng.normal(0, 1, 400)
    train = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    ask = [-30.0, -1.05, 0.0, 0.33, 2.0, 50.0]
    asked = spark.createDataFrame([(a, 1) for a in ask], "x double, rows long")
    got = {r["x"]: r["value"] for r in neighbors.neighbor_means(neighbors.donors(train, "y", "x"), asked, 5).collect()}
    for a in ask:
        far = np.abs(x - a)
        assert got[a] == pytest.approx(y[far <= np.sort(far)[4]].mean())


def test_neighbor_means_with_fewer_donors_than_k(spark):
    train = spark.createDataFrame([(1.0, 2.0), (5.0, 4.0)], "x double, y double")
    asked = spark.createDataFrame([(2.0, 3)], "x double, rows long")
    assert neighbors.neighbor_means(neighbors.donors(train, "y", "x"), asked, 5).first()["value"] == 3.0


def test_set_difference_and_unmatched(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (None,), (None,)], "k int")
    assert [r[0] for r in fr.set_difference(a, b).collect()] == [1]
    assert [r[0] for r in fr.unmatched(a, b, [("k", "k")]).collect()] == [1, 1]


@pytest.mark.parametrize("small", [0, 1000])
@pytest.mark.parametrize("how", ["left", "inner", "right", "full"])
def test_join_dimension_equals_plain_join(spark, how, small, monkeypatch):
    monkeypatch.setattr("tallyframe.session.SMALL_ROWS", small)
    monkeypatch.setattr("tallyframe.session.HOT_KEYS", 2)
    fact = spark.createDataFrame([(i, i % 3 if i % 2 else i % 40) for i in range(400)] + [(900, 77)], "id int, k int")
    dim = spark.createDataFrame([(k, f"d{k}") for k in range(0, 60)], "d int, name string")
    got = fr.join_dimension(fact, dim, [("k", "d")], how).select("id", "k", "d", "name")
    want = fact.join(dim, fact.k == dim.d, how).select("id", "k", "d", "name")
    order = lambda df: sorted(map(repr, df.collect()))
    assert order(got) == order(want)


def test_infinities_and_nan(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,), (float("nan"),), (float("-inf"),), (2.0,)], "x double")
    assert quantiles.quantiles(df, ["x"], [0.0, 1 / 3, 1.0])["x"] == [float("-inf"), 1.0, float("inf")]
