"""Positions, level numbers, frequent values, one-scan sums and confidence bands."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.functions import dist
from tallyframe.operators import chartdata, describe, features, frequent, ordering
from tallyframe.plans import moments as mo
from tallyframe.plans import recipe as rp


@pytest.mark.parametrize("taken", [10_000, 5])
def test_rows_between_by_rank_selection(spark, monkeypatch, taken):
    monkeypatch.setattr(ordering, "TAKEN", taken)
    rnd = random.Random(1)
    rows = [(None if i % 20 == 0 else rnd.choice([3, 5, 5, 5, 9, rnd.randint(0, 400)]), i) for i in range(800)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(4)
    df = df.withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.col("a"))).withColumn("s", F.col("a").cast("string"))
    df = df.withColumn("z", F.col("d").cast("timestamp_ntz"))
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for col in ("a", "d", "z"):
        for lo, hi in ((1, 1), (30, 60), (41, 50), (300, 330), (795, 900), (900, 950))[:6 if col == "a" else 2]:
            got = sorted((r.obs, r.a, r.b) for r in ordering.rows_between(df, [col, "b"], lo, hi).collect())
            assert got == [(i, *want[i - 1]) for i in range(lo, min(hi, 800) + 1)], (col, lo, hi)
        if taken < 100:
            break
    text = sorted((r.obs, r.b) for r in ordering.rows_between(df.where("s is not null"), ["s", "b"], 10, 12).collect())
    plain = sorted((str(a), b) for a, b in rows if a is not None)
    assert text == [(i, plain[i - 1][1]) for i in (10, 11, 12)]
    assert ordering.rows_between(df.limit(0), ["a", "b"], 1, 5).count() == 0


def test_fifty_thousand_levels(spark):
    df = spark.range(60_000).select("id", F.format_string("l%05d", F.col("id") % 50_000).alias("c"))
    new = spark.createDataFrame([("l00000",), ("l49999",), ("never",), (None,)], "c string")
    done = rp.Recipe("id", ["c"]).step(rp.integer, ["c"]).prep(df)
    got = [r.c for r in done.bake(new.withColumn("id", F.lit(1).cast("long"))).collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == [0, 1, 50_000, None]
    ids = features.LevelIds(df, "c")
    sparse = {r.c: r.v for r in features.one_hot_sparse(new, ids, "v").collect()}
    assert sparse["l49999"].indices == [49_999] and sparse["l49999"]["values"] == [1.0] and sparse["l49999"]["size"] == 50_000
    assert sparse["never"].indices == [] and sparse[None].indices == []


def brute_nzv(values, freq_cut=19, unique_cut=10):
    c = Counter(v for v in values if v is not None)
    two = [n for _, n in c.most_common(2)]
    return bool(c) and (len(two) < 2 or two[0] / two[1] > freq_cut) and 100 * len(c) / sum(c.values()) < unique_cut


def test_near_zero_variance_equals_full_counts(spark, monkeypatch):
    monkeypatch.setattr(frequent, "TRACKED", 40)  # a poor sketch: bounds and the exact way are used
    monkeypatch.setattr(frequent, "UNSEEN", 2 * 3.5 / 64)
    rnd = random.Random(2)
    n = 4000
    cols = {
        "flat": [1] * n, "rare": [int(i % 50 == 0) for i in range(n)], "edge": [int(i % 20 == 0) for i in range(n)],
        "many": list(range(n)), "nearly": [0 if i % 2 else i % 380 for i in range(n)], "mid": [0 if i % 3 else i % 900 for i in range(n)],
        "wide": [7 if i < 100 else i % 399 + 10 for i in range(n)], "nulls": [None if i % 10 else 4 for i in range(n)],
        "none": [None] * n, "ten": [i // 10 for i in range(n)], "text": [rnd.choice("ab") if i % 60 == 0 else "c" for i in range(n)],
    }
    kinds = ", ".join(f"{c} {'string' if c == 'text' else 'int'}" for c in cols)
    df = spark.createDataFrame(list(zip(*cols.values())), kinds).repartition(5)
    assert set(frequent.near_zero_variance(df, list(cols), 19, 10)) == {c for c, v in cols.items() if brute_nzv(v)}


def test_sums_are_made_again_when_the_first_rows_are_far_off(spark, monkeypatch):
    x = np.concatenate([np.full(50, 1e12), np.random.default_rng(3).normal(5, 1e-3, 20_000)])
    df = spark.createDataFrame([(float(v), float(2 * v)) for v in x[50:]], "x double, y double").coalesce(1)
    monkeypatch.setattr(mo, "FIRST", 10)
    calls = []
    real = mo._sum_moments
    monkeypatch.setattr(mo, "_sum_moments", lambda d, n, c: calls.append(c) or real(d, n, c + (1e9 if len(calls) == 1 else 0)))
    m = mo.moments(df, {"x": F.col("x"), "y": F.col("y")})
    assert len(calls) == 2 and m.cov()[0, 0] == pytest.approx(x[50:].var(ddof=1), rel=1e-6)
    calls.clear()
    monkeypatch.setattr(mo, "_sum_moments", lambda d, n, c: calls.append(c) or real(d, n, c))
    assert mo.moments(df, {"x": F.col("x")}).cov()[0, 0] == pytest.approx(x[50:].var(ddof=1), rel=1e-9) and len(calls) == 1


def test_t_quantiles_as_a_column(spark):
    dfs = [1, 2, 3, 10, 199, 200, 201, 250, 1000, 10**6]
    got = spark.createDataFrame([(n,) for n in [*dfs, 0, -1, None]], "n long").select("n", dist.t_quantile_column(0.975, F.col("n")).alias("t")).collect()
    for r in got[:len(dfs)]:
        assert r.t == pytest.approx(dist.t_quantile(0.975, r.n), rel=1e-9)
    assert [r.t for r in got[len(dfs):]] == [None] * 3


def test_band_of_small_groups_against_the_formula(spark):
    rng = np.random.default_rng(4)
    data = {"a": 5, "b": 40, "two": 2, "one": 1, None: 9}
    rows = [(g, float(x), float(2 * x + rng.normal())) for g, n in data.items() for x in rng.uniform(0, 10, n)]
    rows += [("flat", 3.0, float(i)) for i in range(4)] + [("a", None, 1.0), ("a", 1.0, None), ("gone", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {}
    for r in chartdata.trend_band(df, ["g"], "x", "y", points=5).collect():
        got.setdefault(r.g, []).append(tuple(r)[1:])
    assert "gone" not in got and all(len(v) == 5 for v in got.values())
    for g, n in data.items():
        x, y = (np.array(v) for v in zip(*[r[1:] for r in rows if r[0] == g and None not in r[1:]]))
        if n > 2:
            b, a = np.polyfit(x, y, 1)
            s = math.sqrt(((y - a - b * x) ** 2).sum() / (n - 2))
            for at, fit, lo, hi in got[g]:
                half = dist.t_quantile(0.975, n - 2) * s * math.sqrt(1 / n + (at - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
                assert np.allclose([fit, lo, hi], [a + b * at, a + b * at - half, a + b * at + half], rtol=1e-9, atol=1e-9)
        elif n == 2:
            assert all(p[1] is not None and p[2] is None for p in got[g])
    assert all(p[1] is None for p in got["one"]) and all(p[1] is None for p in got["flat"])


def test_profile_of_groups_counts_missing_values_apart(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", None, "y"), ("a", 9.0, "x"), (None, None, None)], "g string, v double, t string")
    got = {(r.g, r.variable): r for r in describe.grouped_profile(df, ["g"], ["v"], ["t"], bins=4).collect()}
    assert got["a", "v"].hist == "█▁▁█" and got["a", "v"].p50 == 5.0 and got["a", "v"].n_missing == 1
    assert got["a", "t"].top_counts == "x: 2, y: 1" and got["a", "t"].n_unique == 2
    assert got[None, "v"].p50 is None and got[None, "v"].complete_rate == 0.0 and got[None, "t"].top_counts is None
    assert describe.skim(df.select("v")).first().hist[-1] == "█" and describe.skim(df.select("v")).first().hist[0] == "█"
