"""Model-based imputation: neighbours in several dimensions and bagged trees."""

import math
import random

import numpy as np
import pytest

from tallyframe.operators import nearest
from tallyframe.plans import bagging
from tallyframe.plans import recipe as rp


def brute(train, asked, k):
    known = [(x, y) for x, y in train if y is not None and all(v is not None and not math.isnan(v) for v in x)]
    real = [[v for v in col if v is not None and not math.isnan(v)] for col in zip(*[x for x, _ in train])]
    spans = [max(v) - min(v) for v in real]
    out = {}
    for a in asked:
        far = sorted((sum(abs(p - q) / s for p, q, s in zip(a, x, spans) if s > 0), y) for x, y in known)
        reach = far[min(k, len(far)) - 1][0]
        used = [y for d, y in far if d <= reach]
        out[a] = sum(used) / len(used)
    return out


@pytest.fixture()
def small(monkeypatch):
    for name, value in (("CELL", 60), ("CHUNK", 25), ("LEAF", 10), ("SAMPLE", 300)):
        monkeypatch.setattr(nearest, name, value)


def frame(spark, rows):
    return spark.createDataFrame([(i, *x, y, "z") for i, (x, y) in enumerate(rows)], "id long, a double, b double, c double, y double, x0 string").repartition(3)


def test_neighbours_in_three_dimensions_equal_brute_force(spark, small):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        # a dense corner with copies and ties, and a wide rest
        x = (rng.randint(0, 4), rng.randint(0, 4), 7.0) if i % 3 == 0 else (rng.uniform(0, 100), rng.gauss(0, 20), 7.0)
        rows.append((tuple(map(float, x)), float(rng.randint(0, 50)) if i % 4 else None))
    rows += [((None, 1.0, 7.0), None), ((1.0, math.nan, 7.0), None), ((None, 2.0, 7.0), 4.0), ((math.nan, 2.0, 7.0), 4.0)]
    df = frame(spark, rows)
    donors = nearest.Donors(df.where("not isnan(a) or a is null"), "y", ["a", "b", "c"])
    assert len(donors.cells) > 4 and donors.points.count() < 900
    got = {r.id: r.y for r in rp.Recipe("y", ["a", "b", "c"], ["id"]).step(rp.impute_knn, ["y"], by=["a", "b", "c"]).prep(df.where("not isnan(a) or a is null")).bake(df).collect()}
    train = [r for r in rows if r[0][0] is None or not math.isnan(r[0][0])]
    want = brute(train, {x for x, y in rows if y is None and None not in x and not any(map(math.isnan, x))}, 5)
    for i, (x, y) in enumerate(rows):
        if y is not None:
            assert got[i] == y
        elif x in want:
            assert abs(got[i] - want[x]) < 1e-9, (x, got[i], want[x])
        else:
            assert got[i] is None


def test_fewer_donors_than_neighbours_and_none(spark, small):
    rows = [((1.0, 1.0, 0.0), 10.0), ((2.0, 5.0, 0.0), 20.0), ((3.0, 3.0, 0.0), None)]
    step = lambda df: rp.Recipe("y", ["a", "b"], ["id"]).step(rp.impute_knn, ["y"], by=["a", "b"]).prep(df).bake(df)
    assert {r.id: r.y for r in step(frame(spark, rows)).collect()} == {0: 10.0, 1: 20.0, 2: 15.0}
    assert [r.y for r in step(frame(spark, rows[2:])).collect()] == [None]
    assert step(frame(spark, rows).limit(0)).count() == 0


def test_a_search_looks_at_few_pairs(monkeypatch):
    """Leaves keep most pairs of a task from being compared."""
    rng = np.random.default_rng(2)
    y, x = rng.normal(size=(20_000, 2)), rng.normal(size=(400, 2))
    seen = []
    real = nearest.distances
    monkeypatch.setattr(nearest, "distances", lambda a, b, r: seen.append(len(a) * len(b)) or real(a, b, r))
    i, j, d = nearest.search(x, np.full(400, np.inf), y, 5, [1.0, 1.0])
    assert sum(seen) < 0.1 * len(x) * len(y)
    every = np.sort(real(x, y, [1.0, 1.0]), axis=1)[:, :5]
    assert all(np.array_equal(np.sort(d[i == n]), every[n]) for n in range(400))


def test_trees_learn_a_step_and_repeat(spark):
    rng = random.Random(3)
    rows = [((rng.uniform(0, 10), rng.uniform(0, 10), 0.0), None) for _ in range(3000)]
    rows = [(x, (10.0 if x[0] > 4 else 0.0) + (5.0 if x[1] > 7 else 0.0) if i % 5 else None) for i, (x, _) in enumerate(rows)]
    df = frame(spark, rows)

    def baked(source):
        step = rp.Recipe("y", ["a", "b"], ["id"]).step(rp.impute_bag, ["y"], by=["a", "b"], keys=["id"], trees=8, depth=3, bins=32)
        return {r.id: r.y for r in step.prep(source).bake(source).collect()}

    got = baked(df)
    wrong = [i for i, (x, y) in enumerate(rows) if y is None and abs(got[i] - (10.0 if x[0] > 4 else 0.0) - (5.0 if x[1] > 7 else 0.0)) > 1.0]
    assert len(wrong) < 0.06 * 600
    assert all(got[i] == y for i, (_, y) in enumerate(rows) if y is not None)
    assert baked(df.repartition(7)) == got


def test_bootstrap_weights_are_poisson_and_edges(spark):
    draws = spark.range(20_000).select(bagging.draws(["id"], 7, 1).alias("d")).collect()
    w = np.searchsorted(bagging.poisson_cuts(), np.array([r.d for r in draws]), side="right")
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.05
    assert abs(np.corrcoef(w.T) - np.eye(7)).max() < 0.03
    none = frame(spark, [((1.0, 2.0, 3.0), None)] * 3)
    step = rp.Recipe("y", ["a", "b"], ["id"]).step(rp.impute_bag, ["y"], by=["a", "b"], keys=["id"])
    assert [r.y for r in step.prep(none).bake(none).collect()] == [None] * 3
    flat = frame(spark, [((1.0, None, 3.0), 4.0)] * 30 + [((1.0, 1.0, 3.0), None)])
    assert {r.y for r in step.prep(flat).bake(flat).collect()} == {4.0}
