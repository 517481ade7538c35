import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import pareto


def level(words, weights, cap=3):
    """Targets by taking sources off one by one until none is above."""
    full = set()
    while True:
        left = sum(words) - cap * sum(words[i] for i in full)
        rest = sum(weights[i] for i in range(len(words)) if i not in full)
        want = [cap * words[i] if i in full else weights[i] * left / rest for i in range(len(words))]
        more = {i for i in range(len(words)) if want[i] > cap * words[i]}
        if not more:
            return want
        full |= more


def check(rows, texts):
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    names = sorted(by, key=lambda s: (s is None, s))
    sizes = [sum(len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")) for r in by[n]) for n in names]
    want = level(sizes, [1 + i % 3 for i in range(len(names))])
    for name, size, target in zip(names, sizes, want):
        some = by[name]
        assert {r.source_size for r in some} == {size} and {round(r.target, 6) for r in some} == {round(target, 6)}
        for r in some:
            assert r["size"] == len((texts[r.doc_id] or "").split()) and r.taken == r.copies * r["size"] <= 3 * r["size"]
            if size:
                assert r.copies in (int(target / size), int(target / size) + 1)
        gap = target - sum(r.taken for r in some)
        # what is missing is less than any document that was left out
        out = [r["size"] for r in some if size and r.copies == int(target / size) and r["size"]]
        assert gap >= 0 and (not out or gap < max(out)), (name, gap)
        assert gap <= 0.05 * target + 60, (name, gap, target)


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(6000):
        source = "hot" if i % 3 == 0 else None if i % 17 == 0 else f"s{int(rng.integers(0, 9))}"
        rows.append((i, "w " * int(min(rng.lognormal(3, 1.2), 3000)), source))
    rows += [(7000, None, "empty"), (7001, "", "empty"), (7002, "one", "tiny"), (7003, None, "s1")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x"))


def test_targets_copies_and_gaps(spark, docs):
    rows = pareto.mix(docs, keep=["source"]).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    check(rows, texts)
    again = pareto.mix(docs.repartition(5), keep=["source"]).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_bins_of_any_fineness_and_large_state_agree(spark, docs, monkeypatch):
    want = sorted((r.doc_id, r.copies) for r in pareto.mix(docs).collect())
    monkeypatch.setattr(pareto, "FEW", 1)
    assert sorted((r.doc_id, r.copies) for r in pareto.mix(docs).collect()) == want
    monkeypatch.setattr("tallyframe.session.SMALL_ROWS", 3)
    assert sorted((r.doc_id, r.copies) for r in pareto.mix(docs).collect()) == want


def test_unequal_odds_are_kept(spark):
    """As many documents are taken as their inclusion odds say, whatever their place."""
    rows = [(i, "w " * 10, "a") for i in range(1200)] + [(5000 + i, "w " * 10, "b") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    merit = F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)
    got = {r.doc_id: r.copies for r in pareto.mix(df, weights=(3, 2), merit=merit).collect()}
    # a: 12,000 words of 20,000, so one copy a document on average: 1.5 of even ids, 0.5 of odd ones
    for lo, hi in ((0, 1200), (0, 600), (600, 1200)):
        even, odd = (np.array([got[i] for i in range(lo + p, hi, 2)]) for p in (0, 1))
        assert abs(even.mean() - 1.5) < 0.09 and abs(odd.mean() - 0.5) < 0.09
        assert set(even) == {1, 2} and set(odd) == {0, 1}


def test_merits_stop_at_the_cap_and_expand(spark):
    rows = [(1, "a b", "x"), (2, "c d", "x"), (3, "e f", "x"), (3, "e f", "x"), (None, "g h i", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    merit = F.when(F.col("doc_id") == 1, 100.0).when(F.col("doc_id") == 2, None).otherwise(1.0)
    got = {r.doc_id: r for r in pareto.mix(df, merit=merit, keep=["text"]).collect()}
    assert got[1].copies == 3 and got[2].copies == 0
    out = pareto.expand(pareto.mix(df, keep=["text"])).collect()
    assert sorted((r.doc_id or 0, r.copy) for r in out) == [(0, 1), (1, 1), (2, 1), (3, 1), (3, 1)]
    assert pareto.mix(df.limit(0)).count() == 0
