import numpy as np

from tallyframe.llm import annpartition as ap


def brute(ids, x, k=20, every=20):
    out = {}
    for i in range(len(ids)):
        if ids[i] % every == 0:
            s = (x * x[i]).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def answer(df, k=20):
    got = {}
    for r in ap.nearest(df, df.where("vec_id % 20 = 0"), k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(v)] for q, v in got.items()}, got


def test_small_table_is_exact_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:150] = x[50]  # many equal vectors
    rows = [(i, [float(v) for v in x[i]], "x") for i in range(300)]
    odd = [(1000, None, "x"), (1020, [0.0] * 8, "x"), (1040, [None] * 8, "x"), (1060, [float("nan")] * 8, "x"),
           (1080, [float("inf")] * 8, "x"), (1100, [1.0] * 3, "x"), (None, rows[3][1], "x"), rows[60], rows[7], (1120, [], "x")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank string").repartition(3)
    got, raw = answer(df)
    want = brute(np.arange(300), x.astype(float))
    assert {q: [v for v, _ in a] for q, a in got.items()} == {q: [v for v, _ in a] for q, a in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))
    assert all(sorted(r[0] for r in v) == list(range(1, 21)) for v in raw.values())


def test_fewer_candidates_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 1.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert answer(df)[0] == {0: [(2, 2.0), (1, 0.5)]}
    assert ap.nearest(df.limit(0), df.limit(0)).count() == 0


def test_recall_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(ap, "CHUNK", 100)
    monkeypatch.setattr(ap, "EXACT", 500)
    monkeypatch.setattr(ap, "SPREAD", 20)
    rng = np.random.default_rng(2)
    mid = rng.normal(size=(12, 16))
    x = mid[rng.integers(0, 12, 3000)] + 0.6 * rng.normal(size=(3000, 16))
    x[1000:2000] = x[1000]  # a third of all rows are one vector
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = answer(df)[0]
    want = brute(np.arange(3000), x)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = [len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9


def test_parts_with_too_few_rows_lead_on_to_the_next(spark, monkeypatch):
    """One probe into parts of about thirty rows still gives fifty answers."""
    monkeypatch.setattr(ap, "EXACT", 100)
    monkeypatch.setattr(ap, "SPREAD", 2)
    real = ap.fit

    def one_probe(*args, **kwargs):
        router = real(*args, **kwargs)
        router.probes = 1
        return router

    monkeypatch.setattr(ap, "fit", one_probe)
    rng = np.random.default_rng(5)
    x = np.repeat(4 * np.eye(8), 64, axis=0) + 0.2 * rng.normal(size=(512, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    raw = ap.nearest(df, df.where("vec_id % 20 = 0"), k=200).groupBy("query_id").count().collect()
    assert len(raw) == 26 and all(r["count"] == 200 for r in raw)


def test_bisection_is_balanced_and_follows_the_graph():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(100, 8)) * 0.2 + m for m in 3 * np.eye(8)[:4]])
    label = ap.bisect(ap.neighbours(x / np.linalg.norm(x, axis=1, keepdims=True), 8), 4)
    assert (np.bincount(label) == 100).all()
    assert all(np.bincount(label[i:i + 100]).max() > 85 for i in range(0, 400, 100))
