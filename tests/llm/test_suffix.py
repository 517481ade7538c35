import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyframe.llm import suffix


def brute(texts, size, keep="none"):
    """Kept bytes per text; texts in order of their keys."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + size] for d in data for i in range(len(d) - size + 1))
    once, out = set(), []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            w = d[i:i + size]
            if (seen[w] > 1) if keep == "none" else (w in once):
                gone[i:i + size] = b"\x01" * size
            once.add(w)
        runs = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def corpus(seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéü") for _ in range(rnd.randint(1, 8)))
    passage = [" ".join(word() for _ in range(40)) for _ in range(4)]
    texts = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rnd.randint(0, 30))) for _ in range(3)]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passage)
            a = rnd.randint(0, 60)
            parts.insert(rnd.randint(0, len(parts)), p[a:a + rnd.randint(20, 150)])
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3] + "x", "y" + texts[5], None, "", "ab" * 300, "q" * 500, "q" * 64, texts[0] + " " + texts[0]]
    return texts


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [2000, 2])
def test_against_brute_force(spark, keep, group, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", 5000)
    texts = corpus()
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int").repartition(5)
    got = result(suffix.remove(df, 64, keep, group=group, whole_chars=False))
    want = dict(enumerate(brute(texts, 64, keep)))
    assert got == want


def test_long_text_in_parts(spark, monkeypatch):
    rnd = random.Random(3)
    p = "".join(rnd.choice("abcd ") for _ in range(700))
    texts = ["".join(rnd.choice("abcd ") for _ in range(2000)) + p + "".join(rnd.choice("abcd ") for _ in range(1500)) for _ in range(4)]
    old = suffix.PART
    want = suffix.contexts(enumerate(t.encode() for t in texts), 100)
    suffix.PART = 900
    try:
        parts = np.concatenate(suffix.contexts(enumerate(t.encode() for t in texts), 100), axis=1)
    finally:
        suffix.PART = old
    whole = np.concatenate(want, axis=1)
    assert whole[2].sum() == parts[2].sum() == sum(len(t) - 99 for t in texts)
    at = lambda x: {(d, s + i): (a, s + h) for d, s, n, h, a, _ in x.T.tolist() for i in range(n)}
    assert at(whole) == at(parts)


def test_factors_against_brute_force():
    rnd = random.Random(5)
    codes = np.array([rnd.randint(1, 2) for _ in range(300)] + [0] + [rnd.randint(1, 2) for _ in range(200)] + [0])
    codes = np.concatenate([codes[:100], codes[40:90], codes])
    before, after = suffix.factors(codes, 12)
    n = len(codes)

    def common(i, j):
        k = 0
        while max(i, j) + k < n and codes[i + k] == codes[j + k] and k < 12:
            k += 1
        return k

    for i in range(n):
        assert (before[i] >= 12) == any(common(i, j) >= 12 for j in range(i))
        assert (after[i] >= 12) == any(common(i, j) >= 12 for j in range(i + 1, n))


def test_edges(spark):
    t = "é" * 300
    rows = [(1, t, "x"), (1, t, "x"), (None, t + "z", "x"), (4, None, None), (5, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = suffix.remove(df, 101, keep="none").collect()
    assert len(got) == 5 and all(r.n_removed >= r.n_bytes - 3 for r in got)
    first = {(r.doc_id, r.n_bytes): r for r in suffix.remove(df, 101, keep="first").collect()}
    assert first[(None, 601)].n_removed < 600 and first[(4, 0)].text is None
    assert all("�" not in (r.text or "") for r in first.values())
    assert suffix.remove(df.limit(0), 101).count() == 0
    with pytest.raises(ValueError):
        suffix.remove(df, 10)


def test_query_returns_the_text_that_is_left(spark, tmp_path):
    from tallyframe.llm.queries import QUERIES

    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 8)))
    p = " ".join(word() for _ in range(120))
    texts = [" ".join(word() for _ in range(30)) + p + " ".join(word() for _ in range(i)) for i in range(6)]
    texts += [" ".join(word() for _ in range(90)) for _ in range(4)] + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op6_suffix_dedup"](spark, str(tmp_path)).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == dict(enumerate(brute(texts, 400)))
    for r in rows:
        left = (r.text or "").encode()
        assert (r.text is None) == (texts[r.doc_id] is None) and hashlib.sha256(left).hexdigest() == r.kept_sha256
        assert len(left) == r.n_bytes - r.n_removed and (r.n_removed > 0) == (r.doc_id < 6)
