import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import dartminhash as dm


def grams(t):
    w = t.lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def classes(rows):
    """Brute force: smallest id by row, of components of all pairs at 0.8."""
    g = [None if t is None else grams(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if g[i] is None or g[j] is None:
                continue
            both = sum((g[i] & g[j]).values())
            all_ = sum((g[i] | g[j]).values())
            if rows[i][1] == rows[j][1] or both and 10 * both >= 8 * all_:
                label[find(i)] = find(j)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(k)
    return sorted(((k, min((x for x in groups[find(i)] if x is not None), default=None), len(groups[find(i)]))
                   for i, (k, _) in enumerate(rows)), key=str)


def family(seed, n, words=120, change=3):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 3000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rnd.randint(0, change)):
            t[rnd.randrange(words)] = f"x{rnd.randint(0, 10**6)}"
        out.append(" ".join(t))
    return out


ODD = [None, None, "", "", " \n", "one", "ONE", "one two", "a b c d e f", "In. " * 400, "In. " * 410, "In. " * 200, "z " * 30000 + "q"]


@pytest.mark.parametrize("room", [1000, 8])
def test_against_brute_force(spark, room, monkeypatch):
    monkeypatch.setattr(dm, "ROOM", room)
    texts = ODD + [t for s in range(5) for t in family(s, 12)] + family(9, 40, change=1) + family(11, 15, 60, 6)
    texts += [texts[20], texts[20].upper(), texts[20].replace(" ", "\n ")]
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[5]), (3, texts[3])]
    df = spark.createDataFrame([(k, t, "a") for k, t in rows], "doc_id long, text string, class_id string").repartition(4)
    got = sorted((tuple(r) for r in dm.near_duplicates(df).collect()), key=str)
    want = classes(rows)
    assert got == [(k, k if t is None else c, n) for (k, c, n), t in zip(want, [dict(rows).get(k) if k is not None else texts[5] for k, _, _ in want])]


def test_signature_agrees_as_often_as_texts_are_similar():
    a, b = "x y " * 3, ""
    rnd = random.Random(2)
    pairs = []
    for s in range(60):
        t = family(s, 1, 200)[0].split()
        u = list(t)
        for i in rnd.sample(range(200), 6):
            u[i] = "q"
        pairs += [" ".join(t), " ".join(u)]
    doc, elem, weight = dm.shingles(pa.array(pairs))
    sig = dm.signatures(doc, elem, weight, len(pairs))
    same = (sig[::2] == sig[1::2]).mean()
    true = np.mean([sum((grams(a) & grams(b)).values()) / sum((grams(a) | grams(b)).values()) for a, b in zip(pairs[::2], pairs[1::2])])
    assert abs(same - true) < 0.03 and (sig != 0).all()


def test_weights_count():
    doc = np.array([0, 1] * 2).repeat(1)
    doc, elem, weight = np.array([0, 0, 1, 1]), np.array([5, 9, 5, 9], np.uint64), np.array([6, 2, 3, 2])
    agree = []
    for s in range(300):
        sig = dm.signatures(doc, elem + np.uint64(1000 * s), weight, 2)
        agree.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(agree) - 5 / 8) < 0.02


def test_empty_and_keep_one(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert dm.near_duplicates(df).count() == 0 and dm.keep_one(df).count() == 0
    t = family(1, 1)[0]
    df = spark.createDataFrame([(4, t), (2, t), (2, t), (None, t), (7, None), (8, "other")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in dm.keep_one(df).collect()) == ["2", "7", "8", "None"]


def test_one_shared_band_is_enough_in_a_large_room(spark, monkeypatch):
    monkeypatch.setattr(dm, "ROOM", 8)
    rows = [(bytes([i]), [1] + [100 * i + b for b in range(2, 21)], b"") for i in range(1, 31)]
    met = {}
    for r in dm.rooms(spark.createDataFrame(rows, "node binary, bands array<long>, sketch binary")).collect():
        met.setdefault(tuple(r.room), set()).add(bytes(r.node))
    pairs = {(a, b) for nodes in met.values() for a in nodes for b in nodes}
    assert all((a[0], b[0]) in pairs for a in rows for b in rows)
    assert max(map(len, met.values())) < 30


def test_keep_one_decides_by_row(spark):
    t, u = family(1, 1)[0], family(2, 1)[0]
    near = t.rsplit(" ", 1)[0] + " q"
    rows = [(1, t, 5), (2, near, 1), (2, u, 1), (3, u, 1), (4, None, 1), (4, "other", 1), (1, t, 3), (6, "twice here", 1), (6, "another one", 1)]
    got = dm.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(3)).collect()
    want = [(1, t, 3), (2, u, 1), (4, None, 1), (4, "other", 1), (6, "twice here", 1), (6, "another one", 1)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
