import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tallyframe.llm import dualtree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k=10):
    docs = [(i, Counter(words(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, length = len(docs), sum(x[2] for x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = defaultdict(list)
    for item, text in sorted(set(items), key=str):
        scores = []
        for i, c, size in docs:
            m = 100 - 75 + (75 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in words(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out[item] += [(r, None if gone else i, -s) for r, (s, gone, i) in enumerate(sorted(scores)[:k], 1)]
    return {i: sorted(x, key=str) for i, x in out.items() if x}


def read(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.item_id].append((r["rank"], r.doc_id, r.score))
    return {i: sorted(x, key=str) for i, x in out.items()}


def corpus(n=700, seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Éa", "ñ", "日本", "x9"]
    docs = [(i, " ".join(rnd.choice(vocab[:int(3 + 300 * rnd.random() ** 3)]) for _ in range(rnd.randint(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(200)]  # ties
    docs += [(n + 300, None), (n + 301, ""), (n + 302, " ,. "), (None, docs[5][1]), (None, docs[6][1]), (3, docs[3][1]), (n + 303, "W1 w1-W1_w2\x00w3 " * 3000)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 12))) + " W1, éa Éa") for i in range(40)]
    items += [(100, None), (101, "..."), (102, "absent"), (1, items[1][1]), (1, "w5 w6"), (None, "w7 w8 w7"), (103, docs[5][1])]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(4),
            spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x")))


def test_equal_to_brute_force(spark):
    docs, items = corpus()
    assert read(dualtree.rank(*frames(spark, docs, items))) == brute(docs, items)


def test_blocks_of_items_chunks_and_first_scores_change_nothing(spark, monkeypatch):
    docs, items = corpus(500, 2)
    for name, value in (("BLOCK_BYTES", 1500), ("CHUNK", 60), ("LEAF", 4), ("SAMPLE", 100)):
        monkeypatch.setattr(dualtree, name, value)
    assert read(dualtree.rank(*frames(spark, docs, items), k=3)) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = frames(spark, *corpus(20))
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text is null"), items)):
        out = dualtree.rank(d, i)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_prune_whole_batches():
    """Documents of many topics: most pairs of nodes go without a score."""
    rnd = random.Random(3)
    docs, rows = [], []
    for i in range(4000):
        topic = i % 20
        c = Counter(rnd.randrange(topic * 30, topic * 30 + 30) for _ in range(25))
        docs.append(sorted(c.items()))
    ends = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    flat = np.array([x for d in docs for x in d], np.int64)
    table = dualtree.Rows(ends, flat[:, 0], flat[:, 1] * 1000)
    items = dualtree.Items([(i, " ".join(f"t{(i % 20) * 30 + rnd.randrange(30):04d}" for _ in range(6)).encode()) for i in range(60)])
    # number the terms as the documents do
    code = np.array([int(t[1:]) for t in items.terms])
    width = 600
    items.terms = [b""] * width
    items.rows.term = code[items.rows.term]
    items.tree = dualtree.Tree(items.rows, width, dualtree.ITEM_LEAF)
    best = dualtree.Best(5, np.zeros(60, np.int64))
    scored = dualtree.search(items, table, list(range(4000)), best)
    assert scored < 60 * 4000 * 0.45, scored
    for i in range(60):
        vector = np.zeros(width, np.int64)
        span = slice(items.rows.ends[i], items.rows.ends[i + 1])
        vector[items.rows.term[span]] = items.rows.value[span]
        s = table.times(vector, np.arange(4000))
        want = sorted((-x, n) for n, x in enumerate(s.tolist()) if x > 0)[:5]
        assert [(x[0], x[2]) for x in best.found[i]] == want
