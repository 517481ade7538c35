import numpy as np

from tallyframe.llm import sitequality as sq


def run(spark, docs, labels, levels=("source", "lang"), feats=None):
    feats = sq.features(docs)
    return sq.classify(docs, sq.fit(feats, labels), list(levels), feats=feats)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train = labels.where("doc_id % 3 <> 0")
    got = {r.doc_id: r.kept for r in run(spark, docs, train).collect()}
    test = labels.where("doc_id % 3 = 0").collect()
    assert np.mean([got[r.doc_id] == bool(r.quality) for r in test]) > 0.93
    assert np.mean([got[r.doc_id] for r in test if r.quality]) > 0.97


def test_sparse_site_shrinks_and_bad_site_counts(spark):
    good, bad = " ".join(f"word{i} and" for i in range(80)), "# $ % " * 60
    rows = [(i, good if i % 10 else bad, "a", "en") for i in range(300)]
    rows += [(1000 + i, bad if i % 10 else good, "b", "en") for i in range(300)]
    rows += [(2000, good, "c", "en"), (2001, None, None, None), (2002, good, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[1] == good)) for r in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in run(spark, docs, labels).collect()}
    assert len(got) == len(rows)
    assert got[1].p_site > 0.8 and got[1001].p_site < 0.2
    assert got[1001].p_site < got[2000].p_site < got[1].p_site
    assert got[1].kept and not got[0].kept and got[2000].kept


def test_edges(spark):
    schema = "doc_id long, text string, source string, lang string, kept string, f_word int"
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert run(spark, spark.createDataFrame([], schema), labels).count() == 0
    docs = spark.createDataFrame([(1, None, None, None, "x", 1), (1, None, None, None, "x", 1), (None, "", "s", "en", None, None),
                                  (3, "long " * 50000, "s", "en", None, None)], schema)
    out = run(spark, docs, labels).collect()
    assert len(out) == 4 and all(abs(r.p_text - 0.5) < 1e-9 and isinstance(r.kept, bool) for r in out)
