import zlib

import numpy as np
import pyarrow as pa

from tallyframe.llm import langid


def test_held_out_accuracy_and_calibration(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in df.collect()}
    rows = langid.predict(df, langid.fit(df)).collect()
    assert len(rows) == len(truth)
    test = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in test]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and np.mean([r.rejected for r in test]) < 0.1


def test_long_text_in_parts_scores_as_a_whole(monkeypatch):
    texts = ["abc de fg " * 500, "le la les été " * 300, "x", ""]
    model = langid.train(texts[:2] * 10, np.array([0, 1] * 10), ("a", "b"))
    whole = model.logits(pa.array(texts))
    monkeypatch.setattr(langid, "PART", 700)
    assert np.allclose(whole, model.logits(pa.array(texts)), rtol=0.01)  # seven blanks in 700 bytes


def test_edges(spark):
    docs = [(i, ("bonjour le monde " if i % 2 else "hello the world ") * 20, "fr" if i % 2 else "en", 1) for i in range(60)]
    odd = [(100, None, "en", 1), (101, "", "en", 1), (102, "12 #! \n", "fr", 1), (103, "THE HELLO World world the", None, 1), (None, "bonjour le monde", "fr", 1), docs[0]]
    df = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, score int").repartition(3)
    got = langid.predict(df, langid.fit(df)).collect()
    assert len(got) == 66
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (100, 101, 102))
    assert by[103].lang_pred == "en" and by[None].lang_pred == "fr" and by[None].held_out
    assert all(by[i].lang_pred == ("fr" if i % 2 else "en") for i in range(60))
    none = df.where("lang = 'xx'")
    assert langid.predict(none, langid.fit(none)).count() == 0
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}
