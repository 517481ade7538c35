import random
import zlib

import public_tokenizers
import sentencepiece

from tallyframe.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "   ", "a", " a", "a ", "two  blanks   here", "tab\tline\nend\r\n", "▁ mark▁▁x ▁", "日本語 ☃ émigré 🙂🙂", "\x00 nul",
       "aaaaaaaaaaaaaaaa aaaa", "In. " * 300, "x" * 500, "http://a.b/c?d=e&f=1234567890", "<s> </s> <unk> <0x41>", "ﬁ İ ß́ ﻿"]


def library(unigram=False):
    """The library itself; its model file says by one byte that it is BPE (2) or unigram (1)."""
    raw = bytearray(open(PATH, "rb").read())
    if unigram:
        at = raw.index(b"tok_v0") + len(b"tok_v0")
        assert raw[at:at + 2] == b"\x18\x02"
        raw[at + 1] = 1
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(raw))


def texts(spark):
    got = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rnd = random.Random(1)
    return ODD + got + ["".join(rnd.choice("abetionrsh é.,") for _ in range(200)) for _ in range(50)]


def test_both_encodings_equal_the_library(spark):
    rows = [(i, t) for i, t in enumerate(texts(spark))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pieces.decode(pieces.encode(df, PATH), PATH).collect()}
    bpe = library()
    for i, t in rows:
        assert got[i].ids == bpe.encode(t), t
        assert got[i].decoded == bpe.decode(got[i].ids) == t.replace("▁", " ")


def test_viterbi_reaches_the_best_sum_of_scores(spark):
    uni, model = library(unigram=True), pieces.Model(PATH)
    words = {w for t in texts(spark)[len(ODD):80] for w in t.split()} | {"aaaaaaaaaaaa", "2024", "internationalization", "the"}
    got = model.words(["▁" + w for w in words])
    for w in sorted(words)[::5]:
        _, path, score = got["▁" + w]
        best = uni.nbest_encode_as_ids(w, 2)[0]  # by the library's lattice; its short cut may miss the best
        if model.piece.keys() >= set(w):
            assert score == sum(model.score[i] for i in path) == sum(model.score[i] for i in best), w


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 20)
    rows = [(1, None, "x"), (2, "", "x"), (None, "no id", "x"), (4, "twice", "x"), (4, "twice", "x"), (5, "very long " * 20000, "x")]
    rows += [(10 + i, f"word{i} other{i}", "x") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces.decode(pieces.encode(df, PATH), PATH).collect()
    assert sorted((r.doc_id or -1, r.text or "", r.decoded or "") for r in got) == sorted((k or -1, t or "", t or "") for k, t, _ in rows)
    assert [r.ids for r in got if r.doc_id == 1] == [None] and [r.ids for r in got if r.doc_id == 2] == [[]]
    assert pieces.encode(df.limit(0), PATH).count() == 0
    sums = {(r.doc_id, r.n_pieces) for r in pieces.summary(df, PATH).collect() if r.round_trip}
    assert sums == {(r.doc_id, None if r.ids is None else len(r.ids)) for r in got}


def test_summary_is_that_of_the_ids(spark):
    rows = [(i, t) for i, t in enumerate([*texts(spark)[:80], None])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    crc = lambda ids: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    coded = {r.doc_id: r for r in pieces.encode(df, PATH).collect()}
    for r in pieces.summary(df, PATH).collect():
        c = coded[r.doc_id]
        if c.ids is None:
            assert (r.n_pieces, r.ids_crc32, r.round_trip) == (None, None, True)
        else:
            assert (r.n_pieces, r.ids_crc32, r.n_viterbi, r.viterbi_crc32) == (len(c.ids), crc(c.ids), len(c.viterbi_ids), crc(c.viterbi_ids))
            assert r.round_trip and r.viterbi_score == int(c.viterbi_score)
