import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyframe.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def verify(rows, texts, key="doc_id"):
    """rows cover every id of every text once, and sequences have no holes."""
    tok = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for k, t in texts:
        want[k].append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r[key]].append(r)
        seqs[r.sequence_id].append(r)
    assert set(pieces) == set(want)
    for k, docs in want.items():
        if len(docs) > 1:  # repeated rows: all ids so many times
            assert sum(r.length for r in pieces[k]) == sum(map(len, docs))
            continue
        at, ids = 0, docs[0]
        for r in sorted(pieces[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at == s[0].sequence_tokens
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding


def test_round_trip_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    rows = packing.pack(df, PATH).collect()
    assert verify(rows, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]) == 0
    groups = defaultdict(int)
    for r in rows:
        groups[r.step_group] += r.length
    assert max(groups.values()) <= packing.GROUP_TOKENS


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    odd = "I'LL go, İ! (a)! ok!! Ünï.. ÉCOLE, <|ENDOFTEXT|>. x<|endoftext|>. i̇. E\u0301! 3.14, a\u0301. don't! Straße. ΣΑΣ é é <|endoftext|>x <|startoftext|> \x0b\x0c\r\n 日本語 don't 12 #!"
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, odd), (5, "word " * 30000), (None, "none"), (7, "twice"), (7, "twice"),
             *[(100 + i, "some words " * (i * 7)) for i in range(40)]]
    df = spark.createDataFrame([(k, t, "x") for k, t in texts], "doc_id long, text string, start string").repartition(2)
    assert verify(packing.pack(df, PATH).collect(), texts) == 0
    assert packing.pack(df.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, PATH, tiers=(3000,))
