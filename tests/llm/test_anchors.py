import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm import anchors
from tallyframe.session import materialize

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
ODD = ["", " ", "   ", "a", " a", "a ", "two  blanks   here", "tab\tline\nend\r\n", "日本語 ☃ émigré 🙂🙂 ﬁ İ", f"a {SPACE} mark", f"{SPACE}x",
       "\x00 nul", "<|endoftext|> <s> </s> <unk> <0x41>", "x" * 700, "1234567890 don't I'LL", "a b c\x1cd \x85e", "In. " * 400]


def brute(texts):
    """Everything by the libraries and plain loops, document by document."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for b in range(256):
        letters[chr(b) if b in shown else chr(256 + sum(x not in shown for x in range(b)))] = b
    out, held = [], Counter()
    for t in texts:
        groups = []
        if t:
            raw = (" " + t).encode()
            ids = tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
            said = [[bytes(letters[c] for c in tok.id_to_token(i)) for i in ids[0]],
                    [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in ids[1]]]
            if all(b"".join(s) == raw for s in said):
                cuts = []
                for s in said:
                    at, ends = 0, []
                    for x in s:
                        at += len(x)
                        ends.append(at)
                    cuts.append(ends)
                both = sorted(set(cuts[0]) & set(cuts[1]))
                groups = [([], []) for _ in both]
                for n in (0, 1):
                    for i, e in zip(ids[n], cuts[n]):
                        groups[bisect_left(both, e)][n].append(i)
        links = Counter((a, b) for x, y in groups for a in x for b in y)
        held.update(links.keys())
        out.append((groups, links))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    rows = []
    for groups, links in out:
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
                     sum(n for p, n in links.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in links.items()),
                     hashlib.sha256(s.encode()).hexdigest() if groups else ""))
    return rows, held


def read(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def sample(spark):
    rnd = random.Random(1)
    got = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    mixed = ["".join(rnd.choice("abetionrsh é., \n日") for _ in range(150)) for _ in range(40)]
    return [None, *ODD, *got[:60], *mixed, got[0], got[0]]


def test_equal_to_brute_force(spark):
    texts = sample(spark)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want, held = brute(texts)
    assert read(anchors.link(df, A, B)) == dict(enumerate(want))
    counts = anchors.pair_counts(materialize(anchors.align(df, A, B)), B).collect()
    assert {(r.a_id, r.b_id): r.documents for r in counts} == dict(held)
    assert sum(not w[-1] for w in want) >= 4  # texts that have no tokens


def test_small_memory_long_texts_and_rare_pairs_by_a_join(spark, monkeypatch):
    texts = sample(spark)[:45]
    want, held = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for name, value in (("KNOWN_WINDOWS", 50), ("PART", 40), ("SLICE", 20_000), ("HEADS", len(held) // 3), ("LARGE", 1)):
        monkeypatch.setattr(anchors, name, value)
    code = anchors.parts("a b  c d e", 1)
    assert code == ["a", "b  c", "d", "e"] and " ".join(code) == "a b  c d e"
    aligned = materialize(anchors.align(df, A, B))
    head, tail = anchors.heads(anchors.pair_counts(aligned, B), anchors.HEADS)
    assert 0 < head.count() <= anchors.HEADS and head.count() + tail.count() == len(held)
    assert read(anchors.link(df, A, B)) == dict(enumerate(want))


def test_edges(spark):
    rows = [(None, "no id", "x"), (4, "twice", "x"), (4, "twice", "x"), (5, "very long " * 30000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumn("pairs", F.lit(1)).withColumn("key", F.lit(2))
    got = anchors.link(df, A, B).collect()
    want, _ = brute([r[1] for r in rows])
    assert sorted(((r.doc_id or -1), r.n_a, r.n_links, r.count_sum) for r in got) == sorted((k or -1, w[0], w[3], w[5]) for (k, _, _), w in zip(rows, want))
    assert anchors.link(df.limit(0), A, B).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert set(read(anchors.link(nothing, A, B)).values()) == {(0, 0, 0, 0, 0, 0, "")}
    shown = anchors.align(df.where("doc_id = 4"), A, B, groups=True).first()
    assert hashlib.sha256(shown.groups.encode()).hexdigest() == shown.groups_sha256
