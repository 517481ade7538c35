"""Every operator over a table whose extra columns are named like its own ones."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import (
    anchors, annpartition, chains, dartminhash, dualtree, langid, packing, pareto, pieces, quotes, rules, sitequality, suffix,
)

WORDS, PIECES, BYTES = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"))
NAMES = ["n", "k", "h", "c", "x", "id", "key", "row", "node", "good", "prior", "strength", "share", "label", "total", "rank", "score", "part",
         "size", "target", "taken", "copies", "pairs", "times", "term", "tf", "salt", "item", "class_id", "spans", "words", "start", "length",
         "ids", "kept", "n_words", "n_bytes", "lang_pred", "held_out", "anchor", "ctx", "value", "weight", "depth", "root", "position"]


def clashing(df):
    return df.select("*", *[F.lit(f"extra {n}").alias(n) for n in NAMES if n not in df.columns])


@pytest.fixture(scope="module")
def docs(spark):
    long = "some words of a text that stands in more than one place and goes on for a while, "
    rows = [(i, f"{long * 8} number {i} {'ab cd ' * i}", "en" if i % 2 else "de", f"s{i % 3}", 10) for i in range(24)] + [(30, None, None, None, None)]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


OPERATORS = {
    "rules": lambda d, s: rules.apply_policy(rules.ledger(d), rules.V1),
    "packing": lambda d, s: packing.pack(d, WORDS),
    "pieces": lambda d, s: pieces.summary(d, PIECES),
    "dartminhash": lambda d, s: dartminhash.near_duplicates(d),
    "keep_one": lambda d, s: dartminhash.keep_one(d),
    "suffix": lambda d, s: suffix.remove(d, 100),
    "chains": lambda d, s: chains.mark(d),
    "langid": lambda d, s: langid.predict(d, langid.fit(d)),
    "sitequality": lambda d, s: sitequality.classify(d, sitequality.fit(sitequality.features(d), s.createDataFrame(
        [(i, i % 2) for i in range(24)], "doc_id long, quality int")), ["source", "lang"]),
    "dualtree": lambda d, s: dualtree.rank(d, clashing(s.createDataFrame([(1, "words number")], "item_id long, text string"))),
    "pareto": lambda d, s: pareto.mix(d),
    "anchors": lambda d, s: anchors.link(d, BYTES, PIECES),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(spark, docs, name):
    assert OPERATORS[name](docs, spark).count() > 0


def test_vectors_and_conversations(spark):
    vectors = clashing(spark.createDataFrame([(i, [1.0 * i, 1.0]) for i in range(1, 41)], "vec_id long, embedding array<double>"))
    assert annpartition.nearest(vectors, vectors.where("vec_id % 20 = 0"), 3).count() == 6
    talk = clashing(spark.createDataFrame([(1, 0, "user", "hello there"), (1, 1, "user", "> hello there\nyes")], "conv_id long, turn long, role string, text string"))
    assert quotes.link(talk).count() == 2
