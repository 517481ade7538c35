"""Rule ledger against a plain Python reading of the definitions."""

import re
from collections import Counter

import pytest

from tallyframe.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = list(zip(words, words[1:], words[2:]))
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " \t\n", "a", "a b", "a b c", "a a a a a", "x y z x y z x y z", "a b c a b d a b c",
    "# one | two <b>\n# one | two <b>\n\n \n", "line\nline\nother\r\nother\r\n", " nbsp word ünï 日本語\x0bv\x0cf",
    "A" * 3000 + " b", " ".join(["In."] * 5000), "w " * 60 + "\n" + " ".join(f"t{i}" for i in range(200)),
    "\n".join(["same line of words here"] * 30), "MANY LOUD WORDS " * 20,
]


def test_measures(spark):
    rows = [(i, t, "x", 5) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x", 5), (None, "a b c a b c", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Words string, fail_bits int")
    out = rules.apply_policy(rules.ledger(df), rules.V1).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert bool(r.fail_bits & 3) == base and not (base and r.kept)


def test_real_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in rules.measure(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)


def test_empty_table_and_ablation(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rules.ledger(none).count() == 0 and rules.ablation(rules.ledger(none), rules.V1).count() == 0
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    book = [r.fail_bits for r in rules.ledger(df).collect()]
    for r in rules.ablation(rules.ledger(df), rules.V1).collect():
        bit = next(x.mask for x in rules.default_rules() if x.name == r.rule)
        assert r.n_failed == sum(bool(b & bit) for b in book)
        assert r.n_only == sum(b == bit for b in book)
        assert r.n_removed_without == sum(bool(b & ~bit) for b in book)


def test_unknown_rule_is_an_error(spark):
    with pytest.raises(KeyError):
        rules.Policy("x", ("nothing",)).mask(rules.default_rules())
