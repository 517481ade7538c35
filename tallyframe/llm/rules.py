"""Quality rules: a ledger of failure bits, read by versioned policies.

Every rule is evaluated once per document.  The ledger keeps its measurements and
one failure bit per rule; a policy is a mask over the bits, so a policy can be
changed, compared or ablated without reading a text again.  Everything is column
expressions and grouped sums: no shuffle to build a ledger, one small one to
compare policies.

Edge cases: a NULL text has no words and measures 0 everywhere, as an empty one
does; both fail ``few_words``.  Repeated rows are judged one by one.  Columns of the
input that share a name with a ledger column are replaced by the ledger's.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"
NOT_UPPER = r"[^\p{Lu}]+"


@dataclass(frozen=True)
class Rule:
    """``fails`` reads measurement columns; ``bit`` is the rule's place in the ledger."""

    name: str
    bit: int
    fails: Column

    @property
    def mask(self) -> int:
        return 1 << self.bit


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: a document goes when it fails one of these rules."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule]) -> int:
        known = {r.name: r.mask for r in rules}
        return sum(known[n] for n in set(self.rules))


def default_rules() -> list[Rule]:
    """The rules of policy v1.  Bits are fixed: new rules get new bits."""
    c = F.col
    return [
        Rule("few_words", 0, c("n_words") < 50),
        Rule("repeated_words", 1, 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("symbols", 2, 10 * c("n_symbols") > c("n_words")),
        Rule("repeated_lines", 3, 2 * c("n_dup_lines") > c("n_lines")),
        Rule("short_or_long_words", 4, (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words"))),
        Rule("shouting", 5, 2 * c("n_upper") > c("word_chars")),
    ]


BASE = Policy("base", ("few_words", "repeated_words"))
V1 = Policy("v1", ("few_words", "repeated_words", "symbols", "repeated_lines", "short_or_long_words", "shouting"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_upper and n_repeat_words (all long) as further columns."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper", "n_repeat_words"]
    kept = [c for c in docs.columns if c.lower() not in names]
    words = F.array_remove(F.split(t, BLANK), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_BLANK))
    df = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        words.alias("__w"), lines.alias("__l"),
        F.length(F.regexp_replace(t, BLANK, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(t, NOT_UPPER, "")).cast("long").alias("n_upper"),
    )
    df = df.select(
        *[c for c in df.columns if c not in ("__w", "__l")],
        F.size("__w").cast("long").alias("n_words"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.transform("__w", lambda x: F.xxhash64(x)).alias("__h"),
    )
    # windows of three words as 64-bit codes
    h, m = F.col("__h"), F.greatest(F.size("__h") - 2, F.lit(0))
    two = F.zip_with(F.slice(h, 1, m), F.slice(h, 2, m), lambda a, b: a.bitwiseXOR(F.shiftleft(b, 1)))
    codes = F.zip_with(two, F.slice(h, 3, m), lambda a, b: a.bitwiseXOR(F.shiftleft(b, 2)))
    df = df.withColumn("__g", codes).drop("__h")
    # A window's place goes into the low bits of its code, so that one sort of plain
    # longs brings equal windows together; only texts with a repeated code need it.
    df = df.withColumn("__p2", F.expr("shiftleft(1L, length(bin(size(__g))))"))
    packed = F.transform("__g", lambda x, i: x.bitwiseAND(-F.col("__p2")).bitwiseOR(i.cast("long")))
    repeats = F.size("__g") > F.size(F.array_distinct("__g"))
    df = df.withColumn("__s", F.when(repeats, F.sort_array(packed))).drop("__g")
    s, n, low = F.col("__s"), F.size("__s"), F.col("__p2") - 1
    pairs = F.arrays_zip(F.slice(s, 1, n - 1).alias("p"), F.slice(s, 2, n - 1).alias("q"))
    twice = F.filter(pairs, lambda x: x["p"].bitwiseXOR(x["q"]).bitwiseAND(-F.col("__p2")) == 0)
    places = F.flatten(F.transform(twice, lambda x: F.array(x["p"].bitwiseAND(low), x["q"].bitwiseAND(low))))
    df = df.withColumn("__p", F.sort_array(F.array_distinct(places))).drop("__s", "__p2")
    # each repeated window covers three words, less where the next one starts sooner
    p, k = F.col("__p"), F.size("__p")
    steps = F.zip_with(F.slice(p, 1, k - 1), F.slice(p, 2, k - 1), lambda a, b: F.least(b - a, F.lit(3).cast("long")))
    covered = F.aggregate(steps, F.lit(3).cast("long"), lambda acc, x: acc + x)
    df = df.withColumn("n_repeat_words", F.coalesce(F.when(k > 0, covered), F.lit(0).cast("long"))).drop("__p")
    # One row in, one row out; but filters on a measurement stay above this step.  Pushed
    # below it, they would work out every array once for each time it is named.
    whole = F.explode(F.array(F.struct(*names))).alias("__m")
    return df.select(*[F.col(f"`{c}`") for c in kept], whole).select(*[F.col(f"`{c}`") for c in kept], "__m.*")


def ledger(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """docs with measurements and ``fail_bits``, a long with one bit per rule."""
    rules = default_rules() if rules is None else rules
    out = measure(docs, text)
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(r.fails, F.lit(r.mask)).otherwise(F.lit(0)).cast("long"))
    return out.withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, policy: Policy, rules: Sequence[Rule] | None = None, name: str = "kept") -> DataFrame:
    """The ledger with the verdict of one policy as a boolean column."""
    mask = policy.mask(default_rules() if rules is None else rules)
    return book.withColumn(name, F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")) == 0)


def ablation(book: DataFrame, policy: Policy, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail nothing else (``n_only``:
    those come back when the rule is left out), and that the policy without it removes.

    Documents are first counted by bit pattern, so at most 2^rules rows go further.
    """
    rules = default_rules() if rules is None else rules
    mask = policy.mask(rules)
    seen = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask"))
                     for r in rules if r.mask & mask])
    x = seen.select("bits", "n", F.explode(each).alias("r")).select("bits", "n", "r.rule", "r.mask")
    hit = x.bits.bitwiseAND(x.mask) != 0
    zero = F.lit(0).cast("long")
    return x.groupBy("rule").agg(
        F.sum(F.when(hit, x.n).otherwise(zero)).alias("n_failed"),
        F.sum(F.when(x.bits == x.mask, x.n).otherwise(zero)).alias("n_only"),
        F.sum(F.when(x.bits.bitwiseAND(F.bitwise_not(x.mask)) != 0, x.n).otherwise(zero)).alias("n_removed_without"),
    )
