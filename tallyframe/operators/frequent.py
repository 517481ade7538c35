"""Most frequent values of many columns without shuffling their values.

One job sketches all columns at once: a bounded frequent-items sketch gives candidates
and a bound on the count of any other value.  A second job counts the candidates
exactly.  What the bound leaves open, for a column of many values none of which stands
out, is settled by counting that column alone, with partial counts in the tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000
TOP = 8
# Share of all rows that a value may have without showing up as a candidate: twice the
# sketch's error, 3.5 over its table of the next power of two of TRACKED / 0.75.
UNSEEN = 2 * 3.5 / 2 ** math.ceil(math.log2(TRACKED / 0.75))
ERROR = 0.02


@dataclass
class Frequent:
    """A column's known rows, about how many distinct values, exact counts of candidates
    (largest first), and what any other value's count cannot exceed."""

    known: int
    distinct: int
    counts: list[int]
    values: list
    bound: int


def candidates(df: DataFrame, cols: list[str], skip=lambda known, distinct: False) -> dict[str, Frequent]:
    """Frequent values of columns; those for which ``skip`` says so after the first job
    (by known rows and about how many distinct values) get no counts."""
    if not cols:
        return {}
    first = df.agg(F.count("*").alias("__n"), *[F.struct(
        F.count(c).alias("n"), F.approx_count_distinct(c, ERROR).alias("u"),
        F.call_function("approx_top_k", F.col(c), F.lit(TOP + 1), F.lit(TRACKED)).alias("t")).alias(c) for c in cols]).first()
    out, todo = {}, {}
    for c in cols:
        items = [(x["item"], x["count"]) for x in first[c]["t"] if x["item"] is not None]
        # beyond the list a value may be as frequent as the last one on it
        bound = max(items[-1][1] if len(first[c]["t"]) > TOP else 0, math.ceil(UNSEEN * first["__n"]))
        out[c] = Frequent(first[c]["n"], first[c]["u"], [], [x for x, _ in items[:TOP]], bound)
        if out[c].values and not skip(out[c].known, out[c].distinct):
            todo[c] = out[c]
    if todo:
        row = df.agg(*[F.array(*[F.count_if(F.col(c) == F.lit(v)) for v in f.values]).alias(c) for c, f in todo.items()]).first()
        for c, f in todo.items():
            order = sorted(zip(row[c], f.values), key=lambda x: -x[0])
            f.counts, f.values = [n for n, _ in order], [v for _, v in order]
    return out


def exact_two(df: DataFrame, col: str) -> tuple[list[int], int]:
    """The two largest counts of a column and its number of distinct values."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("__c")).persist()
    try:
        two = [r["__c"] for r in counts.select("__c").orderBy(F.desc("__c")).limit(2).collect()]
        return two, counts.count()
    finally:
        counts.unpersist()


def near_zero_variance(df: DataFrame, cols: list[str], freq_cut: float, unique_cut: float) -> list[str]:
    """Columns whose most frequent value is over freq_cut times as frequent as the second
    and that have fewer than unique_cut distinct values per hundred known rows."""
    slack = 8 * ERROR

    def many(known: int, distinct: int) -> bool:
        """Surely too many distinct values: the column stays whatever its counts are."""
        return known > 0 and 100.0 * distinct / known > unique_cut * (1 + slack)

    gone = []
    for c, f in candidates(df, cols, many).items():
        if not f.known or many(f.known, f.distinct):
            continue
        one, two = [*f.counts, 0, 0][:2]
        few = 100.0 * f.distinct / f.known < unique_cut * (1 - slack)
        surely = one == f.known or (one > f.bound and one > freq_cut * max(two, f.bound))
        never = one > f.bound and two > 0 and one <= freq_cut * two
        if never:
            continue
        if not (few and surely):  # too close for the bounds
            counts, distinct = exact_two(df, c)
            one, two = [*counts, 0][:2]
            if not ((two == 0 or one > freq_cut * two) and 100.0 * distinct / f.known < unique_cut):
                continue
        gone.append(c)
    return gone
