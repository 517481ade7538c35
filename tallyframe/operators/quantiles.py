"""Exact order statistics without holding a column's values in one task.

A bounded sketch (``percentile_approx``) brackets every wanted rank.  A second
pass counts rows below each bracket and the distinct values inside it; ranks
are then exact.  When the brackets could still hold too many rows, further
passes cut them finer first.  Rows far from a wanted rank never move.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import State

ACCURACY = 10_000
MARGIN = 2.5 / ACCURACY
WHOLE = 20_000          # columns or groups up to this many rows need no bracket
INSIDE_LIMIT = 1_000_000
HELD = 500_000          # values inside brackets that a task keeps before it joins equal ones
GRID = 100
RANKED = 100_000        # values of one bracket of one group that one task may rank
BIG = math.nextafter(sys.float_info.max, 0.0)


def type7_ranks(n: int, p: float) -> tuple[int, int, float]:
    """0-based lower and upper rank and the interpolation weight."""
    h = (n - 1) * p
    lo = math.floor(h + 1e-9)
    return lo, min(lo + 1, n - 1), max(h - lo, 0.0)


def _known(x: Column) -> Column:
    """x as a finite double: NaN counts as missing, infinities as the largest values."""
    x = x.cast("double")
    return F.when(F.isnan(x), F.lit(None)).when(x > BIG, BIG).when(x < -BIG, -BIG).otherwise(x)


def order_statistics(df: DataFrame, asked: dict, means: dict | None = None) -> dict[str, dict[int, float]]:
    """Exact values at 0-based ranks of the non-NULL values of several columns.

    ``asked`` maps a column to (probabilities near its ranks, function from row
    count to ranks), so counts and sketches of all columns come from one job.  A dict
    given as ``means`` gets the columns' means from the same job.
    """
    cols = list(asked)
    data = df.select(*[_known(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)], *[F.col(c).alias(f"m{i}") for i, c in enumerate(cols) if means is not None])
    near = {
        i: [min(max(p + d, 0.0), 1.0) for p in asked[c][0] for d in (-MARGIN, MARGIN)]
        for i, c in enumerate(cols)
    }
    first = data.agg(*[
        F.struct(
            F.count(f"c{i}").alias("n"), F.min(f"c{i}").alias("mn"), F.max(f"c{i}").alias("mx"),
            F.percentile_approx(f"c{i}", near[i], ACCURACY).alias("cuts"),
        ).alias(f"c{i}")
        for i in range(len(cols))
    ], *[F.avg(f"m{i}").alias(f"m{i}") for i in range(len(cols)) if means is not None]).first()
    if means is not None:
        means.update({c: first[f"m{i}"] for i, c in enumerate(cols)})
    want, brackets, inside = {}, {}, 0
    for i, c in enumerate(cols):
        n, cuts = first[i]["n"], first[i]["cuts"]
        want[i] = sorted({min(max(r, 0), n - 1) for r in asked[c][1](n)})
        if not n:
            continue
        if n <= WHOLE:
            brackets[i] = [(first[i]["mn"], first[i]["mx"])]
            inside += n
            continue
        pairs = zip(near[i][::2], near[i][1::2], cuts[::2], cuts[1::2])
        brackets[i] = _disjoint([
            (first[i]["mn"] if p <= 0.0 else lo, first[i]["mx"] if q >= 1.0 else hi) for p, q, lo, hi in pairs
        ])
        inside += int(n * 4 * MARGIN * len(asked[c][0]))
    while inside > INSIDE_LIMIT:
        brackets, smaller = _refine(data, want, brackets)
        if smaller >= inside:
            break
        inside = smaller
    counted = _count_regions(data, brackets)
    return {c: _pick(want[i], counted.get(i, [])) for i, c in enumerate(cols)}


def _disjoint(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _refine(data: DataFrame, want, brackets):
    """Replace each bracket by the finer one that still covers its ranks.  A row is looked
    up among the brackets of its column once, and sketched with the rows of its own only."""
    grid = [k / GRID for k in range(GRID + 1)]
    # from 0: below, then of each bracket its low end, what lies within, the rest up to the next
    edges = {i: np.array([e for lo, hi in spans for e in (lo, math.nextafter(lo, math.inf), max(hi, math.nextafter(lo, math.inf)))])
             for i, spans in brackets.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = {i: np.zeros(len(e) + 1, np.int64) for i, e in edges.items()}

        def rows(i, region, x, n):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(region), i, np.int32)), pa.array(region.astype(np.int32)), x, pa.array(n)],
                                              names=["i", "region", "x", "n"])

        for batch in batches:
            for n, (i, e) in enumerate(edges.items()):
                x = batch.column(n).drop_null().to_numpy()
                region = np.searchsorted(e, x, side="right")
                within = region % 3 == 2
                passed[i] += np.bincount(region[~within], minlength=len(e) + 1)
                if within.any():
                    yield rows(i, region[within], pa.array(x[within]), np.ones(within.sum(), np.int64))
        for i, n in passed.items():
            yield rows(i, np.arange(len(n)), pa.nulls(len(n), pa.float64()), n)

    part = data.select(*[f"c{i}" for i in brackets]).mapInArrow(run, "i int, region int, x double, n long")
    met = part.groupBy("i", "region").agg(F.sum("n").alias("n"), F.percentile_approx("x", grid, ACCURACY).alias("cuts")).collect()
    counts = {i: np.zeros(len(e) + 1, np.int64) for i, e in edges.items()}
    cuts = {}
    for r in met:
        counts[r["i"]][r["region"]] = r["n"]
        cuts[r["i"], r["region"]] = r["cuts"]
    where = []
    for i, spans in brackets.items():
        upto = np.cumsum(counts[i])
        for j, (lo, hi) in enumerate(spans):
            where.append((i, lo, hi, {"below": int(upto[3 * j]), "at_lo": int(counts[i][3 * j + 1]), "n": int(counts[i][3 * j + 2]), "cuts": cuts.get((i, 3 * j + 2))}))
    out: dict[int, list] = {i: [] for i in brackets}
    inside = 0
    for i, lo, hi, got in where:
        base, n = got["below"] + got["at_lo"], got["n"]
        for r in want[i]:
            if got["below"] <= r < base:
                out[i].append((lo, lo))
            elif base <= r < base + n:
                a = max(math.floor(((r - base) / n - MARGIN) * GRID), 0)
                b = min(math.ceil(((r - base + 1) / n + MARGIN) * GRID), GRID)
                out[i].append((got["cuts"][a], got["cuts"][b]))
                inside += int(n * ((b - a) / GRID + 2 * MARGIN)) + 1
            elif r >= base + n:
                out[i].append((hi, hi))
    return {i: _disjoint(s) for i, s in out.items() if s}, inside


def _count_regions(data: DataFrame, brackets) -> dict[int, list]:
    """Per column its rows by region: 0, 2, 4… between the brackets and 1, 3, 5… inside
    them, there value by value.  Tasks count where the rows lie; a row leaves its task
    only as a value inside a bracket, and equal ones together."""
    if not brackets:
        return {}
    edges = {i: np.array([e for lo, hi in spans for e in (lo, math.nextafter(hi, math.inf))]) for i, spans in brackets.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = {i: np.zeros(len(e) + 1, np.int64) for i, e in edges.items()}
        held: dict[int, list] = {i: [] for i in edges}
        size = dict.fromkeys(edges, 0)

        def rows(i):
            got = np.concatenate([np.zeros((2, 0)), *held[i]], axis=1)
            x, where = np.unique(got[0], return_inverse=True)
            return np.stack([x, np.bincount(where, got[1], len(x))])

        for batch in batches:
            for n, (i, e) in enumerate(edges.items()):
                x = batch.column(n).drop_null().to_numpy()
                region = np.searchsorted(e, x, side="right")
                passed[i] += np.bincount(region, minlength=len(e) + 1)
                x = x[region % 2 == 1]
                if len(x):
                    held[i].append(np.stack([x, np.ones(len(x))]))
                    size[i] += len(x)
                if size[i] > HELD:
                    held[i] = [rows(i)]
                    size[i] = 0
        for i, e in edges.items():
            x, n = rows(i)
            outside = np.arange(0, len(e) + 1, 2)
            region = np.concatenate([outside, np.searchsorted(e, x, side="right")])
            value = pa.array(np.concatenate([np.zeros(len(outside)), x]), mask=np.arange(len(region)) < len(outside))
            counts = np.concatenate([passed[i][outside], n.astype(np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(region), i, np.int32)), pa.array(region.astype(np.int32)), value, pa.array(counts)],
                                             names=["i", "region", "x", "n"])

    part = data.select(*[f"c{i}" for i in brackets]).mapInArrow(run, "i int, region int, x double, n long")
    got = part.where("n > 0").groupBy("i", "region", "x").agg(F.sum("n").alias("n")).collect()
    out: dict[int, list] = {}
    for r in got:
        out.setdefault(r["i"], []).append((r["region"], r["x"], r["n"]))
    for v in out.values():
        v.sort(key=lambda t: (t[0], t[1] is not None, t[1] or 0.0))
    return out


def _pick(want: list[int], counted: list) -> dict[int, float]:
    out, seen, it = {}, 0, iter(want)
    r = next(it, None)
    for _, x, n in counted:
        while r is not None and r < seen + n:
            if x is None:
                raise RuntimeError("rank fell outside its bracket")
            out[r] = x if abs(x) < BIG else math.copysign(math.inf, x)
            r = next(it, None)
        seen += n
    return out


def quantiles(df: DataFrame, cols, probs, means: dict | None = None) -> dict[str, list[float | None]]:
    """Exact type-7 quantiles of whole columns; ``means`` as in order_statistics."""
    counts: dict[str, int] = {}

    def ranks_for(c):
        def ranks(n):
            counts[c] = n
            return [r for p in probs for r in type7_ranks(n, p)[:2]] if n else []
        return ranks

    stats = order_statistics(df, {c: (probs, ranks_for(c)) for c in cols}, means)
    out = {}
    for c in cols:
        out[c] = []
        for p in probs:
            if not counts[c]:
                out[c].append(None)
                continue
            lo, hi, w = type7_ranks(counts[c], p)
            a, b = stats[c][lo], stats[c][hi]
            out[c].append(a if w == 0.0 or a == b else a + w * (b - a))
    return out


def group_brackets(df: DataFrame, by: list[str], col: str, probs: list[float]) -> State:
    """Per group its known rows __n and, for each probability, values __lo<j> and __hi<j>
    that enclose its ranks.  A bracket that may hold more than RANKED rows is cut finer,
    by a sketch of its own rows, until none does.  Groups without known rows have NULLs."""
    x, k = F.col("__x"), len(probs)
    base = df.select(*by, _known(F.col(col)).alias("__x"))
    asked = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-MARGIN, MARGIN)]
    n, whole = F.col("__n"), F.col("__n") <= WHOLE
    sketch = base.groupBy(*by).agg(
        F.count(x).alias("__n"), F.min(x).alias("__mn"), F.max(x).alias("__mx"),
        F.percentile_approx(x, asked, ACCURACY).alias("__cuts"))
    cells = []
    for j, p in enumerate(probs):
        ends = [F.when(whole | F.lit(edge), F.col(end)).otherwise(F.col("__cuts")[2 * j + m])
                for m, (end, edge) in enumerate((("__mn", asked[2 * j] <= 0.0), ("__mx", asked[2 * j + 1] >= 1.0)))]
        held = F.when(whole | (ends[0] == ends[1]), 0).otherwise(n * (4 * MARGIN))
        cells += [ends[0].alias(f"__lo{j}"), ends[1].alias(f"__hi{j}"), held.cast("double").alias(f"__in{j}")]
    state = State(sketch.select(*by, "__n", *cells), by)
    grid = [i / GRID for i in range(GRID + 1)]
    inside = None
    while True:
        most = state.largest(*[f"__in{j}" for j in range(k)])
        if most <= RANKED or (inside is not None and most >= inside):
            return state
        inside = most
        # only brackets that are still too wide are counted again
        wide = [F.col(f"__in{j}") > RANKED for j in range(k)]
        some = wide[0]
        for w in wide[1:]:
            some = some | w
        rows = State(state.df.where(some), by).attach(base, how="inner")
        aggs = []
        for j in range(k):
            lo, hi = F.col(f"__lo{j}"), F.col(f"__hi{j}")
            open_x = F.when(wide[j] & (x > lo) & (x < hi), x)
            aggs += [F.count_if(x <= lo).alias(f"__base{j}"), F.count_if(x < lo).alias(f"__below{j}"), F.count(open_x).alias(f"__m{j}"),
                     F.percentile_approx(open_x, grid, ACCURACY).alias(f"__g{j}")]
        got = rows.groupBy(*by).agg(*aggs)
        got = got.select(*[F.col(b).alias(f"__k_{b}") for b in by], *[c for c in got.columns if c not in by])
        new = state.df.join(got, [F.col(b).eqNullSafe(F.col(f"__k_{b}")) for b in by], "left")
        cells = []
        for j, p in enumerate(probs):
            m, start, cuts = F.col(f"__m{j}"), F.col(f"__base{j}"), F.col(f"__g{j}")
            lo, hi = F.col(f"__lo{j}"), F.col(f"__hi{j}")
            first = F.floor((n - 1) * float(p) + 1e-9)
            last = F.least(first + 1, n - 1)
            i = F.greatest(F.floor(((first - start) / m - MARGIN) * GRID), F.lit(0)).cast("int")
            o = F.least(F.ceil(((last - start + 1) / m + MARGIN) * GRID), F.lit(GRID)).cast("int")
            redo = wide[j] & (m > 0)
            low = F.when(first < start, lo).when(first >= start + m, hi).otherwise(F.get(cuts, i))
            high = F.when(last < start, lo).when(last >= start + m, hi).otherwise(F.get(cuts, o))
            held = F.when(low == high, 0.0).otherwise(m * ((o - i) / GRID + 2 * MARGIN) + 1)
            cells += [F.when(redo, low).otherwise(lo).alias(f"__lo{j}"), F.when(redo, high).otherwise(hi).alias(f"__hi{j}"),
                      F.when(redo, held).otherwise(F.when(wide[j], 0.0).otherwise(F.col(f"__in{j}"))).alias(f"__in{j}")]
        state = State(new.select(*by, "__n", *cells), by)


def grouped_quantiles(df: DataFrame, by: list[str], col: str, probs: list[float],
                      names: list[str], count: str | None = None) -> DataFrame:
    """Exact type-7 quantiles per group as one row per group; ``count`` adds known rows.

    Groups may be of any size: rows are counted where they lie, and only the distinct
    values inside a group's brackets, about RANKED each at most, are ranked together.
    A group in which nothing is known has a row of NULLs.
    """
    x, v, k = F.col("__x"), F.col("__v"), len(probs)
    brackets = group_brackets(df, by, col, probs)
    rows = brackets.attach(df.select(*by, _known(F.col(col)).alias("__x")))
    inside, below = F.lit(False), []
    for j in range(k):
        lo, hi = F.col(f"__lo{j}"), F.col(f"__hi{j}")
        inside = inside | x.between(lo, hi)
        below.append(F.count_if(x < lo).alias(f"__b{j}"))
    # rows outside all brackets are one row of counts a group
    counted = rows.groupBy(*by, F.when(inside, x).alias("__v")).agg(
        F.count(x).alias("__c"), F.max("__n").alias("__n"), *[F.max(f"__lo{j}").alias(f"__lo{j}") for j in range(k)], *below)
    group = Window.partitionBy(*by)
    upto = group.orderBy(v.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ends = [F.sum(f"__b{j}").over(group) + F.sum(F.when(v >= F.col(f"__lo{j}"), F.col("__c")).otherwise(0)).over(upto) for j in range(k)]
    placed = counted.withColumns({f"__end{j}": e for j, e in enumerate(ends)})

    def at(j, rank):
        end = F.col(f"__end{j}")
        return F.max(F.when((end - F.col("__c") <= rank) & (rank < end) & (v >= F.col(f"__lo{j}")), v))

    out = [F.max("__n").alias(count)] if count else []
    for j, (p, nm) in enumerate(zip(probs, names)):
        h = (F.col("__n") - 1) * float(p)
        lo = F.floor(h + 1e-9)
        a, b = at(j, lo), at(j, F.least(lo + 1, F.col("__n") - 1))
        out.append((a + F.max(F.greatest(h - lo, F.lit(0.0))) * (b - a)).alias(nm))
    return placed.groupBy(*by).agg(*out)


def median(df: DataFrame, col: str) -> float | None:
    return quantiles(df, [col], [0.5])[col][0]


def trimmed_mean(df: DataFrame, col: str, trim: float = 0.1) -> float | None:
    """Mean without the floor(n·trim) smallest and largest values."""
    size = {}

    def ranks(n):
        size["n"] = n
        k = int(n * trim)
        return [k, n - 1 - k] if n else []

    got = order_statistics(df, {col: ([trim, 1.0 - trim], ranks)})[col]
    n = size["n"]
    if not n:
        return None
    k = int(n * trim)
    lo, hi = got[k], got[n - 1 - k]
    if lo == hi:
        return lo
    x = F.col(col).cast("double")
    row = df.agg(
        F.sum(F.when((x > lo) & (x < hi), x)).alias("s"),
        F.count_if(x <= lo).alias("le"), F.count_if(x >= hi).alias("ge"),
    ).first()
    total = (row["s"] or 0.0) + lo * (row["le"] - k) + hi * (row["ge"] - k)
    return total / (n - 2 * k)
