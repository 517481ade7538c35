"""Projection, filter, join, reshape and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import State, anti_join


# ── projection ───────────────────────────────────────────────────────────────

def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    names = df.columns
    return names[names.index(first): names.index(last) + 1]


def starts_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def ends_with(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def contains(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def mutate(df: DataFrame, **exprs) -> DataFrame:
    """Add columns in order; a callable gets the frame with the earlier ones."""
    for name, expr in exprs.items():
        df = df.withColumn(name, expr(df) if callable(expr) else expr)
    return df


def mutate_across(df: DataFrame, cols, fn, names: str = "{col}") -> DataFrame:
    return df.withColumns({names.format(col=c): fn(F.col(c)) for c in cols})


def summarise_across(df: DataFrame, cols, fns: dict, by=()) -> DataFrame:
    """One aggregate over columns × functions, named ``column_function``."""
    aggs = [fn(F.col(c)).alias(f"{c}_{name}") for c in cols for name, fn in fns.items()]
    return df.groupBy(*by).agg(*aggs)


def dense_columns(df: DataFrame, max_missing: float = 0.3) -> list[str]:
    """Columns whose share of NULLs is below ``max_missing``."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is None or row[c] < max_missing]


# ── rows ─────────────────────────────────────────────────────────────────────

def any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def drop_first_by(df: DataFrame, metric: str, key: list[str]) -> DataFrame:
    """All rows but the one with the largest metric (smallest key on ties)."""
    top = df.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), *key).select(*key).limit(1).collect()
    if not top:
        return df
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(top[0][k])) for k in key])
    return df.where(~same)


def sample_n(df: DataFrame, n: int, key: Column, tie: list[str]) -> DataFrame:
    """Repeatable sample of n rows: the n smallest keys."""
    return df.withColumn("__s", key).orderBy("__s", *tie).limit(n).drop("__s")


# ── joins ────────────────────────────────────────────────────────────────────

def join_back(df: DataFrame, by: list[str], aggs: list[Column], source: DataFrame | None = None) -> DataFrame:
    """Put group statistics of ``source`` (default: df itself) on every row of df."""
    stats = (source or df).groupBy(*by).agg(*aggs, F.count("*").alias("__size"))
    return State(stats, by).attach(df).drop("__size")


def join_dimension(fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]], how: str = "left") -> DataFrame:
    """Join a table with one row per key; ``how`` is left, inner, right or full.

    The dimension is broadcast when it is proven small; otherwise its rows for the
    most frequent keys are, and the rest is shuffled.  Unmatched dimension rows of
    a right or full join come from an anti join, so a busy key never gathers.
    """
    left, right = [lk for lk, _ in on], [r for _, r in on]
    keyed = dim.select(*[F.col(r).alias(lk) for lk, r in on], F.struct(*dim.columns).alias("__dim"))
    state = State(keyed, left, stored=True)
    out = state.attach(fact, how="left" if how in ("left", "full") else "inner")
    made = out.select(*fact.columns, *[F.col("__dim")[c].alias(c) for c in dim.columns])
    if how in ("left", "inner"):
        return made
    alone = unmatched(dim, fact, list(zip(right, left)))
    return made.unionByName(alone, allowMissingColumns=True)


def unmatched(df: DataFrame, other: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of df with no match in ``other``, whose keys are reduced before they move."""
    keys = other.select(*[F.col(r).alias(lk) for lk, r in on]).distinct()
    return anti_join(df, keys, [lk for lk, _ in on])


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that are not in b: one aggregate over both, no join."""
    both = a.withColumn("__in_b", F.lit(0)).union(b.withColumn("__in_b", F.lit(1)))
    return both.groupBy(*a.columns).agg(
        F.min("__in_b").alias("__lo"), F.max("__in_b").alias("__hi")
    ).where("__lo = 0 AND __hi = 0").drop("__lo", "__hi")


def bind_rows(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ── reshape ──────────────────────────────────────────────────────────────────

def pivot_wider(df: DataFrame, ids, names_from: str, values_from: str, levels: list) -> DataFrame:
    return df.groupBy(*ids).pivot(names_from, levels).agg(F.first(values_from))


def pivot_longer(df: DataFrame, ids, cols, names_to="name", values_to="value") -> DataFrame:
    return df.unpivot(ids, cols, names_to, values_to)


def pivot_longer_multi(df: DataFrame, variables: list[str], parts: list[str], ids=(),
                       name: str = "variable") -> DataFrame:
    """Columns ``variable_part`` become one row per variable with one column per part."""
    rows = F.array(*[
        F.struct(F.lit(v).alias(name), *[F.col(f"{v}_{p}").alias(p) for p in parts]) for v in variables
    ])
    return df.select(*ids, F.inline(rows))


def separate(df: DataFrame, col: str, into: list[str], sep: str) -> DataFrame:
    bits = F.split(F.col(col), sep)
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, *[bits.getItem(i).alias(nm) for i, nm in enumerate(into)])


def unite(df: DataFrame, name: str, cols: list[str], sep: str) -> DataFrame:
    """Join columns to one text; NULL in any part gives NULL."""
    bits = [F.col(c).cast("string") for c in cols]
    glued = reduce(lambda a, b: F.concat(a, F.lit(sep), b), bits)
    return df.withColumn(name, glued).drop(*cols)
