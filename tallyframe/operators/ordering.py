"""Row numbers and neighbours in a global order, without a one-task window."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.quantiles import order_statistics
from tallyframe.session import State, materialize

_POS_MASK = (1 << 33) - 1


def laid_out(df: DataFrame, order: list) -> DataFrame:
    """df range-sorted and written once, with part number and place in the part."""
    laid = df.orderBy(*order)
    return materialize(
        laid.withColumn("__part", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)))
    )


def with_starts(laid: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add __start, the summed size of all earlier parts (one row per part is broadcast)."""
    rows = sorted(sizes.collect())
    starts = [0, *accumulate(n for _, n in rows)]
    table = laid.sparkSession.createDataFrame(
        [(p, s) for (p, _), s in zip(rows, starts)], "__p int, __start long")
    return laid.join(F.broadcast(table), F.col("__part") == F.col("__p"), "left").drop("__p")


def row_numbers(df: DataFrame, order: list, name: str = "obs", by: list[str] = ()) -> DataFrame:
    """Number rows 1..n in ``order``, or within each ``by`` group.

    A group is cut across range partitions like any other run of rows, so its
    size does not matter.  ``order`` should be total to be repeatable.
    """
    laid = laid_out(df, [*by, *order])
    sizes = laid.groupBy("__part").count()
    out = with_starts(laid, sizes).withColumn(name, F.col("__start") + F.col("__pos") + 1)
    out = out.drop("__part", "__pos", "__start")
    if not by:
        return out
    first = out.groupBy(*by).agg(F.min(name).alias("__first"), F.count("*").alias("__size"))
    out = State(first, list(by)).attach(out)
    return out.withColumn(name, F.col(name) - F.col("__first") + 1).drop("__first", "__size")


# Rows about the wanted positions that one task may number.
TAKEN = 10_000


def rows_between(df: DataFrame, order: list[str], lo: int, hi: int, name: str = "obs") -> DataFrame:
    """Rows at positions lo..hi (from 1) in ``order``, with their position.

    The first order column's values at the two positions are found by rank selection;
    only rows between these are sorted, and of those no more than are needed to reach
    position hi.  NULLs come first.  ``order`` should be total to be repeatable.
    """
    place = _as_number(df, order[0])
    if place is None:  # no numbers to select by
        return row_numbers(df, order, name).where(F.col(name).between(lo, hi))
    rows = df.withColumn("__at", place)
    total, gone = rows.agg(F.count("*"), F.count_if(F.col("__at").isNull())).first()

    def ranks(n: int) -> list[int]:
        return [max(lo - 1 - gone, 0), min(hi - 1 - gone, n - 1)] if n and hi > gone else []

    share = [min(max((r - gone) / max(total - gone, 1), 0.0), 1.0) for r in (lo - 1, hi - 1)]
    got = order_statistics(rows, {"__at": (share, ranks)})["__at"]
    low, high = (min(got.values()), max(got.values())) if got else (None, None)
    keep, below = F.lit(False), 0
    if lo <= gone:
        keep = F.col("__at").isNull()
    else:
        below = gone
    if got and hi > gone:
        if lo > gone:
            keep = F.col("__at").between(low, high)
            below += rows.where(F.col("__at") < low).count()
        else:
            keep = keep | (F.col("__at") <= high)
    some = rows.where(keep).drop("__at")
    if hi - below <= TAKEN:
        numbered = some.orderBy(*order).limit(max(hi - below, 0))
        numbered = numbered.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))  # TAKEN rows at most
    else:
        numbered = row_numbers(some, order, name)
    return numbered.withColumn(name, F.col(name) + below).where(F.col(name).between(lo, hi))


def _as_number(df: DataFrame, col: str) -> Column | None:
    """A column as numbers in the same order, exact as doubles; None for other types."""
    kind, c = dict(df.dtypes)[col], F.col(f"`{col}`")
    if kind in ("tinyint", "smallint", "int", "float", "double", "date"):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double") if kind == "date" else c.cast("double")
    if kind == "timestamp":
        return F.unix_micros(c).cast("double")
    if kind == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{col}`)").cast("double")
    return None


def adjacent_sums(df: DataFrame, value: Column, order: list, by: list[str] = ()) -> dict:
    """Σ(vₜ−vₜ₋₁)², Σ|vₜ−vₜ₋₁|, Σv², pairs and rows over neighbours in order.

    Pairs lie within a ``by`` group.  One range sort; each task folds its run of
    rows as it streams by and reports one row, and the pairs across run borders
    are added from the first and last values of neighbouring runs.
    """
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    runs = df.select(*by, *order, value.alias("__v")).orderBy(*by, *order).select(
        key.alias("k"), F.col("__v").cast("double").alias("v"))
    rows = runs.mapInArrow(_fold_run, (
        "part int, sq double, ab double, pairs long, vv double, n long, "
        "k0 string, v0 double, k1 string, v1 double")).collect()
    out = {"sq": 0.0, "abs": 0.0, "pairs": 0, "vv": 0.0, "n": 0}
    last = None
    for r in sorted(rows, key=lambda r: r["part"]):
        out["sq"] += r["sq"]
        out["abs"] += r["ab"]
        out["vv"] += r["vv"]
        out["pairs"] += r["pairs"]
        out["n"] += r["n"]
        if last is not None and last["k1"] == r["k0"]:
            gap = r["v0"] - last["v1"]
            out["sq"] += gap * gap
            out["abs"] += abs(gap)
            out["pairs"] += 1
        last = r
    return out


def _fold_run(batches):
    """One row of sums over a sorted partition, with its first and last values."""
    sq = ab = vv = 0.0
    pairs = n = 0
    first = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(0).to_numpy(zero_copy_only=False)
        v = batch.column(1).to_numpy(zero_copy_only=False)
        first = first or (k[0], float(v[0]))
        if last is not None:
            k, v = np.append([last[0]], k), np.append([last[1]], v)
        gap = np.diff(v)[k[1:] == k[:-1]]
        sq += float(gap @ gap)
        ab += float(np.abs(gap).sum())
        pairs += len(gap)
        own = v[len(v) - batch.num_rows:]
        vv += float(own @ own)
        n += batch.num_rows
        last = (k[-1], float(v[-1]))
    if n:
        part = TaskContext.get().partitionId()
        row = (part, sq, ab, pairs, vv, n, *first, *last)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(row, (
                pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.int64(),
                pa.string(), pa.float64(), pa.string(), pa.float64()))],
            names=["part", "sq", "ab", "pairs", "vv", "n", "k0", "v0", "k1", "v1"])
