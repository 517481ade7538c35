"""Feature engineering: learn state on training rows, apply it to any frame."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.describe import mode
from tallyframe.operators.ordering import row_numbers
from tallyframe.operators.quantiles import grouped_quantiles, quantiles
from tallyframe.session import SMALL_ROWS, State


# ── missing values ───────────────────────────────────────────────────────────

def fit_median(train: DataFrame, cols: list[str]) -> dict[str, float]:
    return {c: q[0] for c, q in quantiles(train, cols, [0.5]).items()}


def fit_mean(train: DataFrame, cols: list[str]) -> dict[str, float]:
    return train.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()


def fit_mode(train: DataFrame, cols: list[str]) -> dict[str, object]:
    out = {}
    for c in cols:
        row = mode(train, c).first()
        out[c] = row[0] if row else None
    return out


def fill(df: DataFrame, state: dict) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v)) for c, v in state.items() if v is not None
    })


class GroupMedian:
    """Median per group; a NULL group is a group of its own."""

    def __init__(self, train: DataFrame, by: list[str], col: str):
        self.col = col
        self.state = State(grouped_quantiles(train, by, col, [0.5], ["__med"], count="__size"), by)

    def apply(self, df: DataFrame) -> DataFrame:
        out = self.state.attach(df)
        return out.withColumn(self.col, F.coalesce(F.col(self.col), F.col("__med"))).drop("__med", "__size")


def fill_sentinel(df: DataFrame, col: str, sentinel: float = -999.0) -> DataFrame:
    """NULL → sentinel, with a 0/1 column that keeps the missingness."""
    return df.withColumn(f"{col}_missing", F.col(col).isNull().cast("int")).withColumn(
        col, F.coalesce(F.col(col), F.lit(sentinel))
    )


# ── encoding ─────────────────────────────────────────────────────────────────

def fit_levels(train: DataFrame, col: str, limit: int = SMALL_ROWS) -> list:
    """Sorted distinct levels of a category."""
    rows = train.select(col).where(F.col(col).isNotNull()).distinct().take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"{col} has over {limit} levels; use an encoding that needs no column per level")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, col: str, levels: list, drop_first: bool = False, keep: bool = False) -> DataFrame:
    used = levels[1:] if drop_first else levels
    out = df.withColumns({f"{col}_{lv}": (F.col(col) == F.lit(lv)).cast("int") for lv in used})
    return out if keep else out.drop(col)


class LevelIds:
    """Numbers 1, 2, … of a category's training levels in sorted order, for any number of
    levels: they are ranked where they lie and joined as state."""

    def __init__(self, train: DataFrame, col: str):
        levels = train.select(F.col(col).alias("__level")).where(F.col(col).isNotNull()).distinct()
        self.col = col
        self.state = State(row_numbers(levels, ["__level"], "__id"), ["__level"])

    def attach(self, df: DataFrame, name: str) -> DataFrame:
        """df with the level's number; 0 for levels not seen in training, NULL for NULL."""
        out = self.state.attach(df.withColumn("__level", F.col(self.col)))
        number = F.when(F.col(self.col).isNotNull(), F.coalesce("__id", F.lit(0).cast("long")))
        return out.withColumn("__number", number.cast("int")).drop("__level", "__id").withColumn(name, F.col("__number")).drop("__number")


def one_hot_sparse(df: DataFrame, ids: LevelIds, name: str) -> DataFrame:
    """One column for all levels: (size, indices, values) as sparse vectors have it.  NULL
    and unseen levels have no index."""
    size = ids.state.df.count()
    out = ids.attach(df, "__at")
    hit = F.col("__at") > 0
    nothing = F.array().cast("array<int>"), F.array().cast("array<double>")
    return out.withColumn(name, F.struct(
        F.lit(size).alias("size"), F.when(hit, F.array(F.col("__at") - 1)).otherwise(nothing[0]).alias("indices"),
        F.when(hit, F.array(F.lit(1.0))).otherwise(nothing[1]).alias("values"))).drop("__at")


class KeyEncoding:
    """Per-category statistic of the training rows, joined to any frame."""

    def __init__(self, train: DataFrame, col: str, stat: Column, name: str):
        self.name = name
        self.state = State(train.groupBy(col).agg(stat.alias(name), F.count("*").alias("__size")), [col])

    def apply(self, df: DataFrame) -> DataFrame:
        return self.state.attach(df).drop("__size")


# ── scaling ──────────────────────────────────────────────────────────────────

def fit_zscore(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                    *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def fit_minmax(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    row = train.agg(*[F.min(c).cast("double").alias(f"a_{c}") for c in cols],
                    *[F.max(c).cast("double").alias(f"b_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        a, b = row[f"a_{c}"], row[f"b_{c}"]
        out[c] = (a, None if a is None else b - a)
    return out


def fit_robust(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    q = quantiles(train, cols, [0.25, 0.5, 0.75])
    return {c: (q[c][1], None if q[c][0] is None else q[c][2] - q[c][0]) for c in cols}


def rescale(df: DataFrame, state: dict, suffix: str = "") -> DataFrame:
    """(x − shift) / scale; NULL where the scale is zero or unknown."""
    return df.withColumns({
        f"{c}{suffix}": (F.col(c) - F.lit(a).cast("double")) / F.lit(b or None).cast("double")
        for c, (a, b) in state.items()
    })


# ── power transforms ─────────────────────────────────────────────────────────

def power_grid(lo: float = -2.0, hi: float = 2.0, step: float = 0.1) -> list[float]:
    n = round((hi - lo) / step)
    return [round(lo + k * step, 10) for k in range(n + 1)]


def box_cox(x: Column, lam: float) -> Column:
    return F.ln(x) if abs(lam) < 1e-10 else (F.pow(x, F.lit(lam)) - 1) / lam


def yeo_johnson(x: Column, lam: float) -> Column:
    up = F.log1p(x) if abs(lam) < 1e-10 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    two = 2.0 - lam
    down = -F.log1p(-x) if abs(two) < 1e-10 else -(F.pow(1 - x, F.lit(two)) - 1) / two
    return F.when(x >= 0, up).when(x < 0, down)


def _np_box_cox(ln_x, lam):
    return ln_x if abs(lam) < 1e-10 else np.expm1(lam * ln_x) / lam


def _np_yeo_johnson(signed_log, lam):
    """From sign(x)·log(1+|x|), which both arms are powers of."""
    up = signed_log if abs(lam) < 1e-10 else np.expm1(lam * signed_log) / lam
    two = 2.0 - lam
    down = signed_log if abs(two) < 1e-10 else -np.expm1(-two * signed_log) / two
    return np.where(signed_log >= 0, up, down)


def _best_power(logs: DataFrame, transform, grid: list[float]) -> tuple[float, dict]:
    """Profile likelihood of every power from one pass over all rows.

    ``logs`` has one column v of logarithms.  Forty powers per value are cheap on
    Arrow batches; each task reports one row of sums per power, taken about the
    transform of a value near the middle to keep digits.
    """
    at = logs.agg(F.avg("v")).first()[0]
    if at is None:
        raise ValueError("no value to fit a power on")
    mid = [float(transform(np.array([at]), g)[0]) for g in grid]

    def fold(batches):
        n, j, sums = 0, 0.0, np.zeros((len(grid), 2))
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False)
            n, j = n + len(v), j + float(v.sum())
            for k, g in enumerate(grid):
                z = transform(v, g) - mid[k]
                sums[k] += z.sum(), z @ z
        if n:
            k = len(grid)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(k), pa.int32()), pa.array(np.full(k, n), pa.int64()), pa.array(np.full(k, j)),
                pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["k", "n", "j", "s", "q"])

    rows = logs.mapInArrow(fold, "k int, n long, j double, s double, q double").groupBy("k").agg(
        *[F.sum(c).alias(c) for c in ("n", "j", "s", "q")]).collect()
    scores = {}
    for r in sorted(rows, key=lambda r: r["k"]):
        n, lam = r["n"], grid[r["k"]]
        v = r["q"] / n - (r["s"] / n) ** 2
        scores[lam] = -math.inf if v <= 0.0 else n * (-0.5 * math.log(v) + (lam - 1.0) * r["j"] / n)
    return max(scores, key=scores.get), scores


def fit_box_cox(df: DataFrame, col: str, grid: list[float] | None = None) -> tuple[float, dict]:
    """Power with the largest profile likelihood of an intercept-only model."""
    x = F.col(col).cast("double")
    return _best_power(df.where(x > 0).select(F.ln(x).alias("v")), _np_box_cox, grid or power_grid())


def fit_yeo_johnson(df: DataFrame, col: str, grid: list[float] | None = None) -> tuple[float, dict]:
    x = F.col(col).cast("double")
    logs = df.where(x.isNotNull()).select((F.signum(x) * F.log1p(F.abs(x))).alias("v"))
    return _best_power(logs, _np_yeo_johnson, grid or power_grid())


# ── bins ─────────────────────────────────────────────────────────────────────

def equal_width_edges(df: DataFrame, col: str, bins: int) -> list[float]:
    """Edges over the range, both ends widened by a thousandth of it."""
    row = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    lo, hi = row
    if lo is None:
        raise ValueError(f"{col} has no known value to bin")
    edges = [lo + (hi - lo) * k / bins for k in range(bins + 1)]
    edges[0] -= (hi - lo) / 1000.0
    edges[-1] += (hi - lo) / 1000.0
    return edges


def band_by_edges(x: Column, edges: list[float], labels: list) -> Column:
    """Right-closed bands (a, b]; the first also holds its lower edge."""
    out = F.when(x < edges[0], F.lit(None))
    for hi, label in zip(edges[1:], labels):
        out = out.when(x <= hi, F.lit(label))
    return out


def quantile_edges(df: DataFrame, col: str, parts: int = 4) -> list[float]:
    return quantiles(df, [col], [k / parts for k in range(parts + 1)])[col]
