"""The aggregated data behind common charts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dist import normal_quantile, t_quantile_column
from tallyframe.operators.describe import outside
from tallyframe.operators.features import band_by_edges
from tallyframe.operators.quantiles import grouped_quantiles, quantiles
from tallyframe.session import State


def column_range(df: DataFrame, col: str) -> tuple[float, float]:
    return tuple(df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first())


def histogram(df: DataFrame, col: str, bins: int, bounds: tuple[float, float] | None = None) -> DataFrame:
    """bin, left edge, right edge, count, density; the last bin is closed."""
    lo, hi = bounds or column_range(df, col)
    if lo is None:  # nothing known: no bins
        lo, hi = 0.0, 0.0
    w = (hi - lo) / bins or 1.0
    b = F.least(F.floor((F.col(col) - lo) / w), F.lit(bins - 1))
    counts = df.where(F.col(col).between(lo, hi)).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        "bin", (lo + F.col("bin") * w).alias("left"), (lo + (F.col("bin") + 1) * w).alias("right"), "n",
        (F.col("n") / (total * w)).alias("density"),
    )


def histograms(df: DataFrame, cols: list[str], bins: int) -> DataFrame:
    """(variable, bin, n) of several columns: bins 1..bins of equal width that are not empty;
    two scans for all columns."""
    ends = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in cols]).first()
    counts = []
    for c in cols:
        lo, hi = ends[c]
        if lo is None:
            continue
        width = (hi - lo) / bins or 1.0
        x = F.col(c).cast("double")
        at = F.when(x.isNotNull(), F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) + 1)
        counts += [F.struct(F.lit(c).alias("variable"), F.lit(b).alias("bin"), F.count_if(at == b).alias("n")) for b in range(1, bins + 1)]
    if not counts:
        return df.sparkSession.createDataFrame([], "variable string, bin int, n long")
    return df.agg(F.array(*counts).alias("h")).select(F.inline("h")).where("n > 0")


def histogram_width(df: DataFrame, col: str, width: float) -> DataFrame:
    b = F.floor(F.col(col) / width)
    return df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n")).select(
        "bin", (F.col("bin") * width).alias("left"), ((F.col("bin") + 1) * width).alias("right"), "n")


def bin2d(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    row = df.agg(*[f(c).cast("double") for c in (x, y) for f in (F.min, F.max)]).first()

    def key(c, lo, hi):
        return F.least(F.floor((F.col(c) - lo) / ((hi - lo) / bins or 1.0)), F.lit(bins - 1))

    if row[0] is None or row[2] is None:
        row = [0.0] * 4
    return df.groupBy(key(x, row[0], row[1]).alias("x_bin"), key(y, row[2], row[3]).alias("y_bin")).agg(
        F.count("*").alias("n"))


def density(df: DataFrame, col: str, by: list[str] = (), points: int = 64, bins: int = 512) -> DataFrame:
    """Gaussian kernel density on a grid, per group.

    Rows are first counted into fine bins, so the kernel sum runs over at most
    groups × bins rows however long the table is.
    """
    lo, hi = column_range(df, col)
    if lo is None:
        lo, hi = 0.0, 0.0
    w = (hi - lo) / bins or 1.0
    by = list(by)
    known = df.where(F.col(col).isNotNull())
    b = F.least(F.floor((F.col(col) - lo) / w), F.lit(bins - 1))
    cells = known.groupBy(*by, b.alias("__b")).agg(F.count("*").alias("__c"))
    stats = known.groupBy(*by).agg(F.count("*").alias("__n"), F.stddev_samp(col).alias("__sd"))
    if by:
        q = State(grouped_quantiles(df, by, col, [0.25, 0.75], ["__q1", "__q3"]), by)
        stats = q.attach(stats)
    else:
        q1, q3 = quantiles(df, [col], [0.25, 0.75])[col]
        stats = stats.withColumn("__q1", F.lit(q1)).withColumn("__q3", F.lit(q3))
    # without spread in the middle half, or with one row, the usual fallbacks
    iqr = (F.col("__q3") - F.col("__q1")) / 1.34
    spread = F.coalesce(*[F.when(x > 0, x) for x in (F.least("__sd", F.when(iqr > 0, iqr)), F.abs("__q1"))], F.lit(1.0))
    stats = stats.withColumn("bw", 0.9 * spread * F.pow(F.col("__n"), F.lit(-0.2)))
    if by:
        wide = State(stats.select(*by, "__n", "bw"), by).attach(cells)
    else:
        row = stats.first() or {"__n": 0, "bw": 1.0}
        wide = cells.withColumn("__n", F.lit(row["__n"])).withColumn("bw", F.lit(row["bw"]))
    step = (hi - lo) / (points - 1)
    grid = wide.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    z = ((lo + F.col("point") * step) - (lo + (F.col("__b") + 0.5) * w)) / F.col("bw")
    kernel = F.exp(-0.5 * z * z) * F.col("__c") / (F.col("__n") * F.col("bw") * math.sqrt(2 * math.pi))
    return grid.groupBy(*by, "point").agg(F.sum(kernel).alias("density")).withColumn("x", lo + F.col("point") * step)


def box_stats(df: DataFrame, by: list[str], col: str, mult: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count per group."""
    q = State(grouped_quantiles(df, by, col, [0.25, 0.5, 0.75], ["q1", "median", "q3"], count="__n"), by)
    x = F.col(col)
    iqr = F.col("q3") - F.col("q1")
    inside = ~outside(x, (F.col("q1") - mult * iqr, F.col("q3") + mult * iqr))
    return q.attach(df).where(x.isNotNull()).groupBy(*by).agg(
        F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def qq_points(df: DataFrame, col: str, k: int = 99) -> DataFrame:
    """(p, theoretical, sample, line) at k probabilities."""
    probs = [(i + 1) / (k + 1) for i in range(k)]
    sample = quantiles(df, [col], probs)[col]
    rows = [(p, normal_quantile(p), s) for p, s in zip(probs, sample)]
    out = df.sparkSession.createDataFrame(rows, "p double, theoretical double, sample double")
    slope, start = qq_line(df, col)
    return out.withColumn("line", F.lit(start) + F.lit(slope) * F.col("theoretical"))


def qq_line(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    """Slope and intercept of the line through the quartiles of a Q–Q plot."""
    q1, q3 = quantiles(df, [col], [0.25, 0.75])[col]
    if q1 is None:
        return None, None
    z = normal_quantile(0.75)
    slope = (q3 - q1) / (2 * z)
    return slope, q1 + slope * z


def binned_trend(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Mean of y within quantile bands of x: the trend line of a scatter."""
    edges = quantiles(df, [x], [k / bins for k in range(bins + 1)])[x]
    band = band_by_edges(F.col(x), edges, list(range(1, bins + 1)))
    return df.where(F.col(x).isNotNull()).groupBy(band.alias("band")).agg(
        F.avg(x).alias("x_mean"), F.avg(y).alias("y_mean"), F.count("*").alias("n"))


def linear_trends(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*by).agg(
        F.regr_slope(fy, fx).alias("slope"), F.regr_intercept(fy, fx).alias("intercept"),
        F.regr_r2(fy, fx).alias("r2"), F.count("*").alias("n"))


def trend_band(df: DataFrame, by: list[str], x: str, y: str, points: int = 80, level: float = 0.95) -> DataFrame:
    """(by, x, fit, lower, upper): each group's fitted line with the confidence band of its
    mean on an even grid over the group's x.

    One aggregate; every group has its own degrees of freedom.  Rows with an unknown x or
    y take no part.  Groups of two rows have a line without band, those with a single x
    neither.
    """
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    known = df.where(fx.isNotNull() & fy.isNotNull() & ~F.isnan(fx) & ~F.isnan(fy))
    g = known.groupBy(*by).agg(
        F.count("*").alias("__n"), F.min(fx).alias("__lo"), F.max(fx).alias("__hi"), F.avg(fx).alias("__mx"), F.avg(fy).alias("__my"),
        F.regr_sxx(fy, fx).alias("__sxx"), F.regr_syy(fy, fx).alias("__syy"), F.regr_sxy(fy, fx).alias("__sxy")).where("__n > 0")
    slope = F.try_divide("__sxy", "__sxx")
    rest = F.greatest(F.col("__syy") - slope * F.col("__sxy"), F.lit(0.0))
    sigma = F.when(F.col("__n") > 2, F.sqrt(rest / F.nullif(F.col("__n") - 2, F.lit(0))))
    g = g.select(*by, "__n", "__lo", "__hi", "__mx", "__my", "__sxx", slope.alias("__b"), sigma.alias("__s"),
                 t_quantile_column(0.5 + level / 2, F.col("__n") - 2).alias("__t"))
    step = (F.col("__hi") - F.col("__lo")) / (points - 1)
    grid = g.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("__x", F.col("__lo") + F.col("__i") * step)
    off = F.col("__x") - F.col("__mx")
    fit = F.col("__my") + F.col("__b") * off
    half = F.col("__t") * F.col("__s") * F.sqrt(1.0 / F.col("__n") + F.try_divide(off * off, F.col("__sxx")))
    return grid.select(*by, F.col("__x").alias("x"), fit.alias("fit"), (fit - half).alias("lower"), (fit + half).alias("upper"))
