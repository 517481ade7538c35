"""Splits, error measures, cross-validation and learning curves."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.operators.features import band_by_edges
from tallyframe.operators.quantiles import quantiles
from tallyframe.plans.moments import Moments, grouped_moments, total
from tallyframe.plans.ols import Y, Fit, solve


HASH_BITS = 52
BIN_BITS = 12
# Rows of one bin of one stratum whose hashes may be listed on the driver.
LISTED = 20_000


def key_hash(keys: list[str], salt: int = 0) -> Column:
    """A 52-bit number from keys of any type: the first digits of an md5 over their texts,
    each with its length before it, so that no two lists of keys read alike.  NULL is a
    value of its own.  Equal on any partitioning and in any engine that has md5."""
    def shown(k: str) -> Column:
        text = F.col(f"`{k}`").cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(salt)), *map(shown, keys))), 1, HASH_BITS // 4), 16, 10).cast("long")


def bucket(keys: list[str], n: int, salt: int = 0) -> Column:
    """Repeatable bucket 0..n-1 of keys."""
    return F.pmod(key_hash(keys, salt), F.lit(n).cast("long"))


def split(df: DataFrame, keys: list[str], share: float = 0.8, parts: int = 10) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test rows; every row is in one of them."""
    b = bucket(keys, parts)
    cut = round(share * parts)
    return df.where(b < cut), df.where(b >= cut)


def hash_cuts(rows: DataFrame, shares: list[float]) -> dict:
    """For each stratum of rows (__stratum, __h) and each share of its rows the cut
    (hash, rows with that hash before the cut, rows with that hash).

    Counts by (stratum, first bits) find the bin where a share is reached, and only such
    bins are counted by further bits; no row is sorted or fetched.
    """
    local: dict = {}  # (stratum, cut) -> [prefix, rows before it, rows in it, rank]
    shift, found = HASH_BITS, {}
    while shift:
        largest = max((x[2] for x in local.values()), default=None)
        new = 0 if largest is not None and largest <= LISTED else max(shift - BIN_BITS, 0)
        part = rows
        if local:
            seen = sorted({(s, x[0]) for (s, _), x in local.items()}, key=str)
            table = rows.sparkSession.createDataFrame(seen, rows.select(F.col("__stratum").alias("__s"), F.col("__h").alias("__p")).schema)
            part = rows.join(F.broadcast(table), F.col("__stratum").eqNullSafe(F.col("__s")) & (F.shiftright("__h", shift) == F.col("__p")))
        got = part.groupBy("__stratum", F.shiftright("__h", new).alias("b")).agg(F.count("*").alias("n")).collect()
        bins: dict = {}
        for r in got:
            bins.setdefault(r["__stratum"], []).append((r.b, r.n))
        if not local:
            for s, cells in bins.items():
                n = sum(x[1] for x in cells)
                for j, share in enumerate(shares):
                    local[s, j] = [0, 0, n, math.floor(n * share + 1e-9)]
        for (s, j), x in list(local.items()):
            prefix, before, _, rank = x
            if rank == 0:  # nothing lies before this cut
                found[s, j] = (-1, 0, 0)
                del local[s, j]
                continue
            for b, n in sorted(c for c in bins[s] if c[0] >> (shift - new) == prefix):
                if before + n >= rank:
                    local[s, j] = [b, before, n, rank]
                    break
                before += n
        shift = new
        if not local:
            break
    found.update({k: (x[0], x[3] - x[1], x[2]) for k, x in local.items()})
    return found


def cut_by_hash(df: DataFrame, stratum: Column, keys: list[str], tie: list[str], shares: list[float], name: str) -> DataFrame:
    """df with the part 0..len(shares) of each row: the shares cut each stratum's rows in
    the order of their key's hash, at floor(share · rows).  Strata (NULL is one) are few.

    A row's part follows from its hash alone; only rows that share the very hash at which
    a cut falls, as rows with equal keys do, are ranked, by ``tie``.
    """
    rows = df.withColumn("__stratum", stratum).withColumn("__h", key_hash(keys))
    cuts = hash_cuts(rows.select("__stratum", "__h"), shares)
    strata = sorted({s for s, _ in cuts}, key=str)

    def part(s, rank: Column | None) -> Column:
        out = F.lit(0)
        for j in range(len(shares)):
            h, q, n = cuts[s, j]
            after = F.col("__h") > h
            if rank is not None and q < n:
                after = after | ((F.col("__h") == h) & (rank > q))
            out = out + after.cast("int")
        return out

    def parts(frame: DataFrame, rank: Column | None) -> DataFrame:
        out = F
        for s in strata:
            out = out.when(F.col("__stratum").eqNullSafe(F.lit(s)), part(s, rank))
        return frame.withColumn(name, out if strata else F.lit(0)).drop("__stratum", "__h", "__rank")

    torn = sorted({h for h, q, n in cuts.values() if q < n})
    if not torn:
        return parts(rows, None)
    w = Window.partitionBy("__stratum", "__h").orderBy(*tie)
    edge = rows.where(F.col("__h").isin(*torn)).withColumn("__rank", F.row_number().over(w))
    return parts(rows.where(~F.col("__h").isin(*torn)), None).unionByName(parts(edge, F.col("__rank")))


def quartile_band(df: DataFrame, col: str) -> Column:
    """1..4 by the quartiles of a column; NULL for unknown values."""
    return band_by_edges(F.col(col), quantiles(df, [col], [0.0, 0.25, 0.5, 0.75, 1.0])[col], [1, 2, 3, 4])


def stratified_split(df: DataFrame, strata: str, keys: list[str], tie: list[str], share: float = 0.8) -> DataFrame:
    """Label rows train or test so each quartile band gives floor(share·n) train rows."""
    df = df.withColumn("stratum", quartile_band(df, strata))
    out = cut_by_hash(df, F.col("stratum"), keys, tie, [share], "__part")
    return out.withColumn("part", F.when(F.col("__part") == 0, "train").otherwise("test")).drop("__part")


def stratified_folds(df: DataFrame, strata: str, keys: list[str], tie: list[str], folds: int = 10) -> DataFrame:
    """df with ``fold`` 0..folds-1, equal parts of each quartile band."""
    return cut_by_hash(df, quartile_band(df, strata), keys, tie, [j / folds for j in range(1, folds)], "fold")


# ── error measures ───────────────────────────────────────────────────────────

def metric_columns(actual: Column, predicted: Column, train_mean: float | None = None) -> dict[str, Column]:
    e = actual - predicted
    out = {
        "n": F.count(e), "mae": F.avg(F.abs(e)), "mse": F.avg(e * e), "rmse": F.sqrt(F.avg(e * e)),
        "mape": F.avg(F.abs(F.try_divide(e, actual))) * 100,
        "rsq_corr": F.pow(F.corr(actual, predicted), 2),
    }
    if train_mean is None:
        base = F.var_pop(actual) * F.count(actual)
    else:
        base = F.sum((actual - train_mean) * (actual - train_mean))
    out["r2_vs_train_mean"] = 1 - F.try_divide(F.sum(e * e), base)
    return out


def metric_set(df: DataFrame, actual: str, predicted: str, names: list[str]) -> DataFrame:
    """Long (metric, estimate) from one aggregate."""
    m = metric_columns(F.col(actual), F.col(predicted))
    row = df.agg(*[m[nm].cast("double").alias(nm) for nm in names])
    return row.unpivot([], names, "metric", "estimate")


def eval_regression(df: DataFrame, actual: Column, predicted: Column, name: str,
                    train_mean: float | None = None) -> DataFrame:
    return df.agg(*report_columns(name, metric_columns(actual, predicted, train_mean)))


def report_columns(name: str, m: dict[str, Column]) -> list[Column]:
    digits = {"mae": ("mae", 3), "rmse": ("rmse", 3), "mape": ("mape", 2), "r2": ("r2_vs_train_mean", 4)}
    return [F.lit(name).alias("model"), m["n"].alias("n"), *[F.round(m[k], d).alias(c) for c, (k, d) in digits.items()]]


def compare_on_test(test: DataFrame, fits: dict[str, Fit], actual: Column, train_mean: float) -> DataFrame:
    """Metrics of several models from one scan of the test rows."""
    aggs = []
    for nm, f in fits.items():
        aggs.append(F.struct(*report_columns(nm, metric_columns(actual, f.prediction(), train_mean))))
    return test.agg(F.array(*aggs).alias("m")).select(F.inline("m"))


# ── cross-validation ─────────────────────────────────────────────────────────

def k_fold(df: DataFrame, y: Column, terms: dict[str, Column], fold: Column) -> DataFrame:
    """Per-fold validation metrics of models fitted without that fold.

    One job collects moments per fold; the training moments of fold k are the
    total minus fold k.  A second job scores every row with its fold's model.
    """
    parts = grouped_moments(df, {**terms, Y: y.cast("double")}, fold)
    whole = total(parts.values())
    fits = {k: solve(whole - m, terms, y, target=Y) for k, m in parts.items()}
    names = list(terms)
    table = df.sparkSession.createDataFrame(
        [(k, f.intercept, f.ybar, *[f.coef.get(nm, 0.0) for nm in names]) for k, f in fits.items()],
        ["__k", "__a0", "__m", *[f"__b{i}" for i in range(len(names))]])
    rows = df.select(fold.alias("fold"), y.cast("double").alias("__a"), *[
        c.cast("double").alias(f"__x{i}") for i, c in enumerate(terms.values())]).dropna()
    pred = F.col("__a0")
    for i in range(len(names)):
        pred = pred + F.col(f"__b{i}") * F.col(f"__x{i}")
    # One coefficient row per fold.
    scored = rows.join(F.broadcast(table), rows["fold"] == table["__k"]).withColumn("__p", pred)
    e = F.col("__a") - F.col("__p")
    d = F.col("__a") - F.col("__m")
    return scored.groupBy("fold").agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.sum(d * d))).alias("r2"),
        F.pow(F.corr("__a", "__p"), 2).alias("rsq"), F.count("*").alias("n"),
    )


def collect_metrics(folds: DataFrame, names: list[str]) -> DataFrame:
    """Mean and standard error over folds, long."""
    long = folds.unpivot(["fold"], names, "metric", "value")
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.count("*").alias("n"),
        (F.stddev_samp("value") / F.sqrt(F.count("*"))).alias("std_err"),
    )


def leave_one_out(df: DataFrame, f: Fit) -> DataFrame:
    """Leave-one-out error from residual and leverage, no refits."""
    e = (f.y - f.prediction()) / (1.0 - f.leverage())
    return df.agg(F.count(e).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def _rmse(f: Fit, m: Moments) -> float:
    """Root mean squared error of a fit on the rows behind ``m``."""
    w = np.append(-f.b, 1.0)
    sub = m.pick([*f.kept, m.names[-1]])
    sse = float(w @ sub.sxx @ w)
    bias = float(w @ sub.mean) - f.intercept
    return math.sqrt(max(sse, 0.0) / sub.n + bias * bias)


def learning_curve(spark: SparkSession, df: DataFrame, y: Column, terms: dict[str, Column], keys: list[str],
                   parts: int = 20, hold: int = 4, reps: int = 5) -> DataFrame:
    """Training and validation error by training size.

    Rows fall into hash buckets per repeat; the last ``hold`` buckets validate and
    growing prefixes of the others train.  Moments per (repeat, bucket) come from
    one job, prefix sums give every size, and both errors follow from moments.
    """
    rep_bucket = F.explode(F.array(*[F.lit(r * parts) + bucket(keys, parts, salt=r) for r in range(reps)]))
    rows = df.withColumn("__rb", rep_bucket)
    got = grouped_moments(rows, {**terms, Y: y.cast("double")}, F.col("__rb"), first=df)
    out = []
    for r in range(reps):
        cell = {b: got[r * parts + b] for b in range(parts) if r * parts + b in got}
        held = [cell[b] for b in range(parts - hold, parts) if b in cell]
        if not held:
            continue
        check, grown = total(held), None
        for b in range(parts - hold):
            if b in cell:
                grown = cell[b] if grown is None else grown + cell[b]
            if grown is None or grown.n <= len(terms) + 1:
                continue
            f = solve(grown, terms, y, target=Y)
            out.append((r + 1, (b + 1) / parts, int(grown.n), _rmse(f, grown), _rmse(f, check)))
    return spark.createDataFrame(
        out, "rep int, fraction double, n_train long, train_rmse double, val_rmse double"
    )
