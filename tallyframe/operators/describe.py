"""Descriptive statistics, frequencies and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.frame import numeric_columns, text_columns
from tallyframe.operators.quantiles import grouped_quantiles, quantiles
from tallyframe.session import State


def share_true(cond: Column) -> Column:
    """Percent of rows where cond holds, among rows where it is known."""
    return F.avg(cond.cast("double")) * 100


def coefficient_of_variation(x: Column) -> Column:
    return F.try_divide(F.stddev_samp(x), F.avg(x)) * 100


def weighted_mean(x: Column, w: Column) -> Column:
    return F.try_divide(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def kurtosis_raw(x: Column) -> Column:
    return F.kurtosis(x) + 3


def value_counts(df: DataFrame, cols: list[str], name: str = "n", keep_null: bool = True) -> DataFrame:
    if not keep_null:
        df = df.dropna(subset=cols)
    return df.groupBy(*cols).agg(F.count("*").alias(name))


def with_share(counts: DataFrame, n: str = "n", name: str = "pct", scale: float = 100.0) -> DataFrame:
    """Counts with their share of the grand total (a scalar of the counts)."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(name, F.col(n) / total * scale)


def mode(df: DataFrame, col: str, by: list[str] = ()) -> DataFrame:
    """Most frequent value, smallest on ties; counts are combined per value first."""
    counts = value_counts(df, [*by, col], keep_null=True).where(F.col(col).isNotNull())
    return counts.groupBy(*by).agg(F.min_by(col, F.struct(-F.col("n"), F.col(col))).alias(f"{col}_mode"))


def crosstab(df: DataFrame, row: str, col: str, levels: list | None = None, other: str | None = None) -> DataFrame:
    """Two-way counts, rows with NULL in either column dropped.

    Without ``levels`` every level found gets a column.  With them, ``other`` names a
    column for the rows of all other levels, so that no row is lost from the totals.
    """
    from tallyframe.operators.features import fit_levels  # which imports this module

    kept = df.dropna(subset=[row, col])
    levels = fit_levels(kept, col) if levels is None else list(levels)
    names = [str(v) for v in levels]
    value = F.col(col).cast("string")
    if other is not None:
        value = F.when(value.isin(names), value).otherwise(other)
        names = [*names, other]
    cells = kept.select(row, value.alias("__level"))
    wide = cells.groupBy(row).pivot("__level", names).agg(F.count(row))
    return wide.select(row, *[F.coalesce(F.col(f"`{n}`"), F.lit(0).cast("long")).alias(n) for n in names])


def row_percent(table: DataFrame, levels: list[str], digits: int = 1) -> DataFrame:
    total = sum(F.col(v) for v in levels[1:]) + F.col(levels[0])
    return table.withColumns({
        v: F.format_string(f"%.{digits}f%%", F.round(F.try_divide(F.col(v), total) * 100, digits)) for v in levels
    })


def five_number(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long summary: one row per column with extremes, quartiles and mean; two scans."""
    means: dict = {}
    q = quantiles(df, cols, [0.0, 0.25, 0.5, 0.75, 1.0], means)
    real = lambda x: None if x is None else float(x)
    rows = [(c, *map(real, q[c][:3]), real(means[c]), *map(real, q[c][3:])) for c in cols]
    return df.sparkSession.createDataFrame(
        rows, "variable string, min double, q1 double, median double, mean double, q3 double, max double")


def null_counts(df: DataFrame) -> DataFrame:
    """(variable, n_miss, pct_miss) of every column from one scan."""
    row = df.agg(
        F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    parts = F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).alias("n_miss"),
                 (F.try_divide(F.col(c) * 100.0, F.col("__n"))).alias("pct_miss"))
        for c in df.columns
    ])
    return row.select(F.inline(parts))


def histogram_text(counts: list[int]) -> str:
    """Eight-level bar text of histogram counts."""
    top = max(counts) or 1
    return "".join("▁▂▃▄▅▆▇█"[min(7, int(8 * c / top))] for c in counts)


def skim(df: DataFrame, bins: int = 8, top: int = 4) -> DataFrame:
    """Profile of every column in long form.

    Numeric columns: missing, mean, sd, quartiles and a small histogram.  Text
    columns: missing, distinct values, and the ``top`` most frequent values.
    """
    nums, texts = numeric_columns(df), text_columns(df)
    q = quantiles(df, nums, [0.0, 0.25, 0.5, 0.75, 1.0]) if nums else {}
    aggs = [F.count("*").alias("n")]
    for c in nums:
        lo, hi = q[c][0], q[c][4]
        width = ((hi - lo) / bins or 1.0) if lo is not None else 1.0
        b = F.when(F.col(c).isNotNull(), F.least(F.floor((F.col(c) - F.lit(lo or 0.0)) / width), F.lit(bins - 1)))
        aggs.append(F.struct(
            F.count_if(F.col(c).isNull()).alias("miss"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("sd"),
            F.array(*[F.count_if(b == k) for k in range(bins)]).alias("hist"),
        ).alias(f"num_{c}"))
    for c in texts:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"txt_{c}"))
    row = df.agg(*aggs).first()
    tops = _text_tops(df, texts, top) if texts else {}
    n = row["n"]
    out = []
    for c in nums:
        s = row[f"num_{c}"]
        out.append(("numeric", c, s["miss"], (n - s["miss"]) / n if n else None, s["mean"], s["sd"],
                    *q[c], histogram_text(s["hist"]), None, None))
    for c in texts:
        miss = row[f"txt_{c}"]
        uniq, names = tops.get(c, (0, None))
        out.append(("character", c, miss, (n - miss) / n if n else None, None, None,
                    None, None, None, None, None, None, uniq, names))
    return df.sparkSession.createDataFrame(out, (
        "type string, variable string, n_missing long, complete_rate double, mean double, sd double, "
        "p0 double, p25 double, p50 double, p75 double, p100 double, hist string, "
        "n_unique long, top_counts string"
    ))


def _text_tops(df: DataFrame, texts: list[str], k: int) -> dict:
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).alias("value")) for c in texts
    ])).alias("e")).select("e.*").where(F.col("value").isNotNull())
    counts = long.groupBy("variable", "value").agg(F.count("*").alias("n"))
    uniq = {r["variable"]: r["u"] for r in counts.groupBy("variable").agg(F.count("*").alias("u")).collect()}
    w = Window.partitionBy("variable").orderBy(F.desc("n"), "value")
    tops = counts.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).collect()
    out = {}
    for c in texts:
        mine = sorted((r for r in tops if r["variable"] == c), key=lambda r: r["r"])
        out[c] = (uniq.get(c, 0), ", ".join(f"{r['value']}: {r['n']}" for r in mine))
    return out


def grouped_profile(df: DataFrame, by: list[str], nums: list[str], texts: list[str] = (), bins: int = 8, top: int = 4) -> DataFrame:
    """The same profile for each group: one row per group and column.

    ``kind`` tells numeric from character columns; groups may be of any size.
    """
    keys, out = [*by, "variable"], None
    if nums:
        long = df.select(*by, F.explode(F.array(*[
            F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in nums
        ])).alias("e")).select(*by, "e.*")
        stats = long.groupBy(*keys).agg(
            F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("n_missing"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("sd"), F.min("value").alias("p0"), F.max("value").alias("p100"))
        stats = State(stats, keys)
        width = F.when(F.col("p100") > F.col("p0"), (F.col("p100") - F.col("p0")) / bins).otherwise(F.lit(1.0))
        bin_ = F.when(F.col("value").isNotNull(), F.least(F.floor((F.col("value") - F.col("p0")) / width), F.lit(bins - 1)))
        hist = stats.attach(long).groupBy(*keys).agg(F.array(*[F.count_if(bin_ == b) for b in range(bins)]).alias("counts"))
        most = F.greatest(F.array_max("counts"), F.lit(1))
        bars = F.transform("counts", lambda c: F.substring(F.lit("▁▂▃▄▅▆▇█"), F.least(F.floor(c * 8.0 / most), F.lit(7)).cast("int") + 1, F.lit(1)))
        mid = grouped_quantiles(long, keys, "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
        got = State(hist.select(*keys, F.array_join(bars, "").alias("hist")), keys).attach(State(mid, keys).attach(stats.df))
        out = got.select(
            *by, F.lit("numeric").alias("kind"), "variable", "n_missing", ((F.col("n") - F.col("n_missing")) / F.col("n")).alias("complete_rate"),
            "mean", "sd", "p0", "p25", "p50", "p75", "p100", "hist", F.lit(None).cast("long").alias("n_unique"), F.lit(None).cast("string").alias("top_counts"))
    if texts:
        long = df.select(*by, F.explode(F.array(*[
            F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in texts
        ])).alias("e")).select(*by, "e.*")
        counts = long.groupBy(*keys, "value").agg(F.count("*").alias("c"))
        known = F.col("value").isNotNull()
        stats = counts.groupBy(*keys).agg(
            F.sum("c").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("c"))).alias("n_missing"), F.count("value").alias("n_unique"))
        w = Window.partitionBy(*keys).orderBy(F.desc("c"), "value")
        tops = counts.where(known).withColumn("r", F.row_number().over(w)).where(F.col("r") <= top)
        tops = tops.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("r", F.concat_ws(": ", "value", F.col("c").cast("string")).alias("t")))).alias("ts"))
        tops = tops.select(*keys, F.array_join(F.col("ts.t"), ", ").alias("top_counts"))
        none = [F.lit(None).cast("double").alias(c) for c in ("mean", "sd", "p0", "p25", "p50", "p75", "p100")]
        got = State(tops, keys).attach(stats).select(
            *by, F.lit("character").alias("kind"), "variable", "n_missing", ((F.col("n") - F.col("n_missing")) / F.col("n")).alias("complete_rate"),
            *none, F.lit(None).cast("string").alias("hist"), "n_unique", "top_counts")
        out = got if out is None else out.unionByName(got)
    return out


def outlier_fences(df: DataFrame, cols: list[str], mult: float = 1.5) -> dict[str, tuple[float, float]]:
    """Tukey fences per column."""
    q = quantiles(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = q[c]
        if q1 is not None:
            out[c] = (q1 - mult * (q3 - q1), q3 + mult * (q3 - q1))
    return out


def outside(col: Column, fence: tuple[float, float]) -> Column:
    return (col < fence[0]) | (col > fence[1])
