"""Correlation, group tests and normality."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import dist
from tallyframe.plans.moments import Moments, moments


def correlation(df: DataFrame, cols: list[str]) -> Moments:
    """Moments of the complete rows; ``.corr()`` is the Pearson matrix."""
    return moments(df, {c: F.col(c).cast("double") for c in cols})


def correlation_long(spark: SparkSession, m: Moments) -> DataFrame:
    r = m.corr()
    rows = [(a, b, float(r[i, j])) for i, a in enumerate(m.names) for j, b in enumerate(m.names)]
    return spark.createDataFrame(rows, "row string, col string, r double")


def strength(r: Column) -> Column:
    """Verbal band of |r|."""
    a = F.abs(r)
    return (
        F.when(a < 0.2, "negligible").when(a < 0.4, "weak").when(a < 0.6, "moderate")
        .when(a < 0.8, "strong").otherwise("very strong")
    )


def correlation_test(df: DataFrame, x: str, y: str, level: float = 0.95) -> dict:
    m = correlation(df, [x, y])
    n, r = int(m.n), float(m.corr()[0, 1])
    out = {"estimate": r, "statistic": None, "df": n - 2, "p_value": None, "conf_low": None, "conf_high": None}
    if math.isnan(r) or n < 3:
        return out
    if abs(r) >= 1:  # exact line
        return out | {"statistic": math.copysign(math.inf, r), "p_value": 0.0, "conf_low": r, "conf_high": r}
    t = r * math.sqrt((n - 2) / (1 - r * r))
    out |= {"statistic": t, "p_value": dist.t_two_sided(t, n - 2)}
    if n > 3:
        z, half = math.atanh(r), dist.normal_quantile(0.5 + level / 2) / math.sqrt(n - 3)
        out |= {"conf_low": math.tanh(z - half), "conf_high": math.tanh(z + half)}
    return out


def anova_oneway(df: DataFrame, y: str, g: str) -> DataFrame:
    """Between and within sums of squares with F and p.

    Group counts, means and spreads are folded on Spark, so any number of groups
    is fine.
    """
    v = F.col(y).cast("double")
    groups = df.where(v.isNotNull() & F.col(g).isNotNull()).groupBy(g).agg(
        F.count("*").alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v"))
    row = groups.agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("ssw"),
        F.sum(F.col("n") * F.col("m")).alias("sm"),
    ).first()
    k, n, ssw = row["k"], row["n"] or 0, row["ssw"] or 0.0
    grand = (row["sm"] or 0.0) / max(n, 1)
    ssb = groups.agg(F.sum(F.col("n") * (F.col("m") - grand) * (F.col("m") - grand))).first()[0] or 0.0
    between = ssb / (k - 1) if k > 1 else math.nan
    within = ssw / (n - k) if n > k else math.nan
    if math.isnan(between) or math.isnan(within) or within == 0 and between == 0:
        f = p = math.nan
    elif within == 0:
        f, p = math.inf, 0.0
    else:
        f = between / within
        p = dist.f_upper(f, k - 1, n - k)
    rows = [(g, max(k - 1, 0), ssb, between, f, p), ("Residuals", n - k, ssw, within, None, None)]
    return df.sparkSession.createDataFrame(
        rows, "term string, df long, sum_sq double, mean_sq double, statistic double, p_value double")


def jarque_bera(df: DataFrame, x: Column) -> DataFrame:
    """Normality from skewness and kurtosis, for any number of rows."""
    jb = F.count(x) / 6.0 * (F.pow(F.skewness(x), 2) + F.pow(F.kurtosis(x), 2) / 4.0)
    return df.agg(F.count(x).alias("n"), F.skewness(x).alias("skewness"),
                  F.kurtosis(x).alias("kurtosis"), jb.alias("statistic"), F.exp(-jb / 2).alias("p_value"))
