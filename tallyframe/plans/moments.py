"""Counts, sums and cross-products of model columns: the state behind regression.

Moments are additive, so folds, bands and nested column sets need no rescan:
the moments of "all rows but fold k" are total − fold k.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this many columns the p²/2 aggregate expressions outgrow generated code
# and a block product per Arrow batch is faster.
WIDE = 12


@dataclass
class Moments:
    names: list[str]
    center: np.ndarray      # fixed shift, near the data, keeps digits
    n: float
    s: np.ndarray           # Σ(x−c)
    p: np.ndarray           # Σ(x−c)(x−c)'

    @property
    def mean(self) -> np.ndarray:
        return self.center + self.s / self.n

    @property
    def sxx(self) -> np.ndarray:
        """Cross-products about the means."""
        return self.p - np.outer(self.s, self.s) / self.n

    def __add__(self, o: Moments) -> Moments:
        return Moments(self.names, self.center, self.n + o.n, self.s + o.s, self.p + o.p)

    def __sub__(self, o: Moments) -> Moments:
        return Moments(self.names, self.center, self.n - o.n, self.s - o.s, self.p - o.p)

    def without_row(self, x: np.ndarray) -> Moments:
        d = x - self.center
        return Moments(self.names, self.center, self.n - 1, self.s - d, self.p - np.outer(d, d))

    def pick(self, names: list[str]) -> Moments:
        i = [self.names.index(nm) for nm in names]
        return Moments(names, self.center[i], self.n, self.s[i], self.p[np.ix_(i, i)])

    def cov(self) -> np.ndarray:
        return self.sxx / (self.n - 1)

    def corr(self) -> np.ndarray:
        sd = np.sqrt(np.diag(self.sxx))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = self.sxx / np.outer(sd, sd)
        r[np.diag_indices_from(r)] = 1.0
        return np.clip(r, -1.0, 1.0)


# Rows that a first centre is taken from; any value among the data will do.
FIRST = 4096
# A mean this many standard deviations from the centre costs digits: sum again about it.
FAR = 1e4


def _means(row) -> np.ndarray:
    return np.array([0.0 if v is None or not np.isfinite(v) else v for v in row])


def grouped_moments(df: DataFrame, terms: dict[str, Column], by: Column | None = None, first: DataFrame | None = None) -> dict:
    """Moments per value of ``by`` (a bounded key such as a fold), complete rows only.

    One scan: the centre, which need only lie near the data, comes from a few rows (of
    ``first``, where df has copies of rows).  Should the means turn out to be far from it,
    as when those rows are outliers, the sums are made again about the means.
    """
    names = list(terms)
    key = by if by is not None else F.lit(0)

    def chosen(frame: DataFrame, *more: Column) -> DataFrame:
        cells = [c.cast("double").alias(f"m{i}") for i, c in enumerate(terms.values())]
        return frame.select(*more, *cells).dropna(subset=[f"m{i}" for i in range(len(names))])

    data = chosen(df, key.alias("g"))
    sums = _sum_moments if len(names) <= WIDE else _block_moments
    if not names:
        return sums(data, names, np.zeros(0))
    few = chosen(df if first is None else first).limit(FIRST)
    got = sums(data, names, _means(few.agg(*[F.avg(f"m{i}") for i in range(len(names))]).first()))
    if got:
        every = total(got.values())
        sd = np.sqrt(np.maximum(np.diag(every.sxx), 0) / every.n)
        off = np.abs(every.s / every.n)
        if every.n > 1 and np.any(off > FAR * np.maximum(sd, 1e-12 * np.abs(every.center))):
            got = sums(data, names, _means(every.mean))
    return got


def moments(df: DataFrame, terms: dict[str, Column]) -> Moments:
    got = grouped_moments(df, terms)
    if got:
        return got[0]
    k = len(terms)
    return Moments(list(terms), np.zeros(k), 0, np.zeros(k), np.zeros((k, k)))


def total(parts) -> Moments:
    parts = list(parts)
    out = parts[0]
    for m in parts[1:]:
        out = out + m
    return out


def _sum_moments(data: DataFrame, names: list[str], c: np.ndarray) -> dict:
    k = len(names)
    d = data.select("g", *[(F.col(f"m{i}") - float(c[i])).alias(f"d{i}") for i in range(k)])
    rows = d.groupBy("g").agg(
        F.count("*").alias("n"),
        *[F.sum(f"d{i}").alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)],
    ).collect()
    out = {}
    for r in rows:
        p = np.empty((k, k))
        for i in range(k):
            for j in range(i, k):
                p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        out[r["g"]] = Moments(names, c, r["n"], np.array([r[f"s{i}"] for i in range(k)]), p)
    return out


def _block_moments(data: DataFrame, names: list[str], c: np.ndarray) -> dict:
    """Per-partition X'X blocks (first column is 1), added cell by cell on Spark."""
    k = len(names)
    shift = c.copy()

    def blocks(batches):
        sums: dict = {}
        for b in batches:
            x = np.column_stack([np.ones(b.num_rows)] + [
                b.column(i + 1).to_numpy(zero_copy_only=False) - shift[i] for i in range(k)
            ])
            g = b.column(0).to_numpy(zero_copy_only=False)
            for v in np.unique(g):
                xv = x[g == v]
                sums[v] = sums.get(v, 0.0) + xv.T @ xv
        if sums:
            up = np.triu_indices(k + 1)
            cells = len(up[0])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(list(sums), cells).astype("int64")),
                pa.array(np.tile(np.arange(cells), len(sums)).astype("int32")),
                pa.array(np.concatenate([m[up] for m in sums.values()])),
            ], names=["g", "cell", "v"])

    rows = (
        data.withColumn("g", F.col("g").cast("long"))
        .mapInArrow(blocks, "g long, cell int, v double")
        .groupBy("g", "cell").agg(F.sum("v").alias("v")).collect()
    )
    up = np.triu_indices(k + 1)
    full: dict = {}
    for r in rows:
        m = full.setdefault(r["g"], np.zeros((k + 1, k + 1)))
        i, j = up[0][r["cell"]], up[1][r["cell"]]
        m[i, j] = m[j, i] = r["v"]
    return {
        g: Moments(names, c, m[0, 0], m[0, 1:].copy(), m[1:, 1:].copy()) for g, m in full.items()
    }
