"""Fitted preprocessing: declare steps, learn them on training rows, apply anywhere.

A step is a function ``(train, columns, **options) -> apply`` where ``apply`` maps
a frame to a frame with nothing but column expressions and joins to bounded
state.  Steps see the training frame as the earlier steps left it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalars import date_features
from tallyframe.operators import features, frequent, nearest
from tallyframe.operators.frame import numeric_columns, text_columns
from tallyframe.operators.neighbors import donors, neighbor_means
from tallyframe.plans import bagging
from tallyframe.plans.moments import moments
from tallyframe.plans.ols import polynomial, polynomial_state
from tallyframe.session import State, materialize

Apply = Callable[[DataFrame], DataFrame]


# ── selectors ────────────────────────────────────────────────────────────────

def all_predictors(df, outcome, keys):
    return [c for c in df.columns if c != outcome and c not in keys]


def all_numeric_predictors(df, outcome, keys):
    nums = numeric_columns(df)
    return [c for c in all_predictors(df, outcome, keys) if c in nums]


def all_nominal_predictors(df, outcome, keys):
    texts = text_columns(df)
    return [c for c in all_predictors(df, outcome, keys) if c in texts]


class Recipe:
    def __init__(self, outcome: str, predictors: list[str], keys: list[str] = ()):
        self.outcome, self.predictors, self.keys = outcome, list(predictors), list(keys)
        self.steps: list[tuple] = []

    def step(self, fit: Callable, cols=all_predictors, skip: bool = False, **options) -> Recipe:
        """``skip`` keeps the step to the training rows: new rows are baked without it."""
        self.steps.append((fit, cols, skip, options))
        return self

    def prep(self, train: DataFrame) -> Prepped:
        names = [*self.keys, self.outcome, *self.predictors]
        df, done = train.select(*names), []
        for fit, cols, skip, options in self.steps:
            if callable(cols):
                cols = cols(df, self.outcome, self.keys)
            apply = fit(df, list(cols), **options)
            df = apply(df)
            if not skip:
                done.append(apply)
        return Prepped(names, done, df)


class Prepped:
    def __init__(self, names: list[str], applies: list[Apply], trained: DataFrame):
        self.names, self.applies, self.trained = names, applies, trained

    def bake(self, df: DataFrame | None = None) -> DataFrame:
        """Transformed rows of df, or of the training frame itself."""
        if df is None:
            return self.trained
        df = df.select(*self.names)
        for apply in self.applies:
            df = apply(df)
        return df


def _same(df: DataFrame) -> DataFrame:
    return df


def _dropping(cols: list[str]) -> Apply:
    return lambda df: df.drop(*cols)


def _replacing(exprs: dict[str, Column]) -> Apply:
    return lambda df: df.withColumns(exprs) if exprs else df


# ── selection ────────────────────────────────────────────────────────────────

def zv(train, cols):
    """Drop columns with a single value."""
    row = train.agg(*[(F.min(c) == F.max(c)).alias(c) for c in cols]).first()
    return _dropping([c for c in cols if row[c] is None or row[c]])


def nzv(train, cols, freq_cut: float = 95 / 5, unique_cut: float = 10.0):
    """Drop columns dominated by one value and with few distinct values."""
    return _dropping(frequent.near_zero_variance(train, cols, freq_cut, unique_cut))


def corr(train, cols, threshold: float = 0.9):
    """Drop the column with the larger mean |r| of each pair above threshold."""
    if len(cols) < 2:
        return _same
    r = np.abs(moments(train, {c: F.col(c).cast("double") for c in cols}).corr())
    np.fill_diagonal(r, 0.0)
    live, gone = list(range(len(cols))), []
    while len(live) > 1:
        sub = r[np.ix_(live, live)]
        i, j = np.unravel_index(np.argmax(sub), sub.shape)
        if sub[i, j] <= threshold:
            break
        mean = sub.sum(axis=1) / (len(live) - 1)
        gone.append(cols[live.pop(i if mean[i] >= mean[j] else j)])
    return _dropping(gone)


def select(train, cols, keep: list[str]):
    return lambda df: df.select(*keep)


def pca(train, cols, num: int = 5, prefix: str = "PC"):
    """Scores on the leading components; each loading's largest entry is positive."""
    m = moments(train, {c: F.col(c).cast("double") for c in cols})
    val, vec = np.linalg.eigh(m.cov())
    lead = np.argsort(val)[::-1][:num]
    exprs = {}
    for k, j in enumerate(lead, start=1):
        load = vec[:, j] * np.sign(vec[np.argmax(np.abs(vec[:, j]) > np.abs(vec[:, j]).max() - 1e-9), j])
        out = F.lit(0.0)
        for c, mu, b in zip(cols, m.mean, load):
            out = out + (F.col(c) - float(mu)) * float(b)
        exprs[f"{prefix}{k}"] = out
    return lambda df: df.withColumns(exprs).drop(*cols)


# ── missing values ───────────────────────────────────────────────────────────

def _fill(state: dict) -> Apply:
    return lambda df: features.fill(df, state)


def impute_median(train, cols):
    return _fill(features.fit_median(train, cols)) if cols else _same


def impute_mean(train, cols):
    return _fill(features.fit_mean(train, cols)) if cols else _same


def impute_mode(train, cols):
    return _fill(features.fit_mode(train, cols))


def impute_bag(train, cols, by: list[str], keys: list[str], **options):
    """Fill from bagged regression trees on other numeric columns, whose own NULLs read as
    medians.  ``keys`` name a row for its bootstrap weights; options go to the fit."""
    medians = features.fit_median(train, by)
    forests = {c: bagging.fit(train, c, by, keys, medians, **options) for c in cols}
    xs = [F.coalesce(F.col(b).cast("double"), F.lit(medians[b])) for b in by]
    return _replacing({c: F.coalesce(F.col(c).cast("double"), f.prediction(xs)) for c, f in forests.items()})


def impute_knn(train, cols, by: str | list[str], neighbors: int = 5):
    """Fill from the nearest training rows along one or several numeric predictors.

    Several are compared by the sum of differences, each over its range in training.
    Rows of which a predictor is NULL too stay NULL.
    """
    by = [by] if isinstance(by, str) else list(by)
    xs = [f"x{j}" for j in range(len(by))]
    several = len(by) > 1
    known = {c: nearest.Donors(train, c, by) if several else materialize(donors(train, c, by[0])) for c in cols}

    def apply(df):
        for c, donor in known.items():
            points = df.where(F.col(c).isNull()).select(*[F.col(b).cast("double").alias(x) for b, x in zip(by, xs)])
            if several:
                points = points.where(nearest.known_point(xs)).distinct()
                means = nearest.neighbor_means(donor, points, neighbors)
            else:
                points = points.where(F.col("x0").isNotNull()).groupBy(F.col("x0").alias("x")).agg(F.count("*").alias("rows"))
                means = neighbor_means(donor, points, neighbors).select(F.col("x").alias("x0"), "value")
            keys = [f"__{x}" for x in xs]
            means = means.select(*[F.col(x).alias(k) for x, k in zip(xs, keys)], F.col("value").alias("__value"))
            out = State(means, keys).attach(df.withColumns({k: F.col(b).cast("double") for k, b in zip(keys, by)}))
            df = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col("__value"))).drop(*keys, "__value")
        return df

    return apply


def unknown(train, cols, label: str = "unknown"):
    return _replacing({c: F.coalesce(F.col(c), F.lit(label)) for c in cols})


# ── categories ───────────────────────────────────────────────────────────────

def other(train, cols, threshold: float = 0.05, label: str = "other"):
    """Lump levels rarer than threshold; at most 1/threshold levels are kept."""
    exprs = {}
    for c in cols:
        counts = train.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        total = counts.agg(F.sum("n")).first()[0] or 0
        keep = [r[0] for r in counts.where(F.col("n") >= threshold * total).collect()]
        exprs[c] = F.when(F.col(c).isin(*keep), F.col(c)).when(F.col(c).isNotNull(), F.lit(label))
    return _replacing(exprs)


def dummy(train, cols, one_hot: bool = False):
    levels = {c: features.fit_levels(train, c) for c in cols}

    def apply(df):
        for c, lv in levels.items():
            df = features.one_hot(df, c, lv, drop_first=not one_hot)
        return df

    return apply


def integer(train, cols):
    """Level number in sorted order; 0 for levels not seen in training.  Any number of levels."""
    ids = {c: features.LevelIds(train, c) for c in cols}

    def apply(df):
        for c, numbers in ids.items():
            df = numbers.attach(df, c)
        return df

    return apply


# ── numeric transforms ───────────────────────────────────────────────────────

def log(train, cols, offset: float = 0.0, base: float | None = None):
    """Natural logarithm, or to another base."""
    scale = 1.0 if base is None else math.log(base)
    return _replacing({c: F.ln(F.col(c) + offset) / F.lit(scale) for c in cols})


def sqrt(train, cols):
    return _replacing({c: F.sqrt(F.col(c).cast("double")) for c in cols})


def box_cox(train, cols):
    return _replacing({c: features.box_cox(F.col(c), features.fit_box_cox(train, c)[0]) for c in cols})


def yeo_johnson(train, cols):
    return _replacing({c: features.yeo_johnson(F.col(c), features.fit_yeo_johnson(train, c)[0]) for c in cols})


def _rescaled(state: dict) -> Apply:
    return lambda df: features.rescale(df, state)


def normalize(train, cols):
    return _rescaled(features.fit_zscore(train, cols)) if cols else _same


def range_(train, cols):
    return _rescaled(features.fit_minmax(train, cols)) if cols else _same


def robust(train, cols):
    return _rescaled(features.fit_robust(train, cols)) if cols else _same


# ── feature creation ─────────────────────────────────────────────────────────

def poly(train, cols, degree: int = 2):
    states = {c: polynomial_state(train, c, degree) for c in cols}

    def apply(df):
        for c, st in states.items():
            df = df.withColumns(polynomial(c, st)).drop(c)
        return df

    return apply


def interact(train, cols, pairs: list[tuple[str, str]]):
    return _replacing({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs})


def ratio(train, cols, denominators: list[str]):
    return _replacing({
        f"{a}_o_{b}": F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
        for a in cols for b in denominators if a != b
    })


def date(train, cols, parts=("day_of_week", "month", "year")):
    exprs = {}
    for c in cols:
        made = date_features(F.col(c))
        exprs.update({f"{c}_{p}": made[p] for p in parts})
    return lambda df: df.withColumns(exprs).drop(*cols)
