"""Ordinary least squares from moments, with inference and per-row diagnostics.

A model is a dict of named column expressions.  Fitting is one aggregate job;
solving is p×p algebra; predictions and diagnostics are column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import dist
from tallyframe.operators.ordering import adjacent_sums
from tallyframe.operators.quantiles import quantiles
from tallyframe.plans.moments import Moments, moments

# A column whose variance is explained by the earlier ones to this share is
# left out, as a later alias of them.
ALIAS_TOLERANCE = 1e-11
Y = "__y"


# ── model terms ──────────────────────────────────────────────────────────────

def numeric(*names: str) -> dict[str, Column]:
    return {nm: F.col(nm).cast("double") for nm in names}


def factor(name: str, levels: list) -> dict[str, Column]:
    """Treatment dummies; the first level is the reference.  A level outside the list is
    unknown: its rows are not fitted and get no prediction."""
    known = F.col(name).isin(levels)
    return {f"{name}{lv}": F.when(known, (F.col(name) == F.lit(lv)).cast("double")) for lv in levels[1:]}


def product(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    return {f"{i}:{j}": x * y for i, x in a.items() for j, y in b.items()}


def crossed(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Main effects plus products."""
    return {**a, **b, **product(a, b)}


def polynomial_state(df: DataFrame, col: str, degree: int) -> list[tuple[float, float, float]]:
    """Recurrence (shift, ratio, norm) of orthogonal polynomials on the data.

    Inner products of polynomials need only the power sums up to 2·degree, taken
    about a shifted and scaled x in one job.
    """
    x = F.col(col).cast("double")
    row = df.agg(F.count(x).alias("n"), F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).first()
    m, s = row["m"], row["s"] or 1.0
    z = (x - m) / s
    sums = df.agg(*[F.sum(F.pow(z, F.lit(k))).alias(f"k{k}") for k in range(2 * degree + 1)]).first()
    power = np.array(list(sums), dtype=float)

    def inner(a, b):
        c = np.convolve(a, b)
        return float(c @ power[: len(c)])

    basis, state = [np.array([1.0])], [(m, s, 0.0)]
    norms = [inner(basis[0], basis[0])]
    for k in range(1, degree + 1):
        prev = basis[-1]
        shifted = np.convolve(prev, [0.0, 1.0])
        alpha = inner(shifted, prev) / norms[-1]
        beta = norms[-1] / norms[-2] if k > 1 else 0.0
        nxt = shifted - alpha * np.append(prev, 0.0)
        if k > 1:
            nxt[: len(basis[-2])] -= beta * basis[-2]
        basis.append(nxt)
        norms.append(inner(nxt, nxt))
        state.append((alpha, beta, math.sqrt(norms[-1])))
    return state


def polynomial(col: str, state: list[tuple[float, float, float]]) -> dict[str, Column]:
    """Orthonormal polynomial columns col_1…col_degree from a fitted recurrence."""
    m, s, _ = state[0]
    z = (F.col(col).cast("double") - m) / s
    before, now, out = F.lit(0.0), F.lit(1.0), {}
    for k, (alpha, beta, norm) in enumerate(state[1:], start=1):
        before, now = now, (z - alpha) * now - beta * before
        out[f"{col}_{k}"] = now / norm
    return out


# ── fit ──────────────────────────────────────────────────────────────────────

@dataclass
class Fit:
    terms: dict[str, Column]
    y: Column
    m: Moments                   # kept terms and the target
    kept: list[str]
    aliased: list[str]
    b: np.ndarray                # slopes of kept terms
    inv: np.ndarray              # inverse of centred X'X
    rss: float
    extra: dict = field(default_factory=dict)

    @property
    def n(self) -> int:
        return int(round(self.m.n))

    @property
    def p(self) -> int:
        return len(self.kept)

    @property
    def df_resid(self) -> int:
        return self.n - self.p - 1

    @property
    def xbar(self) -> np.ndarray:
        return self.m.mean[:-1]

    @property
    def ybar(self) -> float:
        return float(self.m.mean[-1])

    @property
    def tss(self) -> float:
        return float(self.m.sxx[-1, -1])

    @property
    def intercept(self) -> float:
        return self.ybar - float(self.b @ self.xbar)

    @property
    def coef(self) -> dict[str, float]:
        return {"(Intercept)": self.intercept, **dict(zip(self.kept, map(float, self.b)))}

    @property
    def sigma(self) -> float:
        return math.sqrt(self.rss / self.df_resid) if self.df_resid > 0 else math.nan

    @property
    def r2(self) -> float:
        return 1.0 - self.rss / self.tss if self.tss > 0 else math.nan

    @property
    def std_error(self) -> dict[str, float]:
        v0 = 1.0 / self.n + float(self.xbar @ self.inv @ self.xbar)
        out = {"(Intercept)": self.sigma * math.sqrt(v0)}
        for nm, v in zip(self.kept, np.diag(self.inv)):
            out[nm] = self.sigma * math.sqrt(v)
        return out

    @property
    def loglik(self) -> float:
        if self.rss <= 0.0:
            return math.inf
        return -0.5 * self.n * (math.log(2 * math.pi * self.rss / self.n) + 1.0)

    @property
    def aic(self) -> float:
        return -2.0 * self.loglik + 2.0 * (self.p + 2)

    @property
    def bic(self) -> float:
        return -2.0 * self.loglik + math.log(self.n) * (self.p + 2)

    # tables

    def tidy_rows(self, level: float = 0.95) -> list[tuple]:
        t = dist.t_quantile(0.5 + level / 2.0, self.df_resid)
        se, rows = self.std_error, []
        for nm, est in self.coef.items():
            stat = est / se[nm] if se[nm] else math.nan
            rows.append((nm, est, se[nm], stat, dist.t_two_sided(stat, self.df_resid),
                         est - t * se[nm], est + t * se[nm]))
        return rows

    def tidy(self, spark: SparkSession, level: float = 0.95) -> DataFrame:
        return spark.createDataFrame(self.tidy_rows(level), (
            "term string, estimate double, std_error double, statistic double, "
            "p_value double, conf_low double, conf_high double"
        ))

    def glance_row(self) -> dict:
        k, d2 = self.p, self.df_resid
        f = math.nan
        if k and d2 > 0:
            f = ((self.tss - self.rss) / k) / (self.rss / d2) if self.rss > 0 else math.inf
        return {
            "r_squared": self.r2,
            "adj_r_squared": 1.0 - (1.0 - self.r2) * (self.n - 1) / d2 if d2 > 0 else math.nan,
            "sigma": self.sigma, "statistic": f,
            "p_value": dist.f_upper(f, k, d2) if k else math.nan,
            "df": k, "aic": self.aic, "bic": self.bic, "df_residual": d2, "nobs": self.n,
        }

    def glance(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(self.glance_row().values())], (
            "r_squared double, adj_r_squared double, sigma double, statistic double, p_value double, "
            "df int, aic double, bic double, df_residual long, nobs long"
        ))

    # column expressions

    def prediction(self) -> Column:
        out = F.lit(self.intercept)
        for nm, b in zip(self.kept, self.b):
            out = out + float(b) * self.terms[nm]
        return out

    def leverage(self) -> Column:
        """1/n + (x−x̄)'(X'X)⁻¹(x−x̄)."""
        d = [self.terms[nm] - float(mu) for nm, mu in zip(self.kept, self.xbar)]
        out = F.lit(1.0 / self.n)
        for i in range(self.p):
            out = out + float(self.inv[i, i]) * d[i] * d[i]
            for j in range(i + 1, self.p):
                out = out + 2.0 * float(self.inv[i, j]) * d[i] * d[j]
        return out

    def predict(self, df: DataFrame, name: str = "fit") -> DataFrame:
        return df.withColumn(name, self.prediction())

    def predict_interval(self, df: DataFrame, kind: str = "confidence", level: float = 0.95,
                         names=("fit", "lwr", "upr")) -> DataFrame:
        t = dist.t_quantile(0.5 + level / 2.0, self.df_resid)
        extra = 1.0 if kind == "prediction" else 0.0
        half = t * self.sigma * F.sqrt(self.leverage() + extra)
        fit, lwr, upr = names
        return (
            df.withColumn(fit, self.prediction()).withColumn("__half", half)
            .withColumn(lwr, F.col(fit) - F.col("__half")).withColumn(upr, F.col(fit) + F.col("__half"))
            .drop("__half")
        )

    def augment(self, df: DataFrame) -> DataFrame:
        """Fitted, residual, leverage, standardised residual and Cook's distance."""
        s2 = self.sigma ** 2
        e, h = F.col("resid"), F.col("hat")
        left = F.when(1.0 - h >= 1e-10, 1.0 - h)  # a row that fits itself has no measure
        return (
            df.withColumn("fitted", self.prediction())
            .withColumn("resid", self.y - F.col("fitted"))
            .withColumn("hat", self.leverage())
            .withColumn("std_resid", F.try_divide(e, self.sigma * F.sqrt(left)))
            .withColumn("cooksd", F.try_divide(e * e * h, (self.p + 1) * s2 * left * left))
        )


def solve(m: Moments, terms: dict[str, Column], y: Column, names: list[str] | None = None,
          target: str = Y) -> Fit:
    """Sweep terms in order, leaving out those explained by earlier ones."""
    names = list(terms) if names is None else names
    a = m.pick([*names, target]).sxx.copy()
    diag = np.diag(a).copy()
    kept, aliased = [], []
    for i, nm in enumerate(names):
        if diag[i] <= 0 or a[i, i] <= ALIAS_TOLERANCE * diag[i]:
            aliased.append(nm)
            continue
        piv, col, row = a[i, i], a[:, i].copy(), a[i, :].copy()
        a -= np.outer(col, row) / piv
        a[:, i], a[i, :] = col / piv, row / piv
        a[i, i] = -1.0 / piv
        kept.append(nm)
    k = [names.index(nm) for nm in kept]
    sub = m.pick([*kept, target])
    return Fit({nm: terms[nm] for nm in kept}, y, sub, kept, aliased, a[k, -1].copy(),
               -a[np.ix_(k, k)], max(float(a[-1, -1]), 0.0))


def fit(df: DataFrame, y: str | Column, terms: dict[str, Column]) -> Fit:
    target = F.col(y) if isinstance(y, str) else y
    target = target.cast("double")
    return solve(moments(df, {**terms, Y: target}), terms, target)


def complete_rows(df: DataFrame, y: Column, terms: dict[str, Column]) -> DataFrame:
    """Rows a model on these columns uses."""
    cond = y.isNotNull()
    for c in terms.values():
        cond = cond & c.isNotNull()
    return df.where(cond)


# ── model-level operators ────────────────────────────────────────────────────

def residual_summary(df: DataFrame, f: Fit) -> list[float]:
    r = complete_rows(df, f.y, f.terms).select((f.y - f.prediction()).alias("resid"))
    return quantiles(r, ["resid"], [0.0, 0.25, 0.5, 0.75, 1.0])["resid"]


def anova_nested(small: Fit, big: Fit) -> dict:
    d = small.df_resid - big.df_resid
    if d <= 0 or big.df_resid <= 0 or big.rss <= 0:
        return {"df": d, "sum_sq": small.rss - big.rss, "statistic": math.nan, "p_value": math.nan}
    f = ((small.rss - big.rss) / d) / (big.rss / big.df_resid)
    return {"df": d, "sum_sq": small.rss - big.rss, "statistic": f, "p_value": dist.f_upper(f, d, big.df_resid)}


def step_criterion(f: Fit) -> float:
    return (f.n * math.log(f.rss / f.n) if f.rss > 0 else -math.inf) + 2.0 * (f.p + 1)


def stepwise(m: Moments, terms: dict[str, Column], y: Column, direction: str = "both",
             start: list[str] | None = None) -> tuple[Fit, list[tuple[str, float]]]:
    """Add or drop one term at a time while the criterion falls.  No Spark job."""
    scope = list(terms)
    now = list(start if start is not None else ([] if direction == "forward" else scope))
    best = solve(m, terms, y, now)
    trace = [("<start>", step_criterion(best))]
    while True:
        moves = []
        if direction in ("backward", "both"):
            moves += [(f"- {t}", [x for x in now if x != t]) for t in now]
        if direction in ("forward", "both"):
            moves += [(f"+ {t}", [x for x in scope if x in now or x == t]) for t in scope if t not in now]
        tried = [(step_criterion(solve(m, terms, y, nms)), label, nms) for label, nms in moves]
        if not tried:
            break
        score, label, names = min(tried, key=lambda t: t[0])
        if score >= trace[-1][1] - 1e-9:
            break
        now, best = names, solve(m, terms, y, names)
        trace.append((label, score))
    return best, trace


def variance_inflation(m: Moments, names: list[str]) -> dict[str, float]:
    """Diagonal of the inverse correlation matrix; infinite for exact collinearity."""
    r = m.pick(names).corr()
    if np.linalg.matrix_rank(r, tol=1e-10) < len(names):
        out = {}
        for i, nm in enumerate(names):
            rest = [j for j in range(len(names)) if j != i]
            sol = np.linalg.lstsq(r[np.ix_(rest, rest)], r[rest, i], rcond=1e-10)[0]
            left = 1.0 - float(r[rest, i] @ sol)
            out[nm] = math.inf if left < 1e-10 else 1.0 / left
        return out
    return dict(zip(names, map(float, np.diag(np.linalg.inv(r)))))


def durbin_watson(df: DataFrame, f: Fit, order: list[str], by: list[str] = ()) -> float:
    rows = complete_rows(df, f.y, f.terms)
    s = adjacent_sums(rows, f.y - f.prediction(), order, by)
    return s["sq"] / s["vv"] if s["vv"] else math.nan


def breusch_pagan(df: DataFrame, f: Fit) -> dict:
    """n·R² of squared residuals on the model's terms."""
    e2 = (f.y - f.prediction()) * (f.y - f.prediction())
    aux = fit(complete_rows(df, f.y, f.terms), e2, f.terms)
    stat = aux.n * aux.r2
    return {"statistic": stat, "df": aux.p, "p_value": dist.chi2_upper(stat, aux.p)}


def studentised(f: Fit) -> Column:
    """Externally studentised residual from augmented columns."""
    e, h = F.col("resid"), F.col("hat")
    left = (f.rss - e * e / (1.0 - h)) / (f.df_resid - 1)
    return e / F.sqrt(left * (1.0 - h))


def outlier_test(df: DataFrame, f: Fit, key: list[str], top: int = 1) -> list[dict]:
    rows = (
        f.augment(complete_rows(df, f.y, f.terms)).select(*key, studentised(f).alias("rstudent"))
        .orderBy(F.desc(F.abs("rstudent")), *key).limit(top).collect()
    )
    out = []
    for r in rows:
        p = dist.t_two_sided(r["rstudent"], f.df_resid - 1)
        out.append({**{k: r[k] for k in key}, "rstudent": r["rstudent"], "p_value": p,
                    "bonferroni_p": min(1.0, p * f.n)})
    return out


def coefficient_shift(df: DataFrame, f: Fit, key: list[str]) -> dict[str, float]:
    """Coefficients minus those without the row of largest Cook's distance."""
    top = (
        f.augment(complete_rows(df, f.y, f.terms))
        .orderBy(F.desc("cooksd"), *key)
        .select(*[f.terms[nm].cast("double").alias(f"x{i}") for i, nm in enumerate(f.kept)], f.y.alias("y"))
        .limit(1).first()
    )
    less = f.m.without_row(np.array(list(top), dtype=float))
    g = solve(less, f.terms, f.y, f.kept, target=f.m.names[-1])
    return {nm: v - g.coef.get(nm, math.nan) for nm, v in f.coef.items()}


def stars(p: Column) -> Column:
    return (
        F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").when(p < 0.1, ".").otherwise("")
    )
