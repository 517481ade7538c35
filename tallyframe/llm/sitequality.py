"""Quality classifier with hierarchical empirical Bayes over sites.

A document's own evidence is a logistic score of a few text measures.  Documents are
also grouped by site levels, the widest first (host, then host and path).  Each
site's good share is shrunk toward its parent's, and the widest toward the global
share, by as much as sites of that level vary beyond chance (method of moments), so a
site with few documents says little.  A document leaves its own score out of its
sites' sums.  Verdict: log-odds of the document, moved by the log-odds of its finest
site against the global share.

Everything over the corpus is a column expression or a grouped sum; only the fit sees
rows on the driver, ``fit_rows`` labelled rows of ten numbers at most.

Edge cases: NULL text counts as empty; NULL or missing sites form a site of their
own at their level; repeated rows count each; without labels of both kinds every
document scores by the prior alone (0.5); an empty table gives an empty result.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rules import BLANK, NOT_UPPER, SYMBOLS
from tallyframe.session import State, materialize

FIT_ROWS = 20_000
FEATURES = ["f_length", "f_word", "f_symbol", "f_upper", "f_distinct", "f_again", "f_line"]
RESULT = ["p_text", "p_site", "p_good", "site_rows", "kept"]


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without its text, with the measures the classifier reads."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kept = [c for c in docs.columns if c != text and c not in FEATURES]
    df = docs.select(
        *kept, F.array_remove(F.split(t, BLANK), "").alias("__w"),
        F.array_remove(F.split(t, "\n"), "").alias("__l"),
        F.length(F.regexp_replace(t, BLANK, "")).alias("__c"),
        F.length(F.regexp_replace(t, SYMBOLS, "")).alias("__s"),
        F.length(F.regexp_replace(t, NOT_UPPER, "")).alias("__u"),
    )
    n = F.greatest(F.size("__w"), F.lit(1))
    w = F.col("__w")
    again = F.zip_with(F.slice(w, 1, n - 1), F.slice(w, 2, n - 1), lambda a, b: a == b)
    return df.select(
        *kept,
        F.log1p(F.size("__w")).alias("f_length"),
        (F.col("__c") / n).alias("f_word"),
        F.log1p(10 * F.col("__s") / n).alias("f_symbol"),
        (F.col("__u") / F.greatest(F.col("__c"), F.lit(1))).alias("f_upper"),
        (F.log1p(F.size(F.array_distinct("__w"))) / F.log1p(n)).alias("f_distinct"),
        (F.size(F.filter(again, lambda x: x)) / n).alias("f_again"),
        (1 - F.size(F.array_distinct("__l")) / F.greatest(F.size("__l"), F.lit(1))).alias("f_line"),
    )


@dataclass(frozen=True)
class Model:
    """Weights over the raw features and the share of good rows it was fitted on."""

    weights: tuple[float, ...]
    bias: float
    share: float

    def log_odds(self) -> Column:
        z = F.lit(self.bias)
        for c, w in zip(FEATURES, self.weights):
            z = z + F.col(c) * F.lit(w)
        return F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))


def fit(feats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """Ridge logistic regression by Newton steps on at most ``fit_rows`` labelled rows,
    those with the smallest hashes of their key."""
    lab = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    lab = lab.groupBy(F.col(key).alias("__k")).agg(F.max(label).cast("double").alias("__y"))
    rows = feats.join(lab, feats[key] == lab["__k"]).select(*FEATURES, "__y", F.xxhash64("__k").alias("__h"))
    # a hash share first, so that tasks do not each send fit_rows rows
    n = lab.count()
    mark = F.pmod("__h", F.lit(2**31))
    rows = rows.where(mark <= int(min(1.0, 1.1 * fit_rows / max(n, 1)) * 2**31))
    got = rows.orderBy("__h", *FEATURES).limit(fit_rows).drop("__h").toPandas().to_numpy(float)
    y = got[:, -1] if len(got) else np.zeros(0)
    if len(np.unique(y)) < 2:
        return Model((0.0,) * len(FEATURES), 0.0, 0.5)
    x = got[:, :-1]
    mean, sd = x.mean(0), x.std(0)
    sd[sd < 1e-9] = 1.0
    a = np.column_stack([np.ones(len(x)), (x - mean) / sd])
    ridge = np.diag([1e-6] + [1.0] * x.shape[1])
    b = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    w = b[1:] / sd
    return Model(tuple(map(float, w)), float(b[0] - mean @ w), float(np.clip(y.mean(), 1e-3, 1 - 1e-3)))


def _strength(sites: DataFrame, prior: Column) -> float:
    """Rows a parent's share is worth for sites of one level: from how much more their
    shares vary about the prior than chance would have it."""
    w = sites.select("__n", (F.col("__good") / F.col("__n")).alias("m"), prior.alias("p"))
    got = w.agg(F.sum(F.col("__n") * (F.col("m") - F.col("p")) ** 2).alias("q"), F.count("*").alias("k"),
                F.sum(F.col("p") * (1 - F.col("p"))).alias("v"), F.sum("__n").alias("n"),
                F.sum(F.col("__n") * F.col("p") * (1 - F.col("p"))).alias("nv")).first()
    if not got.k or not got.nv:
        return 1e6
    between = (got.q - got.v) / got.n  # E[q] = sum of v + sum of n * between-variance
    mean_v = got.nv / got.n
    return float(np.clip(mean_v / between - 1, 1.0, 1e6)) if between > 0 else 1e6


def site_table(scored: DataFrame, levels: list[str]) -> tuple[DataFrame, float]:
    """One row per finest site: its rows and good rows (soft), its parent's shrunk share
    and the strength of that prior; and the global share."""
    cells = materialize(scored.groupBy(*levels).agg(F.count("*").cast("double").alias("__n"), F.sum("p_text").alias("__good")))
    total = cells.agg(F.sum("__n"), F.sum("__good")).first()
    share = float(np.clip((total[1] or 0.0) / (total[0] or 1.0), 1e-3, 1 - 1e-3))
    parents = None
    for depth in range(1, len(levels) + 1):
        by = levels[:depth]
        sites = cells.groupBy(*by).agg(F.sum("__n").alias("__n"), F.sum("__good").alias("__good"))
        if parents is None:
            sites = sites.withColumn("__prior", F.lit(share))
        else:
            sites = State(parents, by[:-1]).attach(sites)
        strength = _strength(sites, F.col("__prior"))
        sites = sites.withColumn("__strength", F.lit(strength))
        post = (F.col("__good") + strength * F.col("__prior")) / (F.col("__n") + strength)
        parents = sites.select(*by, post.alias("__prior"))
    return sites, share


def classify(docs: DataFrame, model: Model, levels: list[str], text: str = "text", keep_at: float = 0.5,
             feats: DataFrame | None = None) -> DataFrame:
    """docs (without its text) with p_text, p_site (shrunk share of good documents in its
    finest site, itself left out), p_good, site_rows and kept."""
    feats = features(docs, text) if feats is None else feats
    own = [c for c in feats.columns if c not in FEATURES + RESULT]
    scored = feats.select(*own, (1 / (1 + F.exp(-model.log_odds()))).alias("p_text"))
    sites, share = site_table(scored, levels)
    joined = State(sites.select(*levels, "__n", "__good", "__prior", "__strength"), levels).attach(scored)
    left_out = (F.col("__good") - F.col("p_text") + F.col("__strength") * F.col("__prior")) / (F.col("__n") - 1 + F.col("__strength"))
    p_site = F.greatest(F.least(left_out, F.lit(1 - 1e-4)), F.lit(1e-4))

    def odds(p):
        return F.log(p / (1 - p))

    z = odds(F.greatest(F.least(F.col("p_text"), F.lit(1 - 1e-6)), F.lit(1e-6))) + odds(F.col("p_site")) - float(np.log(share / (1 - share)))
    out = joined.withColumn("p_site", p_site).withColumn("p_good", 1 / (1 + F.exp(-z)))
    return out.select(*own, "p_text", "p_site", "p_good", F.col("__n").cast("long").alias("site_rows"),
                      (F.col("p_good") >= keep_at).alias("kept"))
