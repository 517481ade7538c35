"""Approximate nearest neighbours by learned partitions.

On a bounded sample (``SAMPLE`` rows by hash of their id) the neighbour graph is built
and cut into balanced parts by recursive bisection: each half takes the vertices below
and above the median of the graph's second eigenvector.  A small network with one hidden
layer learns each vertex's part and its neighbours' parts.  It then sends every row of
the table to its most probable part, and a query to as many parts as reach the wanted
recall on sample rows that were kept out of graph and training.  There all rows are
scored with the original vectors.  The number of parts follows the square root of the
rows (``SPREAD`` rows per squared part), so answers per query grow slowly.

Parts are cut into chunks of ``CHUNK`` rows and ``CHUNK`` queries, so a part with very
many (or very many equal) vectors is spread over tasks; each chunk answers with its
best ``k`` per query.

Edge cases: vectors that are NULL, zero, of another length than most of the sample, or
hold NULL or non-finite components take no part, and neither do rows without id.  Rows
equal in id and vector count once, and a query never meets rows with its own id.  Ties go
to smaller ids.  With fewer than ``EXACT`` rows there is one part, so the search is
exact.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import materialize

SAMPLE = 8000
SPREAD = 256
MOST_PARTS = 128
EXACT = 2000
CHUNK = 4000
HIDDEN = 128
RECALL = 0.95


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): double vectors that take part."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(fine & F.exists("v", lambda x: x != 0.0))


def neighbours(x: np.ndarray, k: int, among: np.ndarray | None = None) -> np.ndarray:
    """Rows of ``among`` (x itself by default, without the own row) by largest inner product."""
    base = x if among is None else among
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        s = x[a:a + 512] @ base.T
        if among is None:
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def bisect(graph: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """Balanced parts (a power of two) of a neighbour graph, one row of neighbours a vertex."""
    n, k = graph.shape
    rng = np.random.default_rng(seed)
    label = np.zeros(n, np.int64)
    src, dst = np.repeat(np.arange(n), k), graph.ravel()
    for _ in range(int(np.log2(parts))):
        inside = label[src] == label[dst]
        a, b = src[inside], dst[inside]
        degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1.0
        groups = label.max() + 1
        weight = np.bincount(label, degree, groups)
        x = rng.normal(size=n)
        for _ in range(60):  # power steps on the lazy walk, less each part's constant
            x -= (np.bincount(label, x * degree, groups) / weight)[label]
            y = x + np.bincount(a, x[b], n) + np.bincount(b, x[a], n)
            x = 0.5 * x + 0.5 * y / degree
            x /= np.sqrt(np.bincount(label, x * x, groups) + 1e-300)[label]
        order = np.lexsort((x, label))
        size = np.bincount(label, minlength=groups)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        label = 2 * label + (rank >= (size // 2)[label])
    return label


@dataclass
class Router:
    """One hidden layer; ``probes`` parts are searched for a query."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train(x: np.ndarray, target: np.ndarray, epochs: int = 20, seed: int = 4) -> Router:
    """target: wanted share of each part by row.  Adam steps on cross-entropy."""
    rng = np.random.default_rng(seed)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    d, p = x.shape[1], target.shape[1]
    w = [rng.normal(0, np.sqrt(2 / d) * 2, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, p)), np.zeros(p)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            i = order[a:a + 256]
            h = np.maximum(x[i] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            q = np.exp(z - z.max(1, keepdims=True))
            g = (q / q.sum(1, keepdims=True) - target[i]) / len(i)
            gh = (g @ w[2].T) * (h > 0)
            t += 1
            for j, grad in enumerate((x[i].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                grad = grad + 1e-5 * w[j]
                m[j] = 0.9 * m[j] + 0.1 * grad
                v[j] = 0.999 * v[j] + 0.001 * grad * grad
                w[j] = w[j] - rate * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)
    return Router(*w)


def fit(x: np.ndarray, rows: int, k: int, recall: float = RECALL) -> Router:
    """Router for a table of ``rows`` rows from a sample of its vectors in hash order."""
    parts = 1
    while parts < MOST_PARTS and rows > SPREAD * parts * parts and len(x) >= 64 * parts:
        parts *= 2
    d = x.shape[1]
    if rows < EXACT or parts < 2:
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    cut = len(x) * 4 // 5
    learn, ask = x[:cut], x[cut:]
    near = neighbours(learn, min(10, cut - 1))
    label = bisect(near, parts)
    target = np.zeros((cut, parts))
    np.add.at(target, (np.arange(cut), label), 5.0)
    np.add.at(target, (np.repeat(np.arange(cut), near.shape[1]), label[near].ravel()), 1.0)
    router = train(learn, target / target.sum(1, keepdims=True))
    # parts to search: the fewest that find enough of the kept-out rows' neighbours
    home = router.scores(learn).argmax(1)
    true = home[neighbours(ask, min(k, cut), learn)]
    rank = np.empty((len(ask), parts), np.int64)
    np.put_along_axis(rank, np.argsort(-router.scores(ask), axis=1), np.arange(parts)[None, :], 1)
    found = np.take_along_axis(rank, true, 1).ravel()
    share = np.cumsum(np.bincount(found, minlength=parts)) / len(found)
    router.probes = min(int(np.searchsorted(share, recall)) + 1, parts)
    return router


def matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1)


def route(rows: DataFrame, router: Router, probes: int, sizes: dict[int, int] | None = None, least: int = 0) -> DataFrame:
    """(id, v, part): each row in its ``probes`` most probable parts, and in as many more
    as it takes for them to hold ``least`` rows by the parts' ``sizes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = router.scores(matrix(batch.column(1)))
                top = np.argsort(-s, axis=1, kind="stable")
                n = np.full(len(s), min(probes, s.shape[1]))
                if sizes is not None:
                    held = np.array([sizes.get(p, 0) for p in range(s.shape[1])])
                    n = np.maximum(n, np.minimum((np.cumsum(held[top], axis=1) < least).sum(1) + 1, s.shape[1]))
                take = pa.array(np.repeat(np.arange(len(s)), n))
                chosen = top[np.arange(s.shape[1])[None, :] < n[:, None]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(chosen.astype(np.int32))],
                                                 names=["id", "v", "part"])

    return rows.mapInArrow(run, "id long, v array<double>, part int")


def nearest(table: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding",
            sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of table with the largest inner product
    for each row of queries."""
    rows = usable(table, key, vector).dropDuplicates()
    asked = usable(queries, key, vector).dropDuplicates()
    n = rows.count()
    share = F.lit(min(1.0, 1.2 * sample / max(n, 1)) * 2**31).cast("long")
    mark = F.pmod(F.xxhash64("id"), F.lit(2**31))
    got = rows.where(mark <= share).orderBy(mark, "id").limit(sample).select("v").toPandas()["v"]
    lengths = [len(v) for v in got]
    d = max(set(lengths), key=lengths.count) if lengths else 1
    x = np.array([v for v in got if len(v) == d], float).reshape(-1, d)
    router = fit(x, n, k)
    rows = materialize(route(rows.where(F.size("v") == d), router, 1))
    # chunks of rows and of queries, by the counts of the (few) parts
    sizes = {r.part: r.n for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    # a query's own row may be among those its parts hold
    asked = route(asked.where(F.size("v") == d), router, router.probes, sizes, k + 1)
    asks = {r.part: r.n for r in asked.groupBy("part").agg(F.count("*").alias("n")).collect()}

    def chunks(counts):
        each = F.lit(1)
        for p, c in counts.items():
            if c > CHUNK:
                each = F.when(F.col("part") == p, F.lit(-(-c // CHUNK))).otherwise(each)
        return each

    def deal(df, own, other, mine, theirs):
        df = df.withColumn(mine, F.pmod(F.xxhash64("id"), chunks(own)).cast("int"))
        return df.withColumn(theirs, F.explode(F.sequence(F.lit(0), chunks(other).cast("int") - 1)))

    left = deal(rows, sizes, asks, "rc", "qc")
    right = deal(asked, asks, sizes, "qc", "rc")

    def best(r: pa.Table, q: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not r.num_rows or not q.num_rows:
            return pa.table(empty)
        ids, asks_ = r["id"].to_numpy(), q["id"].to_numpy()
        a, b = matrix(r["v"].combine_chunks()), matrix(q["v"].combine_chunks())
        order = np.argsort(ids, kind="stable")
        ids, a = ids[order], a[order]
        out = []
        for lo in range(0, len(b), 256):
            s = b[lo:lo + 256] @ a.T
            s[asks_[lo:lo + 256, None] == ids[None, :]] = -np.inf
            for i in range(len(s)):
                # a margin, as products of blocks round in other ways than single ones
                least = np.partition(s[i], len(ids) - k)[len(ids) - k] if len(ids) > k else -np.inf
                some = np.flatnonzero((s[i] >= least - 1e-9 * (1 + abs(least))) & (s[i] > -np.inf))
                exact = (a[some] * b[lo + i]).sum(1)
                top = np.lexsort((ids[some], -exact))[:k]
                out.append((np.full(len(top), asks_[lo + i]), ids[some][top], exact[top]))
        cols = [np.concatenate(c) for c in zip(*out)]
        return pa.table(dict(zip(empty, cols)))

    by = ["part", "rc", "qc"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(best, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
