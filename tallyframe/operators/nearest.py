"""Exact nearest-neighbour means along several numeric predictors.

The distance is the sum over predictors of |a - b| / range.  Donors are reduced to
distinct points and cut into cells at medians of a bounded sample; each cell's box is
then read off the donors themselves.  A point asked for first meets the donors of the
nearest box, which bounds how far its k-th neighbour can be, and after that only the
cells whose boxes lie within that bound; so results are exact and no pairs of all points
are formed.  Inside a task donors lie in small leaves with boxes, used the same way.

Cells with many points asked for are dealt out in chunks, each with a copy of the cell's
donors.  Only cell boxes (MOST_CELLS at most) pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import materialize

SAMPLE = 20_000
CELL = 50_000
MOST_CELLS = 1024
CHUNK = 20_000
LEAF = 128


def planes(x: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """Nodes (axis, cut, left, right) of a tree with about ``cells`` leaves; children
    below zero are cells -1 - n."""
    nodes: list = []
    made = 0

    def grow(rows: np.ndarray, want: int) -> int:
        nonlocal made
        spans = np.ptp(rows, axis=0) if len(rows) else np.zeros(x.shape[1])
        axis = int(spans.argmax())
        if want < 2 or not spans[axis] > 0:
            made += 1
            return -made
        cut = float(np.median(rows[:, axis]))
        if cut == rows[:, axis].max():  # at least one row goes to the right
            cut = float(rows[rows[:, axis] < cut, axis].max())
        at = len(nodes)
        nodes.append(None)
        left = rows[:, axis] <= cut
        nodes[at] = (axis, cut, grow(rows[left], want // 2), grow(rows[~left], want - want // 2))
        return at

    grow(x, cells)
    return nodes


def placed(nodes: list, x: np.ndarray) -> np.ndarray:
    """The cell of each row."""
    out = np.zeros(len(x), np.int32)
    todo = [(0, np.arange(len(x)))] if nodes else []
    while todo:
        n, rows = todo.pop()
        if n < 0:
            out[rows] = -1 - n
            continue
        axis, cut, left, right = nodes[n]
        low = x[rows, axis] <= cut
        todo += [(left, rows[low]), (right, rows[~low])]
    return out


def distances(x: np.ndarray, y: np.ndarray, ranges: list[float]) -> np.ndarray:
    out = np.zeros((len(x), len(y)))
    for j, r in enumerate(ranges):
        if r > 0:
            out += np.abs(x[:, j, None] - y[None, :, j]) / r
    return out


def box_distances(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, ranges: list[float]) -> np.ndarray:
    """The least distance that a point of a box can have."""
    out = np.zeros((len(x), len(lo)))
    for j, r in enumerate(ranges):
        if r > 0:
            out += np.maximum(np.maximum(lo[None, :, j] - x[:, j, None], x[:, j, None] - hi[None, :, j]), 0.0) / r
    return out


def search(x: np.ndarray, reach: np.ndarray, y: np.ndarray, k: int, ranges: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance): the rows of y within reach[i] of x[i] and no
    farther than the k-th of them."""
    leaf = placed(planes(y, max(len(y) // LEAF, 1)), y)
    order = np.argsort(leaf, kind="stable")
    y = y[order]
    first = np.flatnonzero(np.concatenate([[True], np.diff(leaf[order]) != 0]))
    ends = np.append(first[1:], len(y))
    lo, hi = np.minimum.reduceat(y, first), np.maximum.reduceat(y, first)
    rows, found, far = [], [], []
    step = max(2_000_000 // max(len(first), 1), 1)
    for begin in range(0, len(x), step):
        part, limit = x[begin:begin + step], reach[begin:begin + step].copy()
        bound = box_distances(part, lo, hi, ranges)
        home = bound.argmin(1)
        own: list[tuple] = []
        for pass_ in (0, 1):
            for n in range(len(first)):
                asked = np.flatnonzero((home == n) if not pass_ else (home != n) & (bound[:, n] <= limit))
                for at in range(0, len(asked), 4096):
                    some = asked[at:at + 4096]
                    d = distances(part[some], y[first[n]:ends[n]], ranges)
                    i, j = np.nonzero(d <= limit[some, None])
                    own.append((some[i], first[n] + j, d[i, j]))
                    if not pass_ and d.shape[1] >= k:
                        limit[some] = np.minimum(limit[some], np.partition(d, k - 1, axis=1)[:, k - 1])
        i, j, d = (np.concatenate(c) for c in zip(*own))
        by = np.lexsort((d, i))
        i, j, d = i[by], j[by], d[by]
        start = np.searchsorted(i, np.arange(len(part) + 1))
        kth = np.minimum(start[:-1] + k - 1, np.maximum(start[1:] - 1, 0))
        keep = d <= d[kth][i] if len(d) else np.zeros(0, bool)
        rows.append(begin + i[keep])
        found.append(order[j[keep]])
        far.append(d[keep])
    return tuple(np.concatenate(c) if c else np.zeros(0) for c in (rows, found, far))


def matrix(columns: list) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False) if isinstance(c, pa.Array) else c.to_numpy() for c in columns], 1).astype(float)


class Donors:
    """Distinct points of a training frame with the number and sum of known targets."""

    def __init__(self, train: DataFrame, col: str, by: list[str]):
        self.xs = [f"x{j}" for j in range(len(by))]
        x = [F.col(b).cast("double") for b in by]
        real = [F.when(~F.isnan(c), c) for c in x]
        spread = train.agg(*[(F.max(c) - F.min(c)).alias(n) for c, n in zip(real, self.xs)]).first()
        self.ranges = [float(r or 0) for r in spread]
        known = train.where(F.col(col).isNotNull()).select(*[c.alias(n) for c, n in zip(x, self.xs)], F.col(col).cast("double").alias("s"))
        known = known.where(known_point(self.xs))
        points = known.groupBy(*self.xs).agg(F.count("*").alias("c"), F.sum("s").alias("s"))
        points = materialize(points)
        n = points.count()
        share = F.lit(min(1.0, SAMPLE / max(n, 1)) * 2**31).cast("long")
        some = points.where(F.pmod(F.xxhash64(*self.xs), F.lit(2**31)) <= share).select(*self.xs).limit(2 * SAMPLE).toArrow()
        nodes = planes(matrix([some[c] for c in self.xs]), min(n // CELL + 1, MOST_CELLS)) if some.num_rows else []
        names = [*self.xs, "c", "s"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cell = placed(nodes, matrix(b.columns[:len(names) - 2])) if b.num_rows else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*names, "cell"])

        kinds = ", ".join(f"{c} double" for c in self.xs)
        self.points = materialize(points.select(*names).mapInArrow(run, f"{kinds}, c long, s double, cell int"))
        boxes = self.points.groupBy("cell").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in self.xs]).collect()
        self.cells = np.array([r.cell for r in boxes], np.int32)
        self.lo = np.array([[r[f"min_{c}"] for c in self.xs] for r in boxes], float).reshape(-1, len(by))
        self.hi = np.array([[r[f"max_{c}"] for c in self.xs] for r in boxes], float).reshape(-1, len(by))

    def route(self, asked: DataFrame, home: bool) -> DataFrame:
        """asked (xs, reach) with the nearest cell, or with each other cell within reach."""
        cells, lo, hi, ranges, d = self.cells, self.lo, self.hi, self.ranges, len(self.xs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    b = batch.slice(at, 4096)
                    bound = box_distances(matrix(b.columns[:d]), lo, hi, ranges)
                    near = bound.argmin(1)
                    if home:
                        rows, to = np.arange(len(near)), near
                    else:
                        hit = bound <= b.column(d).to_numpy()[:, None]
                        hit[np.arange(len(near)), near] = False
                        rows, to = np.nonzero(hit)
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([*[c.take(take) for c in b.columns], pa.array(cells[to])], names=[*b.schema.names, "cell"])

        kinds = ", ".join(f"{c} double" for c in self.xs)
        return asked.select(*self.xs, "reach").mapInArrow(run, f"{kinds}, reach double, cell int")

    def meet(self, routed: DataFrame, k: int) -> DataFrame:
        """(xs, far, c, s): donors of the routed cells near each point."""
        spark, d, ranges = routed.sparkSession, len(self.xs), self.ranges
        sizes = [(r.cell, -(-r.n // CHUNK)) for r in routed.groupBy("cell").agg(F.count("*").alias("n")).collect()]
        chunks = F.broadcast(spark.createDataFrame(sizes, "cell int, chunks int"))
        left = self.points.join(chunks, "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
        right = routed.join(chunks, "cell").withColumn("chunk", F.pmod(F.xxhash64(*self.xs), F.col("chunks")).cast("int")).drop("chunks")
        names = [*self.xs, "far", "c", "s"]

        def best(donors: pa.Table, asked: pa.Table) -> pa.Table:
            if not donors.num_rows or not asked.num_rows:
                return pa.table({n: pa.array([], pa.int64() if n == "c" else pa.float64()) for n in names})
            x, y = (matrix([t[f"x{j}"] for j in range(d)]) for t in (asked, donors))
            i, j, far = search(x, asked["reach"].to_numpy(), y, k, ranges)
            i, j = i.astype(np.int64), j.astype(np.int64)
            cols = [*[x[i, n] for n in range(d)], far, donors["c"].to_numpy()[j], donors["s"].to_numpy()[j]]
            return pa.table(dict(zip(names, map(pa.array, cols))))

        schema = ", ".join(f"{n} {'long' if n == 'c' else 'double'}" for n in names)
        by = ["cell", "chunk"]
        got = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(best, schema)
        return got.groupBy(*self.xs, "far").agg(F.sum("c").alias("c"), F.sum("s").alias("s"))


def known_point(xs: list[str]):
    """No coordinate is NULL or NaN."""
    out = F.lit(True)
    for x in xs:
        out = out & F.col(x).isNotNull() & ~F.isnan(x)
    return out


def ranked(near: DataFrame, xs: list[str]) -> DataFrame:
    """Per point its donors by distance, nearest first; k and ties of each cell at most."""
    return near.groupBy(*xs).agg(F.array_sort(F.collect_list(F.struct("far", "c", "s"))).alias("near"))


def reach(near: str, k: int):
    """How far the k-th donor is; beyond any number when there are fewer."""
    return F.aggregate(
        near, F.struct(F.lit(0).cast("long").alias("seen"), F.lit(float("inf")).alias("far")),
        lambda a, d: F.struct((a["seen"] + d["c"]).alias("seen"),
                              F.when((a["seen"] < k) & (a["seen"] + d["c"] >= k), d["far"]).otherwise(a["far"]).alias("far")),
        lambda a: a["far"])


def neighbor_means(donors: Donors, asked: DataFrame, k: int) -> DataFrame:
    """(x0, x1, …, value): mean target of the k donors nearest to each asked point.

    ``asked`` holds distinct known points.  Donors as far as the k-th nearest all take
    part, so ties need no rule.  With no donor at all there are no rows.
    """
    xs = donors.xs
    if not len(donors.cells):
        return asked.select(*xs, F.lit(None).cast("double").alias("value")).limit(0)
    asked = materialize(asked.select(*xs, F.lit(float("inf")).alias("reach")))
    first = materialize(donors.meet(donors.route(asked, True), k))
    limit = ranked(first, xs).select(*xs, reach("near", k).alias("reach"))
    more = donors.meet(donors.route(limit, False), k) if len(donors.cells) > 1 else first.limit(0)
    near = ranked(first.unionByName(more).groupBy(*xs, "far").agg(F.sum("c").alias("c"), F.sum("s").alias("s")), xs)
    near = near.withColumn("reach", reach("near", k)).withColumn("used", F.filter("near", lambda d: d["far"] <= F.col("reach")))
    add = lambda part, zero: F.aggregate("used", zero, lambda a, d: a + d[part])
    return near.select(*xs, F.try_divide(add("s", F.lit(0.0)), add("c", F.lit(0).cast("long"))).alias("value"))
