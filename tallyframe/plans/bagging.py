"""Bagged regression trees, grown level by level from grouped sums.

Predictors are cut at quantiles of the training rows, so a row is a few small numbers.
For every level, each task sums bootstrap weights and weighted targets by (tree, node,
predictor, bin); these sums, whose number does not depend on the rows, are all that
reaches the driver, which picks the split with the least squared error.  Bootstrap
weights are Poisson(1) numbers from a hash of the row's keys, so a row needs no place
in any order and reruns agree.

A trained forest is a column expression.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.quantiles import quantiles
from tallyframe.session import materialize

DIGITS = 5                  # hex digits of a weight's draw; six trees share one hash
DRAWS = 16**DIGITS


def poisson_cuts() -> list[int]:
    """A draw below the k-th cut (and no earlier one) weighs k."""
    cuts, upto, k = [], 0.0, 0
    while k < 8:
        upto += math.exp(-1) / math.factorial(k)
        cuts.append(round(DRAWS * upto))
        k += 1
    return cuts


def draws(keys: list[str], trees: int, seed: int) -> Column:
    """One number below DRAWS for each tree, from the keys as text."""
    texts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys]
    blocks = [F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(b)), *texts)) for b in range(-(-trees // 6))]
    return F.array(*[F.conv(F.substring(blocks[t // 6], t % 6 * DIGITS + 1, DIGITS), 16, 10).cast("int") for t in range(trees)])


class Forest:
    """Trees over predictors; node 1 is the root, 2n and 2n + 1 hang below node n."""

    def __init__(self, edges: list[np.ndarray], trees: int, depth: int):
        self.edges, self.depth = edges, depth
        self.axis = np.full((trees, 2 << depth), -1)
        self.bin = np.zeros((trees, 2 << depth), np.int64)
        self.value = np.full((trees, 2 << depth), np.nan)

    def node(self, tree: int, bins: np.ndarray) -> np.ndarray:
        """Where rows of bins end."""
        at = np.ones(len(bins), np.int64)
        for _ in range(self.depth):
            axis = self.axis[tree, at]
            go = np.flatnonzero(axis >= 0)
            if not len(go):
                break
            at[go] = 2 * at[go] + (bins[go, axis[go]] > self.bin[tree, at[go]])
        return at

    def grow(self, sums: list, level: int, least: int) -> bool:
        """Split the nodes of a level by sums (tree, node, axis, bin, n, s)."""
        by: dict[tuple[int, int], list] = {}
        for r in sums:
            by.setdefault((r.tree, r.node), []).append((r.axis, r.bin, r.n, r.s))
        split = False
        for (tree, node), cells in by.items():
            first = [c for c in cells if c[0] == 0]
            n, s = sum(c[2] for c in first), math.fsum(c[3] for c in first)
            if level == 0:
                self.value[tree, node] = s / n
            best = None
            for axis in range(len(self.edges)):
                nl, sl = 0, 0.0
                for _, b, m, t in sorted(c for c in cells if c[0] == axis):
                    nl, sl = nl + m, sl + t
                    if nl < least or n - nl < least:
                        continue
                    gain = sl * sl / nl + (s - sl) * (s - sl) / (n - nl)
                    if best is None or gain > best[0]:
                        best = (gain, axis, b, nl, sl)
            if best is None or best[0] <= s * s / n * (1 + 1e-12):
                continue
            _, self.axis[tree, node], self.bin[tree, node], nl, sl = best
            self.value[tree, 2 * node], self.value[tree, 2 * node + 1] = sl / nl, (s - sl) / (n - nl)
            split = True
        return split

    def prediction(self, xs: list[Column]) -> Column:
        """Mean of the trees' values; NULL when nothing was learned."""
        def node(t: int, n: int) -> dict:
            a = int(self.axis[t, n])
            cut = float(self.edges[a][self.bin[t, n]]) if a >= 0 else None
            value = float(self.value[t, n])
            return {"a": a, "cut": cut, "v": None if math.isnan(value) else value}

        used = [t for t in range(len(self.value)) if not math.isnan(self.value[t, 1])]
        if not used:
            return F.lit(None).cast("double")
        # one literal, folded when the plan is made
        text = json.dumps([[node(t, n) for n in range(1, self.value.shape[1])] for t in used])
        trees = F.from_json(F.lit(text), "array<array<struct<a:int,cut:double,v:double>>>")
        x = F.array(*xs)

        def walk(tree: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                node = F.element_at(tree, at)
                return F.when(node["a"] < 0, at).otherwise(2 * at + (F.get(x, node["a"]) > node["cut"]).cast("int"))
            end = F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(1), step)
            return F.element_at(tree, end)["v"]

        return F.aggregate(F.transform(trees, walk), F.lit(0.0), lambda a, v: a + v) / len(used)


def fit(train: DataFrame, target: str, by: list[str], keys: list[str], medians: dict[str, float | None],
        trees: int = 25, depth: int = 6, bins: int = 32, least: int = 5, seed: int = 7) -> Forest:
    """Trees for ``target`` from ``by``, whose NULLs read as medians; ``keys`` name a row."""
    xs = [f"x{j}" for j in range(len(by))]
    known = train.where(F.col(f"`{target}`").isNotNull()).select(
        F.col(f"`{target}`").cast("double").alias("y"), draws(keys, trees, seed).alias("w"),
        *[F.coalesce(F.col(f"`{b}`").cast("double"), F.lit(medians[b])).alias(x) for b, x in zip(by, xs)])
    cuts = quantiles(known, xs, [i / bins for i in range(1, bins)])
    edges = [np.array(sorted({c for c in cuts[x] if c is not None})) for x in xs]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.array(poisson_cuts())
        for b in batches:
            codes = [pa.array(np.searchsorted(e, b.column(2 + j).to_numpy(zero_copy_only=False), side="left").astype(np.int16))
                     for j, e in enumerate(edges)]
            w = np.searchsorted(steps, b.column(1).flatten().to_numpy(), side="right").astype(np.int8)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * trees), pa.array(w))
            yield pa.RecordBatch.from_arrays([b.column(0), lists, *codes], names=["y", "w", *xs])

    rows = materialize(known.mapInArrow(binned, "y double, w array<byte>, " + ", ".join(f"{x} short" for x in xs)))
    forest = Forest(edges, trees, depth)
    width = max(map(len, edges), default=0) + 1
    for level in range(depth):
        def sums(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            base, nodes, axes = 1 << level, 1 << level, len(xs)
            n, s = np.zeros((trees, nodes * axes * width)), np.zeros((trees, nodes * axes * width))
            for b in batches:
                if not b.num_rows:
                    continue
                y = b.column(0).to_numpy()
                w = b.column(1).flatten().to_numpy().reshape(-1, trees)
                codes = np.stack([b.column(2 + j).to_numpy() for j in range(axes)], 1).astype(np.int64)
                for t in range(trees):
                    at = forest.node(t, codes) - base
                    own = np.flatnonzero((w[:, t] > 0) & (at >= 0))
                    for j in range(axes):
                        cell = (at[own] * axes + j) * width + codes[own, j]
                        n[t] += np.bincount(cell, w[own, t], nodes * axes * width)
                        s[t] += np.bincount(cell, w[own, t] * y[own], nodes * axes * width)
            tree, cell = np.nonzero(n)
            cols = [tree, cell // (axes * width) + base, cell // width % axes, cell % width]
            yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in cols], pa.array(n[tree, cell].astype(np.int64)), pa.array(s[tree, cell])],
                                             names=["tree", "node", "axis", "bin", "n", "s"])

        part = rows.mapInArrow(sums, "tree int, node int, axis int, bin int, n long, s double")
        got = part.groupBy("tree", "node", "axis", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
        if not forest.grow(got, level, least):
            break
    return forest
