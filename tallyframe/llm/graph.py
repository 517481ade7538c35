"""Connected components of a distributed edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import materialize

# Edges (both directions) that one task may hold; more are worked on by rounds of joins.
SMALL_EDGES = 400_000


def _in_one_task(both: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def top(x):
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = top(a), top(b)
                up[max(a, b)] = min(a, b)
        kind = both_type
        yield pa.RecordBatch.from_arrays([pa.array(list(up), kind), pa.array([top(x) for x in up], kind)], names=["node", "label"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind, both_type = dict(both.dtypes)["a"], to_arrow_type(both.schema["a"].dataType)
    return both.coalesce(1).mapInArrow(run, f"node {kind}, label {kind}")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node of its component.

    Every round takes the smallest label among neighbours, with partial minima before
    the shuffle, and then the label of the label, so that long chains halve.  Rounds end
    when no label changes.  Both tables are written once a round and never collected.
    A counted and bounded number of edges goes through one task instead.
    """
    pairs = edges.select("a", "b").where("a <> b")
    both = materialize(pairs.union(pairs.select("b", "a")).distinct())
    if both.count() <= SMALL_EDGES:
        return materialize(_in_one_task(both))
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")))
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("at")).agg(F.min("label").alias("near"))
        low = labels.join(seen, labels["node"] == seen["at"], "left").select(
            "node", F.least("label", "near").alias("low"), F.col("label").alias("old"))
        low = materialize(low)
        top = low.select(F.col("node").alias("up"), F.col("low").alias("top"))
        new = materialize(low.join(top, low["low"] == top["up"], "left").select(
            "node", F.least("low", "top").alias("label"), "old"))
        labels = new.select("node", "label")
        if not new.where("label <> old").limit(1).count():
            return labels
