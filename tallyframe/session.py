"""Session helpers: where intermediate tables go and how per-key state is joined."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fitted state (levels, group statistics) within both limits may be held on the
# driver and shipped to every executor.  Larger state stays distributed.
SMALL_ROWS = 10_000
SMALL_BYTES = 8_000_000
# A key is hot when it has more than one HOT_KEYS-th of all rows, so there are fewer
# hot keys than this.
HOT_KEYS = 1_000
# Whether a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Copies of a hot key's state rows when these are too many to broadcast.
SALTS = 32

_local_root: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates, as named by the cluster."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    if sc.applicationId not in _local_root:
        _local_root[sc.applicationId] = tempfile.mkdtemp(prefix="tallyframe-")
    return _local_root[sc.applicationId]


def materialize(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back, cutting its lineage.

    The table stays until ``release``, or the end of a ``scratch`` block.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tallyframe-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: int = 0) -> int:
    """Remove the tables that ``materialize`` wrote, but for the first ``keep``; frames
    that still read them become unusable."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    gone = paths[keep:]
    del paths[keep:]
    for p in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(gone)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote; frames that still read them become unusable."""
    for t in tables:
        spark = t.sparkSession
        mine = _written.get(spark.sparkContext.applicationId, [])
        named = {f.rsplit("/", 2)[-2] for f in t.inputFiles()}
        for p in [p for p in mine if p.rsplit("/", 1)[-1] in named]:
            mine.remove(p)
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def lean(spark: SparkSession):
    """Queries run inside the block remove their shuffle files as they end; else these stay
    until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def scratch(spark: SparkSession):
    """Intermediates written inside the block are removed at its end."""
    keep = len(_written.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, keep)


def row_bytes(df: DataFrame) -> Column:
    """About the size of a row: texts by their length, the rest by 8 bytes a value."""
    size = F.lit(16 + 8 * len(df.columns)).cast("long")
    for c, kind in df.dtypes:
        x = F.col(f"`{c}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(x), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(x))), F.lit(0))
    return size


def is_small(df: DataFrame, max_rows: int, max_bytes: int = SMALL_BYTES) -> bool:
    n = df.agg(F.count("*").alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return n.n <= max_rows and (n.b or 0) <= max_bytes


def taken(df: DataFrame, max_rows: int, max_bytes: int = SMALL_BYTES) -> pa.Table | None:
    """df's rows, or None when it is above a limit; found out by one job that
    fetches at most max_rows + 1 rows.  A row above a thousandth of max_bytes, which
    is fetched as NULLs, is taken for too large."""
    size = row_bytes(df)
    cols = [F.when(size <= max_bytes // 1000, F.col(f"`{c}`")).alias(c) for c in df.columns]
    got = df.select(*cols, size.alias("__bytes")).limit(max_rows + 1).toArrow()
    held = got["__bytes"].to_numpy() if got.num_rows else np.zeros(0)
    if got.num_rows > max_rows or held.sum() > max_bytes or (held > max_bytes // 1000).any():
        return None
    return got.drop_columns("__bytes")


class State:
    """Per-key state: a local table when proven small, else a distributed one.

    ``keys`` identify a row.  Computed state too large for the driver is written
    once; a stored table (``stored=True``) is used where it lies.
    """

    def __init__(self, df: DataFrame, keys: list[str], max_rows: int | None = None, stored: bool = False):
        self.keys = keys
        limit = SMALL_ROWS if max_rows is None else max_rows
        kept = df if stored else df.persist()
        try:
            self.local = taken(kept, limit)
            self.small = self.local is not None
            if self.small:
                self.df = df.sparkSession.createDataFrame(self.local, df.schema)
            else:
                self.df = df if stored else materialize(kept)
        finally:
            if not stored:
                kept.unpersist()

    def largest(self, *columns: str) -> float:
        """The largest value of some columns, 0 at least; no job for a local table."""
        if self.small:
            return max([0.0, *(pc.max(self.local[c]).as_py() or 0.0 for c in columns)])
        return self.df.agg(F.max(F.greatest(F.lit(0.0), *[F.col(c).cast("double") for c in columns]))).first()[0] or 0.0

    def attach(self, df: DataFrame, how: str = "left", hot: DataFrame | None = None) -> DataFrame:
        """Join the state onto df by its keys; NULL keys match NULL keys.

        Small state is broadcast.  Otherwise df is cut in two: rows of its own hot
        keys (NULL and keys without state included) meet a broadcast of just these
        keys' state, all others a plain join.  No key of the plain join has more than
        one HOT_KEYS-th of all rows.  ``hot`` gives these keys where they are known.
        """
        keys = self.keys
        cols = [c for c in self.df.columns if c not in keys]
        mine = [f"__k_{k}" for k in keys]
        right = self.df.select(*[F.col(k).alias(m) for k, m in zip(keys, mine)], *cols)

        def joined(left: DataFrame, state: DataFrame, *more: str) -> DataFrame:
            cond = [left[k].eqNullSafe(state[m]) for k, m in zip(keys, mine)]
            cond += [left[c] == state[f"{c}_"] for c in more]
            return left.join(state, cond, how).select(*df.columns, *[state[c] for c in cols])

        if self.small:
            return joined(df, F.broadcast(right))
        hot = hot_keys(df, keys) if hot is None else hot
        if hot is None:
            return joined(df, right)
        marks = hot.select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.lit(True).alias("__hot"))
        cond = [df[k].eqNullSafe(marks[f"__h_{k}"]) for k in keys]
        marked = df.join(F.broadcast(marks), cond, "left")
        busy = marked.where("__hot").select(*df.columns)
        rest = marked.where("__hot IS NULL").select(*df.columns)
        cond = [right[m].eqNullSafe(marks[f"__h_{k}"]) for k, m in zip(keys, mine)]
        theirs = right.join(F.broadcast(marks), cond, "left_semi")
        if is_small(theirs, SMALL_ROWS):
            first = joined(busy, F.broadcast(theirs))
        else:  # keys of a dimension that repeat very often: spread over salted copies
            busy = busy.withColumn("__salt", (F.rand(7) * SALTS).cast("int"))
            copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
            first = joined(busy, theirs.withColumn("__salt_", copies), "__salt")
        return first.unionByName(joined(rest, right))


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys (NULL too) with more than one HOT_KEYS-th of df's rows, as a local table."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n")).persist()
    try:
        total = counts.agg(F.sum("__n")).first()[0] or 0
        # text keys of many KB would make the list large; they stay with the others
        rows = counts.where(F.col("__n") * HOT_KEYS > total).where(row_bytes(counts) < SMALL_BYTES // HOT_KEYS).drop("__n").collect()
    finally:
        counts.unpersist()
    return df.sparkSession.createDataFrame(rows, df.select(*keys).schema) if rows else None


def anti_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of df whose key (NULL counts as a value) is not in ``keys``, which holds each
    key once under the names ``on``.  Hot keys of df are split off as in ``attach``."""
    marked = State(keys.select(*on).withColumn("__seen", F.lit(True)), on, stored=True).attach(df)
    return marked.where(F.col("__seen").isNull()).drop("__seen")
