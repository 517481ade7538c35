"""Records of CSV files whose texts hold line breaks, read split by split."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'


def records(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """(record) for each record of the files under path, as text without its line end."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    # one row a split; a file's splits are few beside its lines
    splits = lines.groupBy("file", "at").agg(F.sum(quotes).alias("quotes"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("at")) - F.col("quotes")
    # 17 bytes for each split that begins inside a text: a few MB for the largest tables
    splits = splits.withColumn("odd", before % 2 == 1).where("odd").select(F.xxhash64("file").alias("f"), F.col("at").alias("a"), F.lit(True).alias("odd"))
    met = (F.xxhash64("file") == F.col("f")) & (F.col("at") == F.col("a"))
    marked = lines.join(F.broadcast(splits), met, "left").select("value", "file", "at", F.coalesce("odd", F.lit(False)).alias("inside"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole records (kind 0), and of a split the lines before its first border (1) and
        those after its last one (2)."""
        now, held, first, inside, head = None, [], False, False, False

        def ended() -> list[tuple]:
            """What is held when its split ends: it may go on in the next one."""
            if now is None or not held:
                return []
            return [("\n".join(held), now[0], now[1], 1 if first else 2, not inside)]

        for batch in batches:
            out = []
            for value, file, at, starts in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (file, at):
                    out += ended()
                    now, held, first, inside = (file, at), [], starts, starts
                    head = header and at == 0
                held.append(value)
                inside ^= value.count(QUOTE) % 2 == 1
                if not inside and head:  # a file's first record names the columns
                    held, head = [], False
                elif not inside:
                    out.append(("\n".join(held), file, at, 1 if first else 0, True))
                    held, first = [], False
            yield rows(out)
        yield rows(ended())

    def rows(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["record", "file", "at", "kind", "done"])

    got = marked.mapInArrow(cut, "record string, file string, at long, kind int, done boolean")
    # a record across splits starts with a piece of kind 2 and goes on to the first one that is done
    pieces = got.where("kind > 0")
    order = Window.partitionBy("file").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("n", F.sum(F.when(F.col("kind") == 2, 1).otherwise(0)).over(order))
    across = pieces.groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("at", "kind", "record"))).alias("p"))
    across = across.select(F.array_join(F.col("p.record"), "\n").alias("record"))
    every = got.where("kind = 0").select("record").unionByName(across)
    return every.select(F.regexp_replace("record", "\r$", "").alias("record")).where(F.col("record") != "")
