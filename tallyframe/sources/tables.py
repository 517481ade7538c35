"""Reading named tables and writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources.records import records

# Every text comes back as it was: quotes doubled, blanks kept, "" apart from NULL.  NULL
# is written as nothing at all; the reader's mark for that must not be "" itself.
CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


class Tables:
    """Named parquet tables of one folder, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, df)
        return df


def literal_frame(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A small table from column vectors."""
    return spark.createDataFrame(list(zip(*columns.values())), schema)


def grid_frame(spark: SparkSession, name: str, start: float, stop: float, step: float) -> DataFrame:
    """Evenly spaced values start, start+step, … not beyond stop."""
    n = int((stop - start) / step + 1e-9) + 1
    return spark.range(n).selectExpr(f"{start}D + id * {step}D AS {name}")


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True) -> DataFrame:
    """CSV with a declared schema (no inference pass over the data).  Texts may hold line
    breaks, and files are still read in splits; a row that does not fit the schema is an
    error.

    A line break parts two records where an even number of quotes stands before it in the
    file (quotes inside texts are doubled).  A first job counts the quotes of each split,
    which says for every split whether it begins inside a text.  The tasks then cut their
    splits into records; the pieces of a record that lies across splits, two a split at
    most, are put together by a shuffle of their own.
    """
    kind = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV.items()}
    parsed = F.from_csv(F.col("record"), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind),
                        {**options, "mode": "FAILFAST", "nullValue": "\0", "multiLine": "true"})
    return records(spark, path, header).select(parsed.alias("r")).select("r.*")


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower, upper, parts: int,
              **options) -> DataFrame:
    """Database table read in ``parts`` ranges of ``column``."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper,
        numPartitions=parts, **options,
    ).load()


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines, as saved from an API, with a declared schema."""
    return spark.read.json(path, schema=schema)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "error") -> None:
    df.write.mode(mode).csv(path, header=header, **CSV)


def write_parquet(df: DataFrame, path: str, mode: str = "error", partition_by=()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
