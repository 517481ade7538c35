"""Cleaning pipeline over ``documents``: rules, quality, near copies, repeated passages, packing.

Each stage takes (spark, docs, folder) and all that its predecessor kept; all but the
last return the columns of documents.  ``run`` writes each stage's result to the shared
folder and reads it back, so a lost executor repeats one stage's work only.

Edge cases follow the operators: NULL texts count as empty and go at the rules; rows
that repeat an id stay once after near-dedup; an empty table yields no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import dartminhash, packing, rules, sitequality, suffix
from tallyframe.llm.queries import tokenizer
from tallyframe.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SITE = ["source", "lang"]
# Fifty words of running text in bytes, short ones included (the tables' words take about
# six and a half with their blank).
PASSAGE = 270


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass policy v1 of the rule ledger."""
    return rules.apply_policy(rules.ledger(docs.select(*COLUMNS)), rules.V1).where("kept").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier keeps.  It is fitted on labelled rows of
    the whole table, as the rules have removed most bad examples here."""
    every = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = sitequality.fit(sitequality.features(every), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = sitequality.classify(docs.withColumn("__text", F.col("text")), model, SITE).where("kept")
    return scored.withColumn("text", F.col("__text")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return dartminhash.keep_one(docs).select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of passages of about fifty words; n_chars follows the text.
    Documents of which nothing is left go."""
    out = suffix.remove(docs, PASSAGE, keep="first")
    out = out.where((F.length("text") > 0) | (F.col("n_removed") == 0))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", pack),
]

# Token ids of a BPE vocabulary cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
