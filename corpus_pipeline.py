"""Corpus pipeline: toxic documents go, one document of each similar group stays, repeated passages
and personal data are cut, and what is left is packed into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes each stage's result to the shared checkpoint folder as Parquet and
reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import packing, personal, similarity, substrings, toxicity
from visitlens.llm.common import Shelf, read


def measured(docs: DataFrame, before: DataFrame) -> DataFrame:
    """``n_chars`` of changed texts, with the type it had; other columns as they are."""
    if "n_chars" not in before.columns:
        return docs
    size = F.char_length("text").cast(before.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.Model.learn(docs, read(spark, sf_dir, "labels")).clean(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similarity.one_of_each(spark, docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured(substrings.without_repeats(spark, docs), docs)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured(personal.redacted(docs, personal.learn(docs)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_similar),
    ("suffix_dedup", cut_repeats),
    ("pii", redact_personal),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shelf = Shelf(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shelf.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
