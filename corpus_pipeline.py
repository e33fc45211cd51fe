"""Corpus pipeline: toxic documents go, bad documents go, one of each near-duplicate
group stays, and what is left is packed into training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the docs of the next stage. All stages but the last
return the columns of their input, whatever their names. Models are learned from
``labels`` and the documents the stage is given.

Defined cases: a null or empty text is neither toxic nor bad for what it says: the
toxicity stage scores it like a text without toxic windows, the quality stage like one
without words (it goes), and it is near-duplicate of nothing. Rows that repeat id and
text are one document to the near-duplicate stage, which keeps one of them; the other
stages treat every row alike. A null id is an id of its own. Without labels no
document is toxic and texts with words are judged by their sites alone. Empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import minhash, packing, quality_classifier, toxicity
from ledgerlens.llm.common import read_table, temporary_tables, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier keeps; the source stands for the host, the language for the path."""
    return quality_classifier.keep_good(docs, read_table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8): its smallest id."""
    return minhash.keep_representatives(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents packed into sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality_classifier", keep_good),
          ("near_dedup", drop_near_duplicates), ("packing", pack)]

#: SQL has no counterpart of the trained models and the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; only the last one's table is left behind."""
    docs = read_table(spark, sf_dir, "documents")
    with temporary_tables(spark) as tables:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        tables.keep(docs)
    return docs
