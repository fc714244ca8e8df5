"""Corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, encoding.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; all but the last return the columns of
``documents``. NULL and empty texts pass the filters, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.llm import decontaminate, line_dedup, sentencepiece_dropout, simhash, toxicity
from supplyloom.llm.common import staged, table
from supplyloom.session import apply_defaults

ORACLE_SQL = None  # learned scores, similarity joins and a piece vocabulary are beyond SQL


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity is below the threshold."""
    grammar = toxicity.train(docs, table(spark, folder, "labels"))
    score = toxicity.scores(grammar, F.col("text"), spark)
    return docs.withColumn("__toxicity", score).filter(F.col("__toxicity") < toxicity.TOXIC_FROM).drop("__toxicity")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the lines that match an earlier line; a document that loses all its lines has an empty text."""
    return line_dedup.drop_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (three-word shingles) are chained by two or fewer differing bits."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, folder, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    coded = docs.select("doc_id", "lang", "source", sentencepiece_dropout.encode_checked(F.col("text"), F.col("doc_id")).alias("coded"))
    pieces = F.col("coded.pieces")
    return coded.select(
        "doc_id", "lang", "source", F.size(pieces).cast("long").alias("n_pieces"), F.col("coded.lossless").alias("lossless"), pieces.alias("pieces")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next one."""
    apply_defaults(spark)
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, folder))
    return docs
