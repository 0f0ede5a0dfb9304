"""The corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontam, linededup, quality, sentencepiece, simhash
from tidewell.llm.common import pinned, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the compression classifier does not reject."""
    scored = quality.classify_quality(docs, table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without later repeated runs of lines; ``n_chars`` follows the text."""
    cut = linededup.drop_repeated_lines(docs)
    return cut.withColumn("n_chars", F.when(F.col("removed_units") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.drop_near_duplicates(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    return sentencepiece.encode_checked(docs).select("doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids",
                                                     "round_trip")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", tokenize),
]

#: SQL expresses neither trained compression nor fingerprint components; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
