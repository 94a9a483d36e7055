"""A training corpus from raw documents: the stages in their order.

Every stage takes the whole output of the one before it and, but for the last, returns
the columns of the documents. Rows that tie or repeat are treated as each operator
says; an empty table stays empty through all stages; NULL texts fail the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytide.llm import mixing, nbest, quality, simhash, suffix
from keytide.llm.text import cut, documents, few_rows, ship

ORACLE_SQL = None  # fingerprints, suffix orders and lattices are not for SQL; tests hold the stages against brute force


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go; documents that lose too much with them go whole."""
    return quality.clean(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    ship(spark)
    few_rows(spark)
    return simhash.deduplicated(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in several places go."""
    ship(spark)
    few_rows(spark)
    return suffix.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the best segmentation; ``round_trip`` says that decoding gives the text."""
    ship(spark)
    few_rows(spark)
    return nbest.encode(docs).select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_pieces"), "ids",
        F.col("scores")[0].alias("score"), F.col("back").alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", simhash_stage),
    ("suffix-array dedup", suffix_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
