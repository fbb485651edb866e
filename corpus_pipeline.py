"""A training-data pipeline over ``documents``: toxic and poor documents go,
duplicate lines go, one of each group of near copies stays, the rest is packed.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns the next stage's documents, the last one what is packed.  Between two
stages the documents are written as Parquet below the shared checkpoint folder
and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard_join, line_dedup, packing, quality_rules, toxicity
from strata.llm.store import discard, stored
from strata.llm.workers import importable, small_batches
from strata.session import checkpoint_dir
from strata.sources.tables import read_table


def _workers_ready(spark: SparkSession) -> None:
    """Python workers find the package and get batches of bounded size."""
    importable(spark)
    small_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores below 0.5."""
    _workers_ready(spark)
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    _workers_ready(spark)
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat another one; n_chars is
    that of the text that stays."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard >= 0.8."""
    _workers_ready(spark)
    return jaccard_join.keep_first(docs, words=5, share=(80, 100))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins of all documents' pieces."""
    _workers_ready(spark)
    checkpoint_dir(spark)
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_poor), ("line_dedup", drop_lines),
          ("jaccard_join", drop_near_copies), ("best_fit_packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.  A stage's table goes when
    the next one is written; the last one, which the result reads, stays.

    Defined cases: those of the operators, stage by stage; an empty table gives
    no row, rows with a null or shared id pass each stage as its operator says."""
    docs, former = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if former is not None:
            discard(former)
        former = docs
    return STAGES[-1][1](spark, docs, sf_dir)


# Fitted classifiers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
