"""Corpus cleaning pipeline: filter, deduplicate and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
each stage's rows as Parquet below the shared checkpoint folder and reads them
back as the next one's documents; what a finished stage had written besides is
removed. All but the last return the columns of
documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dailybars.llm import exact_dedup, langid, near_dup, packing, toxicity
from dailybars.llm.common import materialise, ship_package, table
from dailybars.session import clean_scratch, scratch_count


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier marks go."""
    ship_package(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    ship_package(spark)
    return langid.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space one stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by shingle similarity one stays."""
    ship_package(spark)
    return near_dup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents encoded and packed into sequences."""
    ship_package(spark)
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unidentified),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("best_fit_packing", pack),
]

# The learned filters and the encoder have no SQL form; the tests hold the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), scratch_count(spark)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        # Only the stage's rows are read again, not what it was made from.
        clean_scratch(spark, since=before, keep=1)
    return docs
