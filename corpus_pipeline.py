"""A corpus cleaned and mixed in five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescore.llm.decontamination import find_benchmark
from sitescore.llm.exact_dedup import drop_copies
from sitescore.llm.jaccard_join import drop_near_copies
from sitescore.llm.kit import kept, ship, table
from sitescore.llm.language_id import UNKNOWN, has_letters, held_out, identify
from sitescore.llm.mixing import mix_sources


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: a null text or one without letters."""
    ship(spark)
    found = identify(docs)
    known = F.col("__language.lang_pred") != UNKNOWN
    if docs.where(~held_out()).where("lang is not null and text is not null").isEmpty():
        # nothing was learned, so no text has a language; only those that cannot have one go
        found = found.withColumn("__letters", has_letters(F.col("text")))
        known = F.col("__letters")
    return found.where(known).drop("__language", "__letters")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, keep the one with the largest id."""
    ship(spark)
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked near copies, keep the document with the smallest id.

    Near copies share four fifths of their five-word shingles; the four words
    and 85 percent of ``op9`` are that query's own contract.
    """
    ship(spark)
    return drop_near_copies(docs, width=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    ship(spark)
    return find_benchmark(docs, table(spark, sf_dir, "benchmark")).where(~F.col("__leak.contaminated")).drop("__leak")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    ship(spark)
    return mix_sources(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixed),
]

#: Hyperdimensional profiles and the seeded order of the mix have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs
