"""One query for each text operator, over its whole table."""

from __future__ import annotations

import functools
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescore.llm.decontamination import find_benchmark, items_digest
from sitescore.llm.exact_dedup import exact_dedup
from sitescore.llm.html_text import extractor
from sitescore.llm.jaccard_join import near_copies
from sitescore.llm.kit import ship, table
from sitescore.llm.language_id import held_out, identify
from sitescore.llm.merkle import document_manifest, fold, proof_digest
from sitescore.llm.mixing import mix_sources
from sitescore.llm.periodic_runs import find_runs, planted
from sitescore.llm.repetition import with_repetition
from sitescore.llm.secret_scan import BASE, LEARNED, find_secrets
from sitescore.llm.substring_dedup import remove_repeats
from sitescore.llm.suffix_dedup import remove_repeated_bytes
from sitescore.llm.warc import archived


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out().alias("held_out"), "__language.lang_pred", "__language.score")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "__leak.n_words",
        "__leak.n_hit",
        F.size("__leak.items").cast("long").alias("n_items"),
        items_digest(F.col("__leak.items")).alias("items_sha256"),
        "__leak.contaminated",
    )


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents")).drop("source")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = archived(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "frame", "offset")


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("__secrets")
    base = F.filter(spans, lambda s: s["kind"] != LEARNED)
    joined = lambda some: F.concat_ws(",", F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", extractor()(F.col("html")).alias("text"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeated_bytes(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = with_repetition(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "__repetition.*")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(held_out(), lower).otherwise(F.col("text"))
    found = document_manifest(table(spark, folder, "documents"), tampered)
    way = (F.col("before"), F.col("after"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof_digest(*way).alias("proof_sha256"), fold(F.col("changed"), *way).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", planted().alias("text"))
    found = find_runs(docs).select("doc_id", "__runs.*")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.*",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (
        op1_language_id,
        op2_substring_dedup,
        op3_warc,
        op4_secret_scan,
        op5_html_extraction,
        op6_suffix_dedup,
        op7_decontamination,
        op8_exact_dedup,
        op9_jaccard_join,
        op10_source_mixing,
        op11_quality_rules,
        op12_merkle_manifest,
        op13_periodic_runs,
    )
}
