"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame.

Each applies one operator, with its production parameters, to the whole of its table and derives
the digest columns of the result from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import oracle
from newsloom.llm.common import ROW, read_table, stable, with_row_id
from newsloom.llm.decontaminate import contamination
from newsloom.llm.exact_dedup import exact_groups, text_digest
from newsloom.llm.html_crf import extract_main_text
from newsloom.llm.langid import identify
from newsloom.llm.mixing import mix_sources
from newsloom.llm.quality import score_quality
from newsloom.llm.resample import resample
from newsloom.llm.secret_scan import scan_secrets
from newsloom.llm.simhash import simhash_classes
from newsloom.llm.spelling import variant_groups
from newsloom.llm.suffix_array import remove_strings
from newsloom.llm.suffix_tree import remove_passages
from newsloom.llm.warc import round_trip


def sha256(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    def page(c: str) -> Column:
        return F.regexp_extract(c, r"^<urn:page:(-?\d+):", 1).try_cast("long")

    records = round_trip(read_table(spark, sf_dir, "pages"))
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page("refers_to").alias("refers_to"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stable(read_table(spark, sf_dir, "documents"))
    digests = with_row_id(docs, text_digest(F.col("text")).alias("text_sha256"))
    return exact_groups(docs).join(digests, ROW).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", sha256(F.col("kept")).alias("kept_sha256"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        sha256(F.concat_ws(",", "items")).alias("items_sha256"), "contaminated")


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_strings(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        sha256(F.col("kept")).alias("kept_sha256"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    return found.select(
        F.col("id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), sha256(joined(F.filter("found", lambda s: s["kind"] != "guess"))).alias("base_sha256"),
        joined(F.col("found")).alias("spans"))


def importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).select(
        F.col("id").alias("doc_id"), "held_out", "score", "predicted")


def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": simhash,
    "op2_warc": warc,
    "op3_exact_dedup": exact_dedup,
    "op4_language_id": language_id,
    "op5_substring_dedup": substring_dedup,
    "op6_decontamination": decontamination,
    "op7_html_extraction": html_extraction,
    "op8_mix_sources": mix,
    "op9_suffix_array": suffix_array,
    "op10_secret_scan": secrets,
    "op11_importance_resample": importance_resample,
    "op12_quality_classifier": quality,
    "op13_spelling_variants": spelling,
}

ORACLE: dict[str, str] = {
    "op2_warc": oracle.WARC,
    "op3_exact_dedup": oracle.EXACT_DEDUP,
    "op5_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op6_decontamination": oracle.DECONTAMINATION,
    "op8_mix_sources": oracle.MIXING,
    "op11_importance_resample": oracle.RESAMPLE,
    "op13_spelling_variants": oracle.SPELLING,
}
