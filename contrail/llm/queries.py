"""The operators over the test tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import embedding_dedup, html_text, mixing, packing, pii, quality_classifier, toxicity
from contrail.llm.common import held_out, table
from contrail.llm.filter_audit import filter_audit
from contrail.llm.license_scan import license_scan
from contrail.llm.lm_scoring import lm_score
from contrail.llm.near_dedup import near_duplicates
from contrail.llm.oracles import FILTER_AUDIT, LENGTH_BUCKETS, PREFIX_TRIE, RAKING
from contrail.llm.prefix_trie import prefix_trie
from contrail.llm.quality_rules import quality_rules

Query = Callable[[SparkSession, str], DataFrame]


def op1_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score(docs, held_out(F.col("doc_id"), 7, 2))


def op2_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    mixed = mixing.mix(docs).select("doc_id", "mixing.*")
    # The order in which a cluster adds doubles changes the last digits.
    return mixed.withColumns({c: F.round(c, 9) for c in ("weight", "probability")})


def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "quality.*")


def op5_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "visible")


def op6_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.detect(docs, pii.train(docs)).select("doc_id", "pii.*")


def op7_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 5, 0))
    model = toxicity.train(docs, labels.select("doc_id", F.col("toxic").alias("grade")))
    scored = toxicity.classify(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "toxicity.*")


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_graded_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grade 0: poor; 1: good text of toxic content; 2: good. Kept from grade 1 on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 5, 0))
    grade = F.col("quality") * (2 - F.col("toxic"))
    model = quality_classifier.train(docs, labels.select("doc_id", grade.alias("grade")))
    graded = quality_classifier.classify(docs, model)
    return graded.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "graded.*",
        (F.col("graded.tail_prob") >= 0.5).alias("kept"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "licenses.*")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit(docs, table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_recurrent_lm": op1_recurrent_lm,
    "op2_raking": op2_raking,
    "op3_lsh_forest": op3_lsh_forest,
    "op4_repetition": op4_repetition,
    "op5_visible_text": op5_visible_text,
    "op6_weak_pii": op6_weak_pii,
    "op7_length_buckets": op7_length_buckets,
    "op8_toxicity": op8_toxicity,
    "op9_lattice": op9_lattice,
    "op10_graded_quality": op10_graded_quality,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_license_rules": op12_license_rules,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {
    "op2_raking": RAKING,
    "op7_length_buckets": LENGTH_BUCKETS,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_filter_audit": FILTER_AUDIT,
}
