"""Registered queries of the subpackage, each over its whole table, and the SQL they must match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm import (
    decontaminate, divergence, forest, jaccard, languages, lexical, licenses, mixing, pii, quality, quotes, shards, sql, urls)
from airloom.llm.common import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Shares of the tokens that documents of each domain should have.
TARGETS = {"clean": 0.95, "toxic": 0.03, "junk": 0.02}


def op1_soft_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = mixing.mix(docs, mixing.domains_of(_table(spark, sf_dir, "labels")), TARGETS, columns=["doc_id"])
    return mixed.select("doc_id", "tokens", *[F.get("posteriors", F.lit(i)).alias(f"p_{n}") for i, n in enumerate(TARGETS)], "rate")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.summary(decontaminate.find_leaks(docs, _table(spark, sf_dir, "benchmark")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("row", "is_first")


#: Host, path and verdict of each rule.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, spark.createDataFrame(URL_RULES, urls.RULES)).drop("url")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_quality(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "weak", "quality", "keep")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find_private(_table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"]))


def op8_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = shards.slim(_table(spark, sf_dir, "documents"))
    return shards.interleave(slim, 8, tie=("size", "text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return quotes.link_quotes(messages).drop("text")


def op10_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return forest.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op11_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, sf_dir, "documents"))


def op13_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = languages.train(docs.where(F.col("doc_id").isNotNull() & ~languages.is_held_out(F.col("doc_id"))))
    found = languages.predict_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", languages.is_held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_soft_mixture, op2_decontaminate, op3_jaccard_join, op4_url_filter, op5_quality_classifier, op6_license_scan, op7_pii,
        op8_interleaved_shards, op9_quotation_links, op10_prefix_forest, op11_fp_tree_search, op12_source_divergence,
        op13_language_families)}


def oracle_sql() -> dict[str, str]:
    """Trained models (1, 5), corpus-wide disclosure (7), quotation links (9), approximate search (10) and trained languages (13) have none."""
    rules = [(label, key, second, licenses.padded(pattern), priority, sure, i)
             for i, (label, key, second, pattern, priority, sure) in enumerate(licenses.signature_rules())]
    return {
        "op2_decontaminate": sql.leaks(), "op3_jaccard_join": sql.jaccard(), "op4_url_filter": sql.urls(URL_RULES),
        "op6_license_scan": sql.licenses(rules, [(label, licenses.padded(p)) for p, label in licenses.PHRASES.items()]),
        "op8_interleaved_shards": sql.shards(8), "op11_fp_tree_search": sql.ranked_documents(), "op12_source_divergence": sql.divergence(),
    }
