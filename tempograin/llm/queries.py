"""The queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, divergence, lines, lm, mixing, neardup, paragraphs, pii, quality, simhash, toxicity, urls
from .common import mod_of_id, table
from .sql import SQL

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Hosts that a public block list could name; the list has those with many thin pages too. A rule goes before them.
BLOCKED_HOSTS = ["ads-track.example.com", "adult-x.example.com", "casino-win.example.net", "cheap-pills.example.net", "free-bets.example.net", "spam-farm.example.org"]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    n = [count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *n, F.sha2(pii.span_text("base").cast("binary"), 256).alias("base_sha256"), pii.span_text("spans").alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4).select("doc_id", "n_shingles", "component_id", "kept")


def op4_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeats(table(spark, sf_dir, "documents")).drop("__row")


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, sf_dir, "documents")).drop("__row")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(*r, 1) for r in RULES] + [(h, "/", "block", 0) for h in BLOCKED_HOSTS], "host string, path string, verdict string, level int")
    pages = table(spark, sf_dir, "pages")
    judged = urls.judge_urls(pages, listed.union(urls.thin_hosts(pages)))
    return judged.select("page_id", "host", "path", F.when(F.col("level") == 1, F.col("rule")).alias("rule"), "verdict")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    n = F.size("hit_words").cast("long")
    return found.select("doc_id", "n_words", n.alias("n_hit"), F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (n > 0).alias("contaminated"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(toxicity.training_rows(docs, table(spark, sf_dir, "labels"), "quality", F.lit(True), quality.TRAIN_ROWS))
    return quality.judged(docs.select("doc_id", "text"), model).drop("text", "quality_score")


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), mod_of_id(F.col("doc_id"), 7) != 2)
    return scores.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.training_rows(docs, table(spark, sf_dir, "labels"), "toxic", mod_of_id(F.col("doc_id"), 3) != 1))
    scores = toxicity.scored(docs.select("doc_id", "text"), model)
    return scores.select("doc_id", (mod_of_id(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_line_dedup, op3_near_duplicates, op4_paragraphs, op4_passages, op5_url_filter, op6_decontaminate, op7_mix, op8_quality, op9_language_model, op10_toxicity, op11_source_divergence, op12_simhash, op13_alignment)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in queries()}

