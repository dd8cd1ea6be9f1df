"""One query per operator over the whole tables, with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasklens.llm import oracles
from tasklens.llm.chunk_recipes import exact_duplicates
from tasklens.llm.fm_index import find_contamination
from tasklens.llm.language import identify_languages
from tasklens.llm.lm_score import cross_entropy_difference
from tasklens.llm.merkle import fingerprints
from tasklens.llm.near_dedup import near_duplicates
from tasklens.llm.packing import pack
from tasklens.llm.phrase_trie import collocations
from tasklens.llm.rules import quality_scores
from tasklens.llm.secret_scan import KINDS, scan_secrets
from tasklens.llm.secret_scan import written as spans_as_text
from tasklens.llm.sharded_kmeans import cluster
from tasklens.llm.staging import table
from tasklens.llm.string_kernel import toxicity_scores
from tasklens.llm.substring_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op8_benchmark_decontamination", oracles.CONTAMINATION)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                               table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query("op9_substring_dedup", oracles.SUBSTRINGS)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), digest=True)
    return cut.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


@query("op3_near_dedup", oracles.NEAR_DEDUP)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def bucket_of(doc_id: str, buckets: int):
    """crc32 of the id as text, modulo the number of buckets: the stated folds."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % buckets


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(bucket_of("doc_id", 5) != 0)
    scored = quality_scores(table(spark, sf_dir, "documents", "doc_id", "text"), labels)
    return scored.select(
        "doc_id", F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").filter(bucket_of("doc_id", 5) != 0)
    scored = toxicity_scores(table(spark, sf_dir, "documents", "doc_id", "text"), labels)
    return scored.select(
        "doc_id", F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op5_merkle_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    count = [(F.size("base") - F.size(F.array_remove(kinds, F.lit(k)))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *count, F.sha2(spans_as_text(F.col("base")), 256).alias("base_sha256"),
                        spans_as_text(F.col("spans")).alias("spans"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = identify_languages(docs, docs.filter(bucket_of("doc_id", 4) != 2))
    return found.select("doc_id", F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op1_lm_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the target. Up to two million labelled ids go to the texts, so texts needn't move."""
    good = table(spark, sf_dir, "labels", "doc_id", "quality").filter("quality = 1").select("doc_id").distinct()
    marks = good.withColumn("target", F.lit(True))
    if good.count() <= 2_000_000:
        marks = F.broadcast(marks)
    docs = table(spark, sf_dir, "documents", "doc_id", "text").join(marks, "doc_id", "left")
    return cross_entropy_difference(docs, "target")


@query("op11_exact_dedup", oracles.EXACT_DUPLICATES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op12_collocations", oracles.COLLOCATIONS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


@query("op13_centroid_clusters", oracles.CLUSTERS)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
