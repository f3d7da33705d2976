"""The registered queries of the subpackage: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from odsflow.llm import (
    brown, classifier, contamination, importance, merkle, mixing, packed, quality, repeats, simhash, substrings, tokens, urls,
)
from odsflow.llm.common import for_workers, small_table, written
from odsflow.session import scratch_path
from odsflow.sources.tables import read_table


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"), shingle=3, radius=3)
    return found.select("doc_id", simhash.hex_print(F.col("print")).alias("fingerprint"), "component_id")


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokens.with_token_counts(read_table(spark, folder, "documents"), "byte_bpe_50k.json", limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


WEIGHTS, MIXED, MOST = (5, 2, 1), 1.5, 2


def source_targets(sized: DataFrame) -> tuple[dict, DataFrame]:
    """Target words of each source, for the flow and as a table (source, source_size, target)."""
    listed = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(mixing.MAX_PATTERNS + 1).collect()
    if len(listed) > mixing.MAX_PATTERNS:
        raise ValueError(f"more than {mixing.MAX_PATTERNS} sources")
    listed.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in listed]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(listed))]
    targets = mixing.share_targets(sizes, weights, MIXED * sum(sizes), MOST)
    table = [(r["source"], r["size"], t) for r, t in zip(listed, targets)]
    frame = small_table(sized.sparkSession, table, source=pa.string(), source_size=pa.int64(), target=pa.float64())
    return {name: target for name, _, target in table}, frame


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    sized = written(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sized")
    quotas, targets = source_targets(sized)
    mixed = mixing.mix(sized.withColumn("members", F.array("source")), quotas, copies=MOST)
    named = targets.withColumnRenamed("source", "name")  # at most MAX_PATTERNS rows
    return mixed.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies_taken")).alias("taken")
    )


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(read_table(spark, folder, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality_rules(read_table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "perplexity", F.exp("lower").alias("lowest"), F.exp("upper").alias("highest"),
    )


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeats.remove_repeats(read_table(spark, folder, "documents"), window=200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op7_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_path(spark, 'token-ids')}/ids"
    packed.write_ids(read_table(spark, folder, "documents"), path, "word_bpe_49k.json", end_id=2)
    return packed.read_digests(spark, path)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    found = contamination.contamination(docs, items, window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    model = classifier.train(docs, read_table(spark, folder, "labels"))
    scored = classifier.with_quality(docs, model, threshold=0.3)
    return scored.select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages", ["page_id", "url"])
    judged = urls.judge_urls(pages, URL_RULES, urls.train(urls.labelled_table(spark)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "wanted")


def remainder(doc_id: Column, divisor: int) -> Column:
    """The unsigned crc32 of the decimal id modulo `divisor`; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def op11_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    held_out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    scored = brown.score_texts(docs, ~held_out)
    return scored.select(
        "doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = read_table(spark, folder, "documents", ["doc_id", "text"]), read_table(spark, folder, "benchmark")
    drawn = importance.resample(docs, target, longest=1, buckets=10_000, least_words=20, percent=10, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.when(remainder(F.col("doc_id"), 3) == 0, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    return merkle.manifest(
        read_table(spark, folder, "documents"), ("doc_id", "source", "lang", "n_chars", "text"), "lang", claimed={"text": tampered}
    )


QUERIES = {
    query.__name__: for_workers(query)
    for query in (
        op1_simhash, op2_token_counts, op3_mixing, op4_substring_dedup, op5_quality_rules, op6_suffix_dedup, op7_token_ids,
        op8_decontamination, op9_quality_classifier, op10_url_filter, op11_lm_scoring,
        op12_importance_resampling, op13_merkle_manifest,
    )
}
