"""The registered query of each training-data operator, and its oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import centroids, copies, decontaminate, licenses, lines, minhash, packing, quality, resampling, rules, secrets, substrings, tokens
from gridlake.llm.oracles import ORACLES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(shingle=3, numerator=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.length_histogram(tokens.token_counts(table(spark, sf_dir, "documents"), TOKENIZER))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeated(table(spark, sf_dir, "documents"), substrings.Settings(window=50))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, window=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("findings", lambda x: x["kind"].isin(*kinds))
    base = [rule.kind for rule in secrets.BASE]
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(secrets.joined(of(*base)), 256).alias("base_sha256"),
        secrets.joined(F.col("findings")).alias("spans"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "longest_run", F.sha2("text", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.transform("item_ids", lambda x: x.cast("string")), ",")
    return found.select("doc_id", F.size("item_ids").cast("long").alias("n_items"), items.alias("item_ids"), "max_containment", "contaminated")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base_labels = F.transform("base", lambda x: x["label"])
    both = F.concat(base_labels, F.transform("found", lambda x: x["label"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["word"])).alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["word"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        F.col("confidence").alias("score"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"), centroids.Settings(clusters=16, rounds=3))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.exact_copies(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), resampling.Settings(buckets=10_000, percent=25, least_words=20))


QUERIES = (
    op1_minhash,
    op2_token_counts,
    op3_substring_dedup,
    op4_packing,
    op5_secret_scan,
    op6_line_dedup,
    op7_decontamination,
    op8_quality_rules,
    op9_quality_classifier,
    op10_license_scan,
    op11_centroid_clustering,
    op12_exact_dedup,
    op13_importance_resampling,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
