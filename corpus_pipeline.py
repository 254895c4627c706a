"""A training corpus from raw documents: reject, remove repeated lines, near copies and test passages, then pack.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. Stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import decontaminate, lines, minhash, packing, quality
from gridlake.llm.scratch import dropped, settled

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of these documents, doesn't reject."""
    weights = quality.train(quality.training_sample(docs, _table(spark, sf_dir, "labels")))
    return quality.without_rejected(docs, weights)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs, and without the documents that are nothing but such copies."""
    cleaned = lines.without_emptied(lines.remove_repeated_lines(docs))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def single_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more)."""
    return minhash.without_near_duplicates(docs)


def untested_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences, with their ids."""
    return packing.pack(docs, TOKENIZER, window=2048, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_documents),
    ("line_dedup", new_lines),
    ("minhash_near_dedup", single_documents),
    ("decontamination", untested_documents),
    ("packing", packed_sequences),
]
#: SQL can express neither the classifier nor the tokenizer; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written and read again, so a lost executor repeats one stage.

    Tables that a stage no longer needs are removed; those of the last stage are read by the result.
    """
    docs = _table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = settled(partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
