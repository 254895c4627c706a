"""Quality rules (operator 8) with risk-controlled cutoffs.

Each rule compares one signal of a document with a cutoff of its stratum (the language). Cutoffs are chosen with labelled
documents, which serve as the holdout: nothing else is fitted to them.

1. Path. The rules' candidate cutoffs, from lax to strict and rule after rule, are the steps of one path. Steps that
   remove too few further documents labelled bad (``gain``) are left out. Only the bad labels decide this, so the good
   ones stay untouched for the tests.
2. Tests. Going along the path, a step is taken while an exact binomial test rejects "the rules taken so far remove more
   than ``risk`` of the stratum's good documents"; the first failure ends the walk. All rules of a stratum are tested
   together, so ``risk`` bounds a stratum's false rejections in total, and fixed-sequence testing needs no correction
   within a stratum. The error probability is shared by the strata (Bonferroni).
3. Small strata. A stratum with too few good labels to pass any test belongs to one pooled stratum. The counts of labels
   decide this, not the outcomes.

Good labels that a first step needs when it removes none of them (error 0.05):

    strata tested        1    2    4    8
    risk 0.01          299  368  437  505
    risk 0.02          149  183  217  252
    risk 0.05           59   72   86   99
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, lgamma, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.scratch import saved
from gridlake.llm.text import Chunk, chunks, is_separator, lines, mix, runs, words

SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
REPEAT_WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A document fails when ``signal`` (an SQL expression over the counts) exceeds its stratum's cutoff; candidates from lax to strict."""

    name: str
    signal: str
    candidates: tuple[float, ...]


# The rules, the most telling first, and their candidate cutoffs.
RULES = (
    Rule("symbols_per_word", "n_symbols / n_words", (4.0, 3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("long_words", "word_chars / n_words", (40.0, 30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0)),
    Rule("dup_line_share", "n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("repeat_share", "n_repeat_words / n_words", (0.2, 0.15, 0.1, 0.08, 0.06, 0.04)),
)


@dataclass(frozen=True)
class Settings:
    """``risk``: the share of a stratum's good documents that all rules together may remove; ``error``: the probability that any
    stratum exceeds it; ``gain``: the share of the stratum's bad documents that a step must remove besides those gone before."""

    risk: float = 0.02
    error: float = 0.05
    gain: float = 0.01
    rules: tuple[Rule, ...] = RULES


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """Each row's id, ``stratum`` and counts over its whole text.

    ``n_words``; ``word_chars`` (code points in words); ``n_symbols``; ``n_lines`` with a word; ``n_dup_lines``, those
    equal to an earlier line of the text; ``n_repeat_words``, words inside 5-word windows that stand in the text
    twice or more. A null or empty text has 0 of each. A null stratum is the stratum of nulls.
    """
    stratum = F.col(stratum_col).cast("string") if stratum_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), stratum.alias("stratum"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                here = slice(chunk.first, chunk.first + len(chunk))
                yield pa.RecordBatch.from_arrays([batch.column(0)[here], batch.column(1)[here], *map(pa.array, _counts(chunk))], ["id", "stratum", *SIGNALS])

    counts = ", ".join(f"{x} long" for x in SIGNALS)
    return rows.mapInArrow(measure, f"id {kind}, stratum string, {counts}").withColumnRenamed("id", id_col)


def _counts(chunk: Chunk) -> list[np.ndarray]:
    data, n = chunk.data, len(chunk)
    found = words(chunk)
    total = np.diff(found.before)

    def inside(mask: np.ndarray) -> np.ndarray:
        upto = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=upto[1:])
        return upto

    chars = np.diff(inside(~is_separator(data) & ((data & 0xC0) != 0x80))[chunk.offsets])
    symbols = np.diff(inside(_SYMBOL[data])[chunk.offsets])

    row, line, _, _ = lines(chunk, found)
    n_lines = np.bincount(row, minlength=n)
    _, first = np.unique(mix(line ^ mix(row.astype(np.uint64))), return_index=True)
    dup_lines = n_lines - np.bincount(row[first], minlength=n)

    at, code = runs(found.code, found.row, REPEAT_WINDOW)
    cover = np.zeros(len(found.row) + 1, np.int64)
    if len(at):
        _, which, often = np.unique(mix(code ^ mix(found.row[at].astype(np.uint64))), return_inverse=True, return_counts=True)
        again = at[often[which] > 1]
        np.add.at(cover, again, 1)
        np.add.at(cover, again + REPEAT_WINDOW, -1)
    repeat = np.bincount(found.row[np.cumsum(cover[:-1]) > 0], minlength=n)
    return [total, chars, symbols, dup_lines, repeat, n_lines]


def exceeds_risk_rejected(removed: int, good: int, risk: float, error: float) -> bool:
    """Exact one-sided binomial test: with ``removed`` of ``good`` documents removed, is a share above ``risk`` ruled out at level ``error``?"""
    if good == 0 or removed >= good * risk:
        return False
    k = np.arange(removed + 1)
    ways = lgamma(good + 1) - np.array([lgamma(i + 1) + lgamma(good - i + 1) for i in k])
    terms = ways + k * log(risk) + (good - k) * log1p(-risk)
    return bool(np.exp(terms - terms.max()).sum() * np.exp(terms.max()) <= error)


def labels_needed(risk: float, error: float) -> int:
    """The fewest good labels with which a step that removes none of them passes."""
    return ceil(log(error) / log1p(-risk))


def walk(levels: np.ndarray, good: np.ndarray, count: np.ndarray, s: Settings, error: float) -> list[float | None]:
    """The accepted cutoff of each rule (None: off) for one stratum.

    Its labelled documents are given as groups: ``levels`` (groups x rules), how many of a rule's candidates each exceeds;
    ``good``; and ``count``, their number.
    """
    n_good, n_bad = int(count[good].sum()), int(count[~good].sum())
    taken = np.zeros(len(s.rules), int)  # candidates in force, 0: the rule is off
    gone = np.zeros(len(count), bool)
    for r, rule in enumerate(s.rules):
        for step in range(1, len(rule.candidates) + 1):
            after = gone | (levels[:, r] > len(rule.candidates) - step)  # exceeds this candidate, so all stricter ones
            if count[~good & after].sum() - count[~good & gone].sum() < max(1, s.gain * n_bad):
                continue
            if not exceeds_risk_rejected(int(count[good & after].sum()), n_good, s.risk, error):
                return _cutoffs_of(taken, s)
            gone, taken[r] = after, step
    return _cutoffs_of(taken, s)


def _cutoffs_of(taken: np.ndarray, s: Settings) -> list[float | None]:
    return [rule.candidates[k - 1] if k else None for rule, k in zip(s.rules, taken.tolist(), strict=True)]


def _signal(rule: Rule) -> str:
    over, under = rule.signal.split(" / ")
    return f"try_divide({over}, {under})"


BASE_FAILED = "(n_words < 10 or 100 * n_repeat_words > 20 * n_words)"


def cutoffs(measured: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``stratum``, ``pooled``, ``good`` (labels) and a cutoff of every rule (null: off): a row for each stratum of its own, one for the pooled.

    Documents that fail the base are no part of the tests: the rules don't decide on them. An id with both labels has
    none; of rows with one id the strictest count. What leaves the labelled rows are counts of groups, as many a stratum
    as there are combinations of candidates at most, so no task or driver holds the labels.
    """
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    one = one.where("low = high and low in (0, 1)").select("doc_id", (F.col("low") == 1).alias("good"))
    level = {r.name: sum((F.coalesce((F.expr(_signal(r)) > x).cast("int"), F.lit(0)) for x in r.candidates), F.lit(0)) for r in s.rules}
    seen = measured.where(f"not {BASE_FAILED}").join(one, "doc_id").select("doc_id", "stratum", "good", *[c.alias(name) for name, c in level.items()])
    seen = seen.groupBy("doc_id", "good").agg(F.min("stratum").alias("stratum"), *[F.max(name).alias(name) for name in level])
    table = saved(seen.groupBy("stratum", "good", *level).agg(F.count("*").alias("n")), "strata")
    sizes = table.groupBy("stratum").agg(F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("labels"))
    tests = sizes.where(F.col("labels") >= labels_needed(s.risk, s.error)).count() + 1
    error = s.error / tests
    sizes = sizes.select(F.col("stratum").alias("own"), (F.col("labels") < labels_needed(s.risk, error)).alias("pooled"))
    parts = table.join(sizes, F.col("stratum").eqNullSafe(F.col("own")))
    parts = parts.groupBy("pooled", F.when(~F.col("pooled"), F.col("stratum")).alias("stratum"), "good", *level).agg(F.sum("n").alias("n"))
    names = list(level)

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        found = walk(frame[names].to_numpy(), frame["good"].to_numpy(bool), frame["n"].to_numpy(), s, error)
        out = pd.DataFrame({"stratum": [frame["stratum"].iloc[0]], "pooled": [bool(frame["pooled"].iloc[0])], "good": [int(frame.loc[frame["good"], "n"].sum())]})
        return out.assign(**{name: pd.array([x], dtype="Float64") for name, x in zip(names, found, strict=True)})

    schema = "stratum string, pooled boolean, good long, " + ", ".join(f"{name} double" for name in names)
    return parts.groupBy("pooled", "stratum").applyInPandas(choose, schema)


def verdicts(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Every row's counts, ``base_failed``, ``failed_rules`` (array) and ``kept``.

    ``base_failed``: fewer than 10 words, or more than a fifth of the words repeated. A null or empty text fails the
    base. Repeated rows are judged each; a null id has no label; a null language is the stratum of nulls. Long texts are
    measured whole: a task holds some 100 bytes for each word of the longest one. Columns of ``docs`` other than
    doc_id, text and lang are left out. Empty tables give empty tables; without labels only the base counts.
    """
    measured = saved(signals(docs), "signals")
    chosen = saved(cutoffs(measured, labels, s), "cutoffs")
    pooled = chosen.where("pooled").first()  # one row at most, a number for each rule
    own = chosen.where("not pooled").select(F.col("stratum").alias("own"), F.lit(True).alias("has_own"), *[r.name for r in s.rules])
    both = measured.join(own, measured["stratum"].eqNullSafe(own["own"]), "left")
    failed = []
    for r in s.rules:
        cutoff = F.when(F.col("has_own"), F.col(r.name)).otherwise(F.lit(pooled[r.name] if pooled else None).cast("double"))
        failed.append(F.when(F.expr(_signal(r)) > cutoff, F.lit(r.name)))
    base = F.expr(BASE_FAILED)
    return both.select("doc_id", *SIGNALS, base.alias("base_failed"), F.array_compact(F.array(*failed)).alias("failed_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )
