"""Quality classifier (operator 9): logistic regression over hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.text import CHUNK_BYTES, Chunk, chunks, mix, words

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """``bits``: log2 of the weights; ``sample``: labelled rows to train on at most; the rest as usual for FTRL."""

    bits: int = 18
    sample: int = 4000
    passes: int = 10
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.02


def features(chunk: Chunk, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of each row: index, value, and the border of each row in them.

    The n-grams are lower-cased words and pairs of words, and words and pairs of words reduced to their shape (case,
    last character and whether it has digits or symbols), which carries over to words never seen in training. A
    row's counts are square-rooted and scaled to length 1; one constant feature (index 0) stands for the bias.
    """
    plain, shape = words(chunk, lower=True), _shapes(chunk)
    size = _U((1 << bits) - 1)
    row = plain.row
    grams, rows = [], []
    for code, salt in ((plain.code, 1), (shape, 2)):
        grams.append(mix(code + _U(salt)))
        rows.append(row)
        if len(code) > 1:
            pair = np.flatnonzero(row[:-1] == row[1:])
            grams.append(mix(code[pair] * _U(31) + code[pair + 1] + _U(salt + 10)))
            rows.append(row[pair])
            same = pair[plain.code[pair] == plain.code[pair + 1]]
            grams.append(np.full(len(same), mix(np.array([99], np.uint64))[0]))
            rows.append(row[same])
    index = (np.concatenate(grams) & size).astype(np.int64)
    index[index == 0] = 1
    key = (np.concatenate(rows).astype(np.int64) << bits) | index
    key, count = np.unique(key, return_counts=True)
    row, index = key >> bits, key & int(size)
    value = np.sqrt(count.astype(np.float64))
    border = np.searchsorted(row, np.arange(len(chunk) + 1))
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(chunk)))
    return index, value / norm[row], border


def _shapes(chunk: Chunk) -> np.ndarray:
    """A small code of each word: upper-case letters, letters at all, digits, symbols, last byte if it is ASCII punctuation, length class."""
    found, data = words(chunk), chunk.data
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    flags = np.zeros(len(found.start), np.uint64)
    for kind in (upper, letter, digit, ~(letter | digit)):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind, out=total[1:])
        n = total[found.end] - total[found.start]
        flags = flags * _U(3) + np.minimum(n, 2).astype(np.uint64)
    last = data[found.end - 1] if len(data) else np.zeros(0, np.uint8)
    last = np.where(letter[found.end - 1] | digit[found.end - 1], 0, last) if len(data) else last
    long = np.minimum((found.end - found.start) // 8, 4).astype(np.uint64)
    return (flags * _U(256) + last.astype(np.uint64)) * _U(5) + long


def fit(index: list[np.ndarray], value: list[np.ndarray], label: np.ndarray, s: Settings) -> np.ndarray:
    """FTRL-proximal with one adaptive rate for each weight; rows are visited in a fixed shuffled order."""
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    order = np.random.default_rng(7)

    def weights(i: np.ndarray) -> np.ndarray:
        free = np.abs(z[i]) > s.l1
        return np.where(free, -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2), 0.0)

    for _ in range(s.passes):
        for r in order.permutation(len(label)):
            i, v = index[r], value[r]
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ v, -35, 35)))
            g = (p - label[r]) * v
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / s.alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(1 << s.bits))


def _with_bias(index: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.append(index, 0), np.append(value, 1.0)


def train(labelled: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Weights from a table of ``text`` and ``label`` (0 or 1) of at most ``settings.sample`` rows, in one Spark task."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            label = batch.column(1).to_pylist()
            for chunk in chunks(batch.column(0), CHUNK_BYTES // 4):
                index, value, border = features(chunk, settings.bits)
                for i in range(len(chunk)):
                    a, b = border[i], border[i + 1]
                    seen.append((zlib.crc32(index[a:b].tobytes()), label[chunk.first + i], *_with_bias(index[a:b].copy(), value[a:b].copy())))
        seen.sort(key=lambda x: (x[0], x[1]))  # the same weights however Spark ordered the rows
        label = np.array([x[1] for x in seen], float)
        w = fit([x[2] for x in seen], [x[3] for x in seen], label, settings) if len(seen) else np.zeros(1 << settings.bits)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f8").tobytes()], pa.binary())], ["weights"])

    found = labelled.select(F.col("text").cast("string"), F.col("label").cast("int")).coalesce(1).mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(found[0].weights, "<f8") if found else np.zeros(1 << settings.bits)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and ``score``, 0 to 1: the logistic of a sparse dot product over its whole text.

    Null and empty texts get the bias alone; a null id stays null; repeated rows are scored each.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    bits = len(weights).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** bits numbers, whatever the input

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), shared.value, bits))], ["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(dot, f"id {kind}, score double").withColumnRenamed("id", id_col)


def without_rejected(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold; nothing is shuffled."""
    bits, at = len(weights).bit_length() - 1, docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(at), shared.value, bits) >= threshold))

    return docs.mapInArrow(good, docs.schema)


def _scores(texts: pa.Array, w: np.ndarray, bits: int) -> np.ndarray:
    scores = [np.zeros(0)]
    for chunk in chunks(texts, CHUNK_BYTES // 4):
        index, value, border = features(chunk, bits)
        total = np.full(len(chunk), w[0])
        full = np.flatnonzero(np.diff(border))
        if len(full):  # each row's own sum, whatever rows share its batch
            total[full] += np.add.reduceat(w[index] * value, border[full])
        scores.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
    return np.concatenate(scores)


def held_out(id_col: str = "doc_id") -> F.Column:
    """True for the fifth of the ids whose checksum is divisible by 5; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``text`` and ``label`` of at most ``settings.sample`` labelled rows outside the held-out fifth.

    The rows with the smallest hash of their id are taken, so the choice is fixed and independent of order. Null
    labels and ids are left out; an id with several labels has its smallest.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    few = usable.groupBy("doc_id").agg(F.min("quality").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    # At most settings.sample pairs of numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("label").alias("label"))
    return texts.select("text", "label")


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """Train on the labelled sample and score every document: doc_id, ``held_out``, ``score``, ``predicted``.

    Labels, language, source and id are no inputs of a score. Without any label every weight is 0 and every score
    one half; an empty table gives an empty table. Long texts are scored whole: a task holds some 300 bytes for each word
    of the longest one. Columns other than doc_id and text (in ``labels``: doc_id and quality) are never looked at.
    """
    weights = train(training_sample(docs, labels, settings), settings)
    return score(docs, weights).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
