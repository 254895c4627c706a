"""Target-distribution importance resampling (operator 13).

1. Features (runs of one and two words) are hashed into buckets. Each task counts its buckets in one array; the sums over
   tasks give a bucket's gain, the logarithm of its smoothed share in the target over that in the corpus.
2. Documents are scored from the array of gains: the floored mean of their features' gains, and Gumbel noise from a hash of
   the id. So the highest scores are a draw without replacement in proportion to the importance weights.
3. The score of the last drawn document is found exactly by weighted median-of-medians selection. Each partition gives
   the median of the keys that it has left; their median, weighted by the numbers of keys left, is the next pivot. At
   least a quarter of the keys lie on either side of it, so that a round discards a quarter or more. A round is one job over
   the stored keys: tasks count both sides of the pivot and find the medians of both, whichever the driver keeps.
4. Only the drawn documents are sorted; ranks come from their place in their range and the sizes of the ranges before.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.scratch import saved
from gridlake.llm.text import Chunk, byte_runs, chunks

_INSIDE = np.ones(256, bool)
_INSIDE[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
#: The reflected polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320
_LONG_WORD = 64


@dataclass(frozen=True)
class Settings:
    """``buckets`` of features; of the documents with ``least_words`` words, ``percent`` % are drawn. ``seed`` makes another draw.

    ``finish``: when so few keys are left, the cutoff is read off them.
    """

    buckets: int = 10_000
    percent: int = 25
    least_words: int = 20
    seed: int = 7
    finish: int = 2_000


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_BYTE = _byte_table()


@lru_cache(4096)
def _skip(n: int) -> np.ndarray:
    """What n zero bytes make of a CRC register, as four tables of 256 (one for each of its bytes)."""
    if n == 0:
        units = np.uint32(1) << np.arange(32, dtype=np.uint32)
    else:
        half = _skip(n // 2)
        units = _apply(half, _apply(half, np.uint32(1) << np.arange(32, dtype=np.uint32)))
        if n % 2:
            units = _BYTE[units & 255] ^ (units >> 8)
    table = np.zeros((4, 256), np.uint32)
    for bit in range(8):
        table[:, 1 << bit : 2 << bit] = table[:, : 1 << bit] ^ units.reshape(4, 8)[:, bit : bit + 1]
    return table


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0][x & 255] ^ table[1][(x >> 8) & 255] ^ table[2][(x >> 16) & 255] ^ table[3][x >> 24]


def word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte span, all words a byte further at a time; long ones on their own."""
    size = end - start
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    left = np.flatnonzero(size <= _LONG_WORD)
    for i in range(_LONG_WORD):
        left = left[size[left] > i]
        if not len(left):
            break
        now = crc[left]
        crc[left] = _BYTE[(now ^ data[start[left] + i]) & 255] ^ (now >> 8)
    crc = ~crc
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        crc[i] = zlib.crc32(data[start[i] : end[i]])
    return crc


def joined_crcs(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of first + second from the CRCs of both and the sizes of the second."""
    out = np.empty(len(first), np.uint32)
    order = np.argsort(size, kind="stable")
    lengths, border = np.unique(size[order], return_index=True)
    for n, a, b in zip(lengths.tolist(), border.tolist(), [*border[1:].tolist(), len(order)], strict=True):
        rows = order[a:b]
        out[rows] = _apply(_skip(n), first[rows]) ^ second[rows]
    return out


def features(chunk: Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every feature of a chunk, row by row, and where each row's features begin (one border more than rows)."""
    data, start, end = byte_runs(chunk, _INSIDE)
    row = np.searchsorted(chunk.offsets[1:], start, "right")
    one = word_crcs(data, start, end)
    pair = np.flatnonzero(row[:-1] == row[1:])
    spaced = _BYTE[(~one[pair] ^ 0x20) & 255] ^ (~one[pair] >> np.uint32(8))
    two = joined_crcs(~spaced, one[pair + 1], (end - start)[pair + 1])
    words = np.searchsorted(row, np.arange(len(chunk) + 1))
    pairs = np.searchsorted(row[pair], np.arange(len(chunk) + 1))
    border = words + pairs
    out = np.empty(len(one) + len(two), np.int64)
    # Within a row: its words, then its pairs.
    out[np.arange(len(one)) + pairs[row]] = one.astype(np.int64) % buckets
    out[np.arange(len(two)) + words[row[pair] + 1]] = two.astype(np.int64) % buckets
    return out, border


def bucket_counts(docs: DataFrame, s: Settings, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. Tasks send one row a bucket; ``buckets`` numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.buckets, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                total += np.bincount(features(chunk, s.buckets)[0], minlength=s.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    out = np.zeros(s.buckets, np.int64)
    for bucket, n in texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the corpus, floored."""
    all_corpus, all_target, k = int(corpus.sum()), int(target.sum()), len(corpus)
    shares = [(t + 1.0) * (all_corpus + float(k)) / ((c + 1.0) * (all_target + float(k))) for c, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in shares], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_features``, ``weight`` and ``score`` (null for a null id) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                bucket, border = features(chunk, s.buckets)
                n = np.diff(border)
                upto = np.concatenate([[0], np.cumsum(gain[bucket])])
                weight = (upto[border[1:]] - upto[border[:-1]]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0)[chunk.first : chunk.first + len(chunk)], pa.array(n), pa.array(weight)], ["id", "n_features", "weight"])

    weighed = rows.mapInArrow(weigh, f"id {kind}, n_features long, weight long")
    digits = F.substring(F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("id").cast("string")), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.ln(-F.ln(u))).cast("long"))


# A key is (score, id rank order, row): larger scores first, then smaller ids, then smaller row numbers. Keys are compared as
# columns (-score, id, row), smaller first, so all three ascend.


def _ordered(keys: tuple[np.ndarray, ...]) -> np.ndarray:
    return np.lexsort(keys[::-1])


def _before(keys: tuple[np.ndarray, ...], pivot: tuple) -> np.ndarray:
    """Which keys stand before the pivot."""
    a, b, c = keys
    x, y, z = pivot
    return (a < x) | ((a == x) & ((b < y) | ((b == y) & (c < z))))


def _median(keys: tuple[np.ndarray, ...]) -> tuple[int, int, int] | None:
    if not len(keys[0]):
        return None
    middle = (len(keys[0]) - 1) // 2
    # The keys that share the median's first component decide among themselves.
    first = np.partition(keys[0], middle)[middle]
    same = np.flatnonzero(keys[0] == first)
    rest = tuple(k[same] for k in keys)
    at = _ordered(rest)[middle - int((keys[0] < first).sum())]
    return tuple(int(k[at]) for k in rest)


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The median of medians, each weighted by the keys that it stands for."""
    ordered = sorted(medians)
    half, seen = sum(n for _, n in ordered) / 2, 0
    for key, n in ordered:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no medians")


def cutoff(keys: DataFrame, draw: int, s: Settings = Settings()) -> tuple | None:
    """The ``draw``-th key in order of the columns (``a``, ``b``, ``c``), longs that are together unique; null if there are fewer.

    The medians of a round are one for each partition of the stored keys, so the driver gets a few numbers a
    partition; a task holds 24 bytes for each key of its partition that is left.
    """
    low: tuple | None = None  # the keys left lie after low and before high
    high: tuple | None = None

    def left(batches: Iterator[pa.RecordBatch], low, high) -> tuple[np.ndarray, ...]:
        parts = []
        for batch in batches:
            own = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            inside = np.ones(len(own[0]), bool)
            if high is not None:
                inside &= _before(own, high)
            if low is not None:
                inside &= ~_before(own, (*low[:2], low[2] + 1))
            parts.append(tuple(k[inside] for k in own))
        return tuple(np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int64)]) for i in range(3))

    def round_of(pivot: tuple | None) -> list:
        """(side, keys, their median) of each partition: side 0 stands before the pivot, 1 after it; without one all is side 0."""
        now_low, now_high = low, high

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = left(batches, now_low, now_high)
            before = np.ones(len(own[0]), bool) if pivot is None else _before(own, pivot)
            after = ~before if pivot is None else ~_before(own, (*pivot[:2], pivot[2] + 1))
            found = []
            for side, mask in enumerate((before, after)):
                part = tuple(k[mask] for k in own)
                if len(part[0]):
                    found.append((side, len(part[0]), *_median(part)))
            columns = list(zip(*found, strict=True)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["side", "n", "a", "b", "c"])

        return keys.mapInArrow(measure, "side long, n long, a long, b long, c long").collect()

    found = round_of(None)
    total = sum(r["n"] for r in found)
    if draw < 1 or draw > total:
        return None
    wanted, medians = draw, [((r["a"], r["b"], r["c"]), r["n"]) for r in found]
    while total > s.finish:
        pivot = weighted_median(medians)
        found = round_of(pivot)
        before = sum(r["n"] for r in found if r["side"] == 0)
        if wanted == before + 1:
            return pivot
        side = 0 if wanted <= before else 1
        if side:
            low, wanted, total = pivot, wanted - before - 1, total - before - 1
        else:
            high, total = pivot, before
        medians = [((r["a"], r["b"], r["c"]), r["n"]) for r in found if r["side"] == side]
    rest = keys
    if high is not None:
        rest = rest.where(_stands_before(high))
    if low is not None:
        rest = rest.where(~_stands_before((*low[:2], low[2] + 1)))
    last = rest.select("a", "b", "c").orderBy("a", "b", "c").limit(wanted).collect()  # ``finish`` keys at most
    return tuple(last[-1])


def _stands_before(key: tuple) -> F.Column:
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    x, y, z = key
    return (a < x) | ((a == x) & ((b < y) | ((b == y) & (c < z))))


def resample(docs: DataFrame, target: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Every row's id, ``n_features``, ``weight``, ``score`` and ``rank`` (1 for the highest score drawn; null if not drawn).

    Of the N rows with ``least_words`` words, floor(N * ``percent`` / 100) are drawn, the highest scores first and
    of equal ones the smallest id; repeated rows are further ordered by their place in the stored table. Ids are
    integers. A null or wordless text has no feature, weight 0, and isn't drawn (unless ``least_words`` is 0). A row
    with a null id has no score, isn't drawn and doesn't count in N. An empty target gives every bucket the
    smoothed share only; an empty table gives an empty table. Other columns are left out, whatever their names. Long
    texts are taken whole: a task holds some 60 bytes for each byte of the longest one.
    """
    gain = gains(bucket_counts(docs, s, text_col), bucket_counts(target, s, target_col))
    # The row number is fixed by being written; a key is then unique even for repeated rows.
    table = saved(scored(docs, gain, s, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "scores")
    able = F.col("id").isNotNull() & (F.col("n_features") >= max(0, 2 * s.least_words - 1))
    keys = table.where(able).select((-F.col("score")).alias("a"), F.col("id").cast("long").alias("b"), F.col("row").alias("c"))
    last = cutoff(keys, table.where(able).count() * s.percent // 100, s)
    names = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if last is None:
        return table.select(*names, F.lit(None).cast("long").alias("rank"))
    keyed = table.withColumns({"a": -F.col("score"), "b": F.col("id").cast("long"), "c": F.col("row")})
    drawn = able & (_stands_before(last) | ((F.col("a") == last[0]) & (F.col("b") == last[1]) & (F.col("c") == last[2])))
    winners = keyed.where(drawn).select("id", "n_features", "weight", "score", "a", "b", "c")
    # Sorted ranges, numbered in order by the task that writes each; the rank is the place in the range and the ranges before.
    place = saved(winners.sort("a", "b", "c").drop("a", "b", "c").withColumn("place", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("place", 33)
    sizes = sorted(tuple(r) for r in place.groupBy(part.alias("part")).count().collect())  # one row a range
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    starts = docs.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part long, before long")
    # One row a sorted range, which the session's number of shuffle partitions bounds.
    ranked = place.withColumn("part", part.cast("long")).join(F.broadcast(starts), "part")
    ranked = ranked.select(*names, (F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).alias("rank"))
    return ranked.union(keyed.where(~F.coalesce(drawn, F.lit(False))).select(*names, F.lit(None).cast("long")))
