"""Benchmark decontamination (operator 7): MinHash containment search, partitioned by size.

A short test item inside a long document has a tiny Jaccard similarity with the whole of it, so documents are searched
in overlapping windows. Items are partitioned by their number of shingles into classes (U/2, U]; for each class a
document is cut into windows of 2U shingle positions, one every U, so that any stretch of U positions lies inside one.
An item contained to ``share`` in such a stretch shares at least a fifth of the union with its window; min-max
signatures of ``values`` entries then agree in one entry but for a probability of 1e-6. Windows whose signature meets
an item's are candidates, and each (document, item) is verified by exact containment of the item's shingles in the
whole document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gridlake.llm.text import CHUNK_BYTES, Chunk, Words, chunks, mix, runs, words

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """Items count as contained when ``share`` or more of their distinct ``shingle``-word runs stand in a document.

    ``block_shingles`` bounds the item shingles that are sent to the executors at once; a larger benchmark is searched
    in several blocks, each a pass over the documents.
    """

    shingle: int = 5
    share: float = 0.8
    permutations: int = 32
    block_shingles: int = 2_000_000


def _hashes(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(23)
    return rng.integers(0, 1 << 63, s.permutations, dtype=np.uint64) * _U(2) + _U(1), rng.integers(0, 1 << 63, s.permutations, dtype=np.uint64)


class Items:
    """A block of test items: shingle sets by item, and by size class the signature entries to meet."""

    def __init__(self, ids: list, texts: list[str], s: Settings):
        self.ids, self.sets, self.width = ids, [], []
        classes: dict[tuple[int, int], list[int]] = {}
        for chunk in chunks(pa.array(texts, pa.string())):
            found = words(chunk, lower=True)
            for i in range(len(chunk)):
                first, last = found.before[i], found.before[i + 1]
                k = int(min(s.shingle, last - first))
                own = np.unique(runs(found.code[first:last], found.row[first:last], k)[1]) if k else np.zeros(0, np.uint64)
                if k:
                    size = 1 << max(2, int(len(own) - 1).bit_length())
                    classes.setdefault((k, size), []).append(len(self.sets))
                self.sets.append(own)
                self.width.append(k)
        factor, shift = _hashes(s)
        # (words in a shingle, class size) -> for each signature entry its sorted values, and the item of each.
        self.classes = {}
        for key, members in classes.items():
            entries = []
            for a, b in zip(factor, shift, strict=True):
                for pick in (np.min, np.max):
                    value = np.array([pick((self.sets[m] ^ b) * a) for m in members], np.uint64)
                    order = np.argsort(value, kind="stable")
                    entries.append((value[order], np.array(members)[order]))
            self.classes[key] = entries

    def matches(self, chunk: Chunk, found: Words, s: Settings) -> list[tuple[int, int, float]]:
        """(row, item, containment) of the verified items."""
        factor, shift = _hashes(s)
        sure: list[tuple[int, int, float]] = []
        for k in sorted({k for k, _ in self.classes}):
            at, code = runs(found.code, found.row, k)
            if not len(at):
                continue
            row = found.row[at]
            candidates: set[tuple[int, int]] = set()
            sizes = sorted(size for j, size in self.classes if j == k)
            # Blocks of the smallest class's size, never across rows; larger classes join neighbouring blocks.
            first = np.searchsorted(row, np.arange(len(chunk) + 1))
            length = np.diff(first)
            blocks = -(-length // sizes[0])
            owner = np.repeat(np.arange(len(chunk)), blocks)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            begin = first[owner] + place * sizes[0]
            for j, (a, b) in enumerate(zip(factor, shift, strict=True)):
                value = (code ^ b) * a
                for half, fold in enumerate((np.minimum, np.maximum)):
                    low, rows, spot, size = fold.reduceat(value, begin), owner, place, sizes[0]
                    for wanted in sizes:
                        while size < wanted:
                            low, rows, spot = _pairs(low, rows, spot, fold)
                            size *= 2
                        # A window is two neighbouring blocks; a row's last block may be a window of its own.
                        window = low.copy()
                        if len(low) > 1:
                            window[:-1] = np.where(rows[:-1] == rows[1:], fold(low[:-1], low[1:]), low[:-1])
                        values, members = self.classes[k, wanted][2 * j + half]
                        left = np.searchsorted(values, window, "left")
                        hit = np.flatnonzero((left < len(values)) & (values[np.minimum(left, len(values) - 1)] == window))
                        if len(hit):
                            right = np.searchsorted(values, window[hit], "right")
                            for h, e in zip(hit.tolist(), right.tolist(), strict=True):
                                candidates.update((int(rows[h]), int(m)) for m in members[left[h] : e])
            whole: dict[int, np.ndarray] = {}
            for r, m in sorted(candidates):
                if k < s.shingle and found.before[r + 1] - found.before[r] != k:
                    continue  # an item shorter than a shingle is contained in a text of just its words
                if r not in whole:
                    whole[r] = np.unique(code[first[r] : first[r + 1]])
                own = self.sets[m]
                there = np.isin(own, whole[r], assume_unique=True).sum()
                if there >= s.share * len(own) - 1e-9:
                    sure.append((r, m, float(there / len(own))))
        return sorted(sure)


def _pairs(low: np.ndarray, rows: np.ndarray, spot: np.ndarray, fold: np.ufunc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of twice the size: each even block with the next of its row."""
    even = np.flatnonzero(spot % 2 == 0)
    mate = np.minimum(even + 1, len(low) - 1)
    both = (mate > even) & (rows[mate] == rows[even])
    return np.where(both, fold(low[even], low[mate]), low[even]), rows[even], spot[even] // 2


def _item_blocks(spark: SparkSession, items: DataFrame, s: Settings, item_col: str) -> Iterator[Broadcast]:
    """The items as broadcasts of bounded size, in as many blocks as their text needs."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tests = items.select(F.col(item_col).alias("item"), text.alias("text")).where(F.col("item").isNotNull()).distinct()
    size = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * s.block_shingles)))  # a word and its space are two characters at least
    for block in range(blocks):
        taken = tests.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "text").collect()
        yield spark.sparkContext.broadcast(Items([t.item for t in taken], [t.text for t in taken], s))


def contaminated(docs: DataFrame, items: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Each row's id, ``item_ids`` (sorted; the items contained in it), ``max_containment`` and ``contaminated``.

    Words are runs of other characters than spaces and controls 9 to 13, lower-cased (A-Z). An item with fewer words
    than a shingle is contained in the documents that consist of just its words; one without words is in no document. Null and empty texts hold
    nothing. Rows with a null item id count for nothing. A null document id stays null; repeated rows are each
    searched; long texts are searched whole; other columns are left out; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("key"))
    kind, item_kind = rows.schema["id"].dataType.simpleString(), items.schema[item_col].dataType
    schema = f"id {kind}, key long, item_ids array<{item_kind.simpleString()}>, max_containment double"
    list_type = pa.list_(to_arrow_type(item_kind))
    parts = []
    for shared in _item_blocks(docs.sparkSession, items, s, item_col):

        def search(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            wanted = shared.value
            for batch in batches:
                for chunk in chunks(batch.column(1), CHUNK_BYTES // 4):
                    found: list[dict] = [{} for _ in range(len(chunk))]
                    for r, m, share in wanted.matches(chunk, words(chunk, lower=True), s):
                        item = wanted.ids[m]
                        found[r][item] = max(share, found[r].get(item, 0.0))
                    here = slice(chunk.first, chunk.first + len(chunk))
                    lists, best = pa.array([sorted(x) for x in found], list_type), pa.array([max(x.values(), default=0.0) for x in found])
                    yield pa.RecordBatch.from_arrays([batch.column(0)[here], batch.column(2)[here], lists, best], ["id", "key", "item_ids", "max_containment"])

        parts.append(rows.mapInArrow(search, schema))
    found = parts[0]
    if len(parts) > 1:
        hits = reduce(DataFrame.union, parts).where(F.size("item_ids") > 0)
        hits = hits.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.max("max_containment").alias("max_containment")
        )
        found = rows.select("id", "key").join(hits, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
        found = found.withColumn("item_ids", F.coalesce("item_ids", F.array().cast(f"array<{item_kind.simpleString()}>")))
    best = F.coalesce("max_containment", F.lit(0.0)).alias("max_containment")
    return found.select(F.col("id").alias(id_col), "item_ids", best, (F.size("item_ids") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame, s: Settings = Settings(), text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs``, all columns, whose text contains no item. Cases are those of ``contaminated``; nothing is shuffled."""
    at = docs.columns.index(text_col)
    for shared in _item_blocks(docs.sparkSession, items, s, item_col):

        def clean(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for chunk in chunks(batch.column(at)):
                    for r, _, _ in shared.value.matches(chunk, words(chunk, lower=True), s):
                        keep[chunk.first + r] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
