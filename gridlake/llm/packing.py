"""Concatenate and cut (operator 4): documents become one stream of tokens, cut into windows of a fixed length.

First pass: each partition encodes its rows in order, writes the ids to a shared table and notes the tokens before
each row. A prefix sum over the partitions' totals (one row each) gives every row its global place. Second pass:
the written ids are cut where windows end. Encoding runs once; nothing is shuffled but the totals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.scratch import saved
from gridlake.llm.text import chunks
from gridlake.llm.tokens import ENCODED_BYTES, encoder


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut all documents into sequences of ``window`` tokens; only the last sequence can be shorter.

    Returns one row for each piece of a document: the id column; ``start`` (ids of the document before the piece);
    ``length``; ``doc_tokens`` (with the closing ``end_id``); ``sequence_id`` and ``offset``, the piece's place;
    ``ids``, the piece's ids as little-endian unsigned 32-bit numbers. ``boundaries`` lists where documents end.

    A null or empty text is its ``end_id`` alone; a null id stays null and its text is packed; repeated rows are
    packed each; other columns are left out; an empty table gives no piece; a document longer than a window is
    spread over as many as it needs.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("part"))
    kind = rows.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, at = encoder(tokenizer_path), 0
        for batch in batches:
            for chunk in chunks(batch.column(1), ENCODED_BYTES):
                ids, border = ids_of(chunk)
                end = np.array([end_id], ids.dtype).tobytes()
                raw, wide = ids.tobytes(), ids.dtype.itemsize
                stored = [raw[a * wide : b * wide] + end for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True)]
                sizes = np.diff(border) + 1
                before = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                here = slice(chunk.first, chunk.first + len(chunk))
                columns = [batch.column(0)[here], batch.column(2)[here], pa.array(before), pa.array(sizes), pa.array(stored, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "part", "before", "doc_tokens", "stored"])

    table = saved(rows.mapInArrow(encode, f"id {kind}, part int, before long, doc_tokens long, stored binary"), "pack")
    totals = table.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    # One row a partition of the input, a few bytes each: small beside any executor.
    placed = table.join(F.broadcast(bases), "part").select("id", (F.col("base") + F.col("before")).alias("place"), "doc_tokens", "stored")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = batch.column(3)
            for first in range(0, batch.num_rows, 256):
                here = slice(first, min(first + 256, batch.num_rows))
                place = batch.column(1)[here].to_numpy(zero_copy_only=False)
                total = batch.column(2)[here].to_numpy(zero_copy_only=False)
                pieces = (place + total - 1) // window - place // window + 1
                row = np.repeat(np.arange(len(place)), pieces)
                sequence = place[row] // window + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin = np.maximum(sequence * window, place[row])
                end = np.minimum((sequence + 1) * window, place[row] + total[row])
                start, length = begin - place[row], end - begin
                wide = [_as_32(stored[first + i].as_py(), int(n)) for i, n in enumerate(total)]
                ids = [wide[r][4 * a : 4 * (a + n)] for r, a, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[here].take(pa.array(row)), *map(pa.array, (start, length, total[row], sequence, begin - sequence * window)), pa.array(ids, pa.binary())],
                    ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    schema = f"id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return placed.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def _as_32(stored: bytes, n: int) -> bytes:
    return np.frombuffer(stored, f"<u{len(stored) // n}").astype("<u4").tobytes()


def boundaries(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The boundary records of packed sequences: where in which sequence each document's last token stands."""
    return pieces.where(F.col("start") + F.col("length") == F.col("doc_tokens")).select(
        "sequence_id", (F.col("offset") + F.col("length")).alias("end_offset"), id_col
    )
