"""Line deduplication (operator 6): repeated line runs from a suffix array of the line sequences.

1. Prefix doubling. The suffixes of the documents' line sequences are ranked by their first 1, 2, 4, ... lines. A round pairs
   the rank at a line with the rank as many lines further on (inside the document), sorts the distinct pairs over all
   documents, and numbers them in that order. Suffixes whose pair no other shares stand alone in their interval of the
   suffix array and drop out; the rounds end when none is left.
2. Longest common prefixes. Suffixes of one rank are an interval of the suffix array with a longest common prefix of that
   many lines at least. A suffix in an interval with an earlier place is a later copy. Its exact common prefix with the
   earliest place of its last interval is found by descending through the ranks, halving the step each time.
3. Deletion. Each run so found that doesn't continue one from the line before is a maximal repeated run; its later copy goes.
   Every line of any repeated run starts, or follows in, a run of a power of two that stands earlier, so the runs
   cover all later copies whichever earlier place they are compared with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.scratch import dropped, saved, settled
from gridlake.llm.text import chunks, lines, words


@dataclass(frozen=True)
class Settings:
    """A repeated run is deleted when it has ``min_lines`` lines (a power of two) or, for shorter ones, a line of ``min_words`` words.

    So a single repeated line of fewer words stays unless a neighbour repeats with it.
    """

    min_lines: int = 2
    min_words: int = 10


def line_table(docs: DataFrame) -> DataFrame:
    """(id, key, pos, name, words) of every line with a word; ``pos`` counts those lines. ``docs``: id, text, key."""
    kind = docs.schema["id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                row, code, size, _ = lines(chunk, words(chunk))
                pos = np.arange(len(row)) - np.searchsorted(row, row)
                at = pa.array(chunk.first + row)
                columns = [batch.column(0).take(at), batch.column(2).take(at), pa.array(pos.astype(np.int32)), pa.array(code.view(np.int64)), pa.array(size.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "pos", "name", "words"])

    return docs.select("id", "text", "key").mapInArrow(split, f"id {kind}, key long, pos int, name long, words int")


_PLACE = ("id", "key", "pos")


def _ranked(named: DataFrame, by: list[str]) -> DataFrame:
    """The suffixes whose ``by`` another place shares, with the ``rank`` of these in order, the earliest place, and ``later``.

    The groups are a written table, so that adaptive execution can split a line that very many documents share.
    """
    place = F.struct(*_PLACE)
    groups = named.groupBy(*by).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    groups = saved(groups.select(*by, "first").sort(*by).withColumn("rank", F.monotonically_increasing_id()), "groups")
    found = named.join(groups, by).drop(*by).withColumn("later", place > F.col("first"))
    found = saved(found.dropDuplicates(list(_PLACE)), "suffixes")  # repeated rows of a document have the same places
    dropped(groups)
    return found


def suffix_ranks(table: DataFrame) -> list[DataFrame]:
    """For 1, 2, 4, ... lines a table of the shared suffixes: place, ``rank``, ``first`` (earliest place of the rank), ``later``."""
    levels = [_ranked(table, ["name"])]
    while not levels[-1].isEmpty():
        size = 1 << (len(levels) - 1)
        ahead = Window.partitionBy("id", "key").orderBy("pos").rangeBetween(size, size)
        pairs = levels[-1].select(*_PLACE, F.col("rank").alias("here"), F.first("rank").over(ahead).alias("next")).where("next is not null")
        pairs = saved(pairs, "pairs")
        levels.append(_ranked(pairs, ["here", "next"]))
        dropped(pairs)
    dropped(levels.pop())
    return levels


def _longest_runs(levels: list[DataFrame]) -> DataFrame:
    """Every later copy: place, ``first``, the earliest place of its last interval, and ``size``, their common prefix in lines.

    Each step down the ranks is a written table of the copies from the levels above. So no plan holds more than two joins
    however many levels there are: the driver plans all exchanges of a plan at once, and its memory would grow with them.
    """
    tops = [rank.where("later").select(*_PLACE, F.lit(k).alias("level"), "first") for k, rank in enumerate(levels)]
    tops = reduce(DataFrame.union, tops).groupBy(*_PLACE).agg(F.max(F.struct("level", "first")).alias("top"))
    tops = saved(tops.select(*_PLACE, "top.first", "top.level", F.expr("shiftleft(1, top.level)").alias("size")), "tops")
    columns, longer = [*_PLACE, "first", "size"], None
    for k in reversed(range(len(levels) - 1)):
        runs = tops.where(F.col("level") == k + 1).select(*columns)
        runs = runs if longer is None else runs.union(longer)
        own = levels[k].select("id", "key", F.col("pos").alias("at"), F.col("rank").alias("own_rank"))
        theirs = levels[k].select(F.col("id").alias("f_id"), F.col("key").alias("f_key"), F.col("pos").alias("f_at"), F.col("rank").alias("first_rank"))
        ahead = runs.withColumn("at", F.col("pos") + F.col("size"))
        ahead = ahead.withColumns({"f_id": F.col("first.id"), "f_key": F.col("first.key"), "f_at": F.col("first.pos") + F.col("size")})
        ahead = ahead.join(own, ["id", "key", "at"], "left").join(theirs, ["f_id", "f_key", "f_at"], "left")
        more = F.when(F.col("own_rank") == F.col("first_rank"), 1 << k).otherwise(0)
        before, longer = longer, saved(ahead.select(*_PLACE, "first", (F.col("size") + more).alias("size")), "longer")
        if before is not None:
            dropped(before)
    runs = tops.where("level = 0").select(*columns)
    return runs if longer is None else runs.union(longer)


def copied_runs(levels: list[DataFrame]) -> DataFrame:
    """The maximal repeated runs' later copies, a written table: place, ``size`` in lines, and ``first``, the place that they are copies of."""

    def maximal() -> DataFrame:
        runs = _longest_runs(levels)
        before = Window.partitionBy("id", "key").orderBy("pos").rangeBetween(-1, -1)
        continues = F.coalesce((F.first("first").over(before)["pos"] + 1 == F.col("first.pos")) & (F.first("size").over(before) == F.col("size") + 1), F.lit(False))
        return runs.withColumn("continues", continues & (F.first("first").over(before)["key"] == F.col("first.key"))).where("not continues").select(*_PLACE, "size", "first")

    return settled(maximal, "copies")


def repeated_runs(table: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, list[DataFrame]]:
    """(id, key, pos, size): the maximal repeated runs' later copies that are long enough to go (see ``Settings``); and the written tables that this reads."""
    levels = suffix_ranks(table)
    if not levels:
        return table.select(*_PLACE, F.lit(1).alias("size")).limit(0), []
    copies = copied_runs(levels)
    runs = copies.where(F.col("size") >= s.min_lines).select(*_PLACE, "size")
    if s.min_lines > 1:
        single = levels[0].where(F.col("later") & (F.col("words") >= s.min_words))
        runs = runs.union(single.select(*_PLACE, F.lit(1).alias("size")))
    return runs, [*levels, copies]


def remove_repeated_lines(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text cut to its kept lines, and ``n_lines``, ``n_removed``, ``longest_run``.

    Lines are split at line feeds; those without a word are kept and not counted. A line goes when it lies in a run
    that also stands earlier, in a document with a smaller id or before in the same one (see ``Settings``); the first
    place keeps it. Runs are judged on the input. ``longest_run`` is the most lines removed in a row.

    A null or empty text has no line and stays. A row with a null id keeps all lines and is nobody's first place.
    Repeated rows (one id, one text) aren't copies of each other. Columns may have any name but the three added
    here, which replace columns of those names. An empty table gives an empty table. Long texts are split whole: a
    task holds some 30 bytes for each byte of the longest one.
    """
    added = ["n_lines", "n_removed", "longest_run"]
    others = [c for c in docs.columns if c not in (id_col, text_col, *added)]
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("key"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest") if others else F.lit(None).cast("int").alias("rest"))
    # Texts are cut into lines once; the ranks read the written table, which goes with them when the runs are known.
    table = saved(line_table(rows.where(F.col("id").isNotNull())), "lines")
    found, read = repeated_runs(table, s)
    runs = saved(found.groupBy("id", "key").agg(F.collect_list(F.struct("pos", "size")).alias("runs")), "runs")
    for done in (table, *read):
        dropped(done)
    joined = rows.join(runs, ["id", "key"], "left")
    kind = rows.schema["id"].dataType.simpleString()
    keep_type = rows.schema["rest"].dataType.simpleString() if others else "int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(1), batch.column(2)
            for chunk in chunks(texts):
                row, _, _, start = lines(chunk, words(chunk))
                border = np.searchsorted(row, np.arange(len(chunk) + 1))
                counts = np.diff(border)
                removed, longest, out = np.zeros(len(chunk), np.int64), np.zeros(len(chunk), np.int64), []
                for i in range(len(chunk)):
                    own = found[chunk.first + i]
                    if not own.is_valid or not counts[i]:
                        out.append(texts[chunk.first + i].as_py())
                        continue
                    cover = np.zeros(counts[i] + 1, np.int64)
                    for run in own.as_py():
                        cover[run["pos"]] += 1
                        cover[min(run["pos"] + run["size"], counts[i])] -= 1
                    gone = np.cumsum(cover[:-1]) > 0
                    removed[i] = gone.sum()
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                    longest[i] = (edges[1::2] - edges[::2]).max(initial=0)
                    raw = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes()
                    drop = set((start[border[i] : border[i + 1]][gone] - chunk.offsets[i]).tolist())
                    at, kept = 0, []
                    for line in raw.split(b"\n"):
                        if at not in drop:
                            kept.append(line)
                        at += len(line) + 1
                    out.append(b"\n".join(kept).decode())
                here = slice(chunk.first, chunk.first + len(chunk))
                columns = [batch.column(0)[here], pa.array(out, pa.string()), batch.column(3)[here], *map(pa.array, (counts, removed, longest))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text", "rest", *added])

    schema = f"id {kind}, text string, rest {keep_type}, n_lines long, n_removed long, longest_run long"
    done = joined.select("id", "text", "runs", "rest").mapInArrow(cut, schema)
    names = {id_col: F.col("id"), text_col: F.col("text")} | {c: F.col(f"rest.`{c}`") for c in others}
    return done.select(*[names[c].alias(c) for c in docs.columns if c in names], *added)


def without_emptied(cleaned: DataFrame) -> DataFrame:
    """Drop the rows of ``remove_repeated_lines`` that had lines and lost them all: whole copies of what stands elsewhere."""
    return cleaned.where((F.col("n_lines") == 0) | (F.col("n_removed") < F.col("n_lines")))
