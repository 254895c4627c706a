"""Substring deduplication (operator 3): recurring passages located by sharded phrase automata.

1. Confirm. Every window of ``window`` words has an anchor, the smallest hash among its phrases of ``phrase`` words; windows
   in a row with one anchor form a passage. An aggregation by anchor tells which recur in another document. Passages that
   recur whole have an owner, the smallest id. Where passages of one anchor differ, their windows are compared one by
   one, once for each distinct passage, and each recurring window is a passage of its own, with its own owner.
2. Compile. A confirmed passage is stored with one phrase: its words, their place, the passage's length, hash and owner. Phrases
   are sharded by the documents that need them: a shard holds those of one chunk of documents, so its size is bounded
   and the work grows with the corpus, not with its square.
3. Stream. All documents of a chunk stream through its shard, an Aho-Corasick automaton over words. Nothing else knows where
   a passage stands: around each occurrence of a phrase the stored passages are verified, and their words removed
   where the owner is a smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.scratch import dropped, saved
from gridlake.llm.text import Chunk, Words, chunks, mix, phrase_codes, words

_U = np.uint64
_STEP = _U(0xC6A4A7935BD1E995 | 1)
_BACK = _U(pow(int(_STEP), -1, 1 << 64))
_MOST_WINDOWS = 64  # of a passage; longer ones are cut, counted from their own start
_BLOCK = 1 << 19  # occurrences times passages that are verified at once


@dataclass(frozen=True)
class Settings:
    window: int = 50
    phrase: int = 8


class WordSpans:
    """64-bit hashes of runs of words of one chunk, from prefix sums of a polynomial over the words' hashes."""

    def __init__(self, code: np.ndarray):
        up, self.down = np.full(len(code) + 1, _STEP, np.uint64), np.full(len(code) + 1, _BACK, np.uint64)
        up[0] = self.down[0] = 1
        self.down = np.multiply.accumulate(self.down)
        self.sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(mix(code) * np.multiply.accumulate(up)[:-1], out=self.sums[1:])

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((self.sums[last] - self.sums[first]) * self.down[first] + (last - first).astype(np.uint64))


@dataclass
class Passages:
    """The passages of a chunk in order: first window, number of windows, anchor, hash; and the hash of the phrase at each word."""

    first: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    code: np.ndarray
    phrase: np.ndarray
    spans: WordSpans


def passages(found: Words, s: Settings) -> Passages:
    """Runs of at most ``_MOST_WINDOWS`` neighbouring windows of one row with one anchor."""
    none, spans = np.zeros(0, np.int64), WordSpans(found.code)
    n = len(found.code) - s.window + 1
    if n <= 0:
        return Passages(none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint64), spans)
    phrase = phrase_codes(found.code, s.phrase)
    low, size, width = phrase, 1, s.window - s.phrase + 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    low = np.minimum(low[: len(low) - rest], low[rest:])
    inside = found.row[:n] == found.row[s.window - 1 :]
    begins, ends = inside.copy(), inside.copy()
    changes = low[1:] != low[:-1]
    begins[1:] &= ~inside[:-1] | changes
    ends[:-1] &= ~inside[1:] | changes
    first, windows = np.flatnonzero(begins), np.flatnonzero(ends) + 1 - np.flatnonzero(begins)
    parts = -(-windows // _MOST_WINDOWS)
    part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first, windows = np.repeat(first, parts) + part * _MOST_WINDOWS, np.minimum(np.repeat(windows, parts) - part * _MOST_WINDOWS, _MOST_WINDOWS)
    return Passages(first, windows, low[first], spans(first, first + windows + s.window - 1), phrase, spans)


def passage_table(docs: DataFrame, s: Settings) -> DataFrame:
    """(anchor, passage, id) of the distinct passages of each row of ``id, text``."""
    kind = docs.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = words(chunk)
                p = passages(found, s)
                row = found.row[p.first] if len(p.first) else p.first
                _, once = np.unique(mix(p.code ^ mix(p.anchor ^ mix(row.astype(np.uint64)))), return_index=True)
                once.sort()
                ids = batch.column(0).take(pa.array(chunk.first + row[once]))
                yield pa.RecordBatch.from_arrays([_signed(p.anchor[once]), _signed(p.code[once]), ids], ["anchor", "passage", "id"])

    return docs.select("id", "text").mapInArrow(find, f"anchor long, passage long, id {kind}")


def _signed(code: np.ndarray) -> pa.Array:
    return pa.array(code.view(np.int64))


def _flat(lists: pa.Array, chunk: Chunk) -> tuple[pa.Array, np.ndarray]:
    """The values of a chunk's lists one after another, and the row (within the chunk) of each; null lists have none."""
    here = lists[chunk.first : chunk.first + len(chunk)]
    size = pc.fill_null(pc.list_value_length(here), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(here), np.repeat(np.arange(len(chunk)), size)


def _leftmost(p: Passages, start: np.ndarray, anchor: np.ndarray, s: Settings) -> np.ndarray:
    """For windows that start at ``start``: the first place of their anchor's phrase."""
    place = start.copy()
    left = np.arange(len(start))
    for _ in range(s.window - s.phrase):
        left = left[p.phrase[place[left]] != anchor[left]]
        place[left] += 1
    return place


def passage_contents(docs: DataFrame, s: Settings) -> DataFrame:
    """What is stored of the passages that ``wanted`` (array of anchor, passage, open) names in each row of ``id, text, wanted``.

    (anchor, passage, id, phrase, left, size, windows): the phrase's words as 32-bit hashes, the words before it, the
    passage's length in words, and for an open passage its distinct windows (hash, and words before the phrase).
    """
    kind = docs.schema["id"].dataType.simpleString()
    shape = pa.list_(pa.struct([("code", pa.int64()), ("left", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = words(chunk)
                p = passages(found, s)
                wanted, wanted_row = _flat(batch.column(2), chunk)
                if not len(p.first) or not len(wanted):
                    continue
                anchor, code = (wanted.field(k).to_numpy().view(np.uint64) for k in (0, 1))
                asked = mix(code ^ mix(anchor ^ mix(wanted_row.astype(np.uint64))))
                own = mix(p.code ^ mix(p.anchor ^ mix(found.row[p.first].astype(np.uint64))))
                own, at = np.unique(own, return_index=True)
                place = np.minimum(np.searchsorted(own, asked), len(own) - 1)
                hit = np.flatnonzero(own[place] == asked)
                at, is_open = at[place[hit]], wanted.field(2).to_numpy(zero_copy_only=False)[hit]
                first = p.first[at]
                start = _leftmost(p, first, p.anchor[at], s)
                short = (found.code >> _U(32)).astype("<u4")
                phrases = [short[a : a + s.phrase].tobytes() for a in start.tolist()]
                # Windows of the open passages, each hash once for each passage.
                count = np.where(is_open, p.windows[at], 0)
                which = np.repeat(np.arange(len(at)), count)
                begin = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                window = p.spans(begin, begin + s.window)
                _, once = np.unique(mix(window ^ mix(which.astype(np.uint64))), return_index=True)
                once = once[np.argsort(which[once], kind="stable")]
                begin, which, window = begin[once], which[once], window[once]
                left = _leftmost(p, begin, p.anchor[at][which], s) - begin
                border = np.searchsorted(which, np.arange(len(at) + 1)).astype(np.int32)
                inner = pa.StructArray.from_arrays([_signed(window), pa.array(left.astype(np.int32))], ["code", "left"])
                ids = batch.column(0).take(pa.array(chunk.first + wanted_row[hit]))
                columns = [_signed(p.anchor[at]), _signed(p.code[at]), ids, pa.array(phrases, pa.binary()), pa.array((start - first).astype(np.int32))]
                columns += [pa.array((p.windows[at] + s.window - 1).astype(np.int32)), pa.ListArray.from_arrays(pa.array(border), inner).cast(shape)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "passage", "id", "phrase", "left", "size", "windows"])

    schema = f"anchor long, passage long, id {kind}, phrase binary, left int, size int, windows array<struct<code:long,left:int>>"
    return docs.select("id", "text", "wanted").mapInArrow(find, schema)


def confirmed_passages(docs: DataFrame, s: Settings) -> DataFrame:
    """``id`` and ``stored``: for each document with copied words the passages to look for, each with its owner.

    Joins on an anchor or passage read written tables on both sides, so that adaptive execution can split a key that
    many documents share; nothing is gathered by such a key, only minima and maxima are.
    """
    rows = saved(passage_table(docs, s), "passages")
    by_anchor = rows.groupBy("anchor").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("id", "passage") for f in (F.min, F.max)))
    recurring = by_anchor.where("min_id < max_id").select("anchor", F.expr("min_passage < max_passage").alias("open"))
    live = saved(rows.join(saved(recurring, "anchors"), "anchor"), "live")
    dropped(rows)
    owners = live.groupBy("anchor", "passage", "open").agg(F.min("id").alias("owner"), F.max("id").alias("last")).where("open or owner < last")
    owners = saved(owners, "owners")
    wanted = owners.groupBy(F.col("owner").alias("id")).agg(F.collect_list(F.struct("anchor", "passage", "open")).alias("wanted"))
    contents = saved(passage_contents(docs.join(wanted, "id"), s).dropDuplicates(["anchor", "passage"]), "contents")

    whole = contents.join(owners.where("owner < last").select("anchor", "passage"), ["anchor", "passage"])
    whole = saved(whole.select("anchor", "passage", F.struct("phrase", "left", "size", F.col("passage").alias("code"), F.col("id").alias("owner")).alias("one")), "whole")
    copies = live.join(whole, ["anchor", "passage"]).where(F.col("one.owner") < F.col("id")).select("id", "one")

    windows = contents.select("anchor", "id", "phrase", F.explode("windows").alias("w")).select("anchor", F.col("w.code").alias("code"), "id", "phrase", F.col("w.left").alias("left"))
    first = windows.groupBy("anchor", "code").agg(F.min("id").alias("owner"), F.max("id").alias("last")).where("owner < last").select("anchor", "code", "owner")
    parts = windows.join(saved(first, "windows"), ["anchor", "code"]).where("owner < id")
    parts = parts.select("id", F.struct("phrase", "left", F.lit(s.window).alias("size"), "code", "owner").alias("one"))
    return copies.union(parts).groupBy("id").agg(F.collect_list("one").alias("stored"))


class Shard:
    """The Aho-Corasick automaton of a chunk's phrases, and the passages stored with each."""

    def __init__(self, stored: pa.Array, s: Settings):
        phrases = stored.field(0).dictionary_encode()
        number = phrases.indices.to_numpy().astype(np.uint64)
        shape = number << _U(32) | (stored.field(1).to_numpy().astype(np.uint64) << _U(16)) | stored.field(2).to_numpy().astype(np.uint64)
        self.key, self.at = np.unique(mix(stored.field(3).to_numpy().view(np.uint64) ^ mix(shape)), return_index=True)
        self.owner, self.shape = stored.field(4), np.unique(shape)
        self.cut = np.searchsorted(self.shape, np.arange(len(phrases.dictionary) + 1, dtype=np.uint64) << _U(32))
        self.length = s.phrase
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, raw in enumerate(phrases.dictionary.to_pylist()):
            self.automaton.add_word(tuple(np.frombuffer(raw, "<u4").tolist()), k)
        if len(self.automaton):
            self.automaton.make_automaton()

    def occurrences(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of each phrase in a sequence of words."""
        hits = list(self.automaton.iter(tuple((code >> _U(32)).tolist()))) if len(self.automaton) else []
        found = np.array(hits, np.int64).reshape(-1, 2)
        return found[:, 0] - self.length + 1, found[:, 1]

    def verified(self, found: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (first word, word after the last, number in ``owner``) of the stored passages that stand in the chunk."""
        place, number = self.occurrences(found.code)
        spans, n = WordSpans(found.code), len(found.code)
        many = self.cut[number + 1] - self.cut[number]
        upto = np.cumsum(many)
        done = 0
        while done < len(place):
            last = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + _BLOCK, "right")))
            here = many[done:last]
            hit = np.repeat(np.arange(done, last), here)
            shape = self.shape[self.cut[number[hit]] + np.arange(len(hit)) - np.repeat(np.cumsum(here) - here, here)]
            begin = place[hit] - ((shape >> _U(16)) & _U(0xFFFF)).astype(np.int64)
            end = begin + (shape & _U(0xFFFF)).astype(np.int64)
            inside = np.flatnonzero((begin >= 0) & (end <= n))
            inside = inside[found.row[begin[inside]] == found.row[end[inside] - 1]]
            begin, end = begin[inside], end[inside]
            key = mix(spans(begin, end) ^ mix(shape[inside]))
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            same = self.key[at] == key
            yield begin[same], end[same], self.at[at[same]]
            done = last


def _kept_texts(chunk: Chunk, found: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by single spaces."""
    edge = np.zeros(len(chunk.data) + 1, np.int8)
    np.add.at(edge, found.start[keep], 1)
    np.add.at(edge, found.end[keep], -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    row, end = found.row[keep], found.end[keep]
    gap = end[:-1][row[1:] == row[:-1]]  # another kept word follows in the row, so a separator stands here
    data = chunk.data.copy()
    data[gap] = 32
    inside[gap] = True
    size = np.append(0, np.cumsum(inside))
    return pa.StringArray.from_buffers(len(chunk), pa.py_buffer(size[chunk.offsets].astype(np.int32).tobytes()), pa.py_buffer(data[inside].tobytes()))


def remove_repeated(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, ``n_words``, ``n_removed`` and ``kept_text``, its kept words joined by single spaces.

    A word goes when a window of ``window`` consecutive words covers it whose words also start in a row with a
    smaller id; windows are judged on the input. Null, empty and blank texts have no word. A row with a null id is
    neither owner nor copy: it keeps all words. Repeated rows (one id) don't make each other copies; rows of one id
    with different texts are each judged against smaller ids. Other columns are left out; an empty table gives an
    empty table. Long texts are read whole: a task holds some 100 bytes for each word of the longest one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    stored = saved(confirmed_passages(rows.where(F.col("id").isNotNull()), s), "stored")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = words(chunk)
                own = batch.column(0)[chunk.first : chunk.first + len(chunk)]
                known, _ = _flat(batch.column(2), chunk)
                cover = np.zeros(len(found.code) + 1, np.int64)
                if len(known):
                    shard = Shard(known, s)
                    for begin, end, record in shard.verified(found):
                        copied = pc.less(shard.owner.take(pa.array(record)), own.take(pa.array(found.row[begin])))
                        copied = pc.fill_null(copied, False).to_numpy(zero_copy_only=False)
                        np.add.at(cover, begin[copied], 1)
                        np.add.at(cover, end[copied], -1)
                keep = np.cumsum(cover[:-1]) == 0
                removed = np.bincount(found.row[~keep], minlength=len(chunk))
                yield pa.RecordBatch.from_arrays([own, pa.array(np.diff(found.before)), pa.array(removed), _kept_texts(chunk, found, keep)], ["id", "n_words", "n_removed", "kept_text"])

    joined = rows.join(stored, "id", "left").select("id", "text", "stored")
    return joined.mapInArrow(cut, f"id {kind}, n_words long, n_removed long, kept_text string").withColumnRenamed("id", id_col)
