"""Exact deduplication (operator 12): owners of equal texts, kept in the terminal nodes of Patricia tries.

Texts are compared without their whitespace. Each task first folds its own rows in a bounded trie (a combiner), so a text
with very many copies leaves a task a few times at most. What is left is dealt by length and content hash; the task
of a partition inserts whole byte strings into a compressed radix trie whose terminal nodes keep the owner (most code
points, then smallest id) and the number of rows.

A trie holds a bounded number of bytes. When one is full its largest subtree is spilled: its texts, with the owners found
so far, leave the task as rows, the subtree is cut off, and whatever comes for it later leaves the task too. Spilled rows
are dealt anew, over as many partitions as their bytes ask for, until none is left. Nothing is written outside Spark's own
shuffles and the shared folder.

Rows then look up their owner by length and SHA-256, in a table that has only texts held by more than one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.scratch import dropped, saved

_BLANK = bytes([0x20, *range(0x09, 0x0E)])


@dataclass(frozen=True)
class Settings:
    """Most bytes of text in a task's trie: before the shuffle (``combine_bytes``) and after it (``trie_bytes``)."""

    combine_bytes: int = 8 << 20
    trie_bytes: int = 48 << 20


class Node:
    """``edge``: bytes from the parent; ``owner``: [chars, id, count] where a text ends here; ``spilled``: cut off here."""

    __slots__ = ("edge", "children", "owner", "spilled")

    def __init__(self, edge: bytes, owner: list | None = None):
        self.edge, self.children, self.owner, self.spilled = edge, {}, owner, False


#: Bytes that a node takes besides its edge, about.
_NODE = 400


def better(chars: int, key, than_chars: int, than_key) -> bool:
    """Whether a row with so many code points and this id stays rather than the other; a null id comes last."""
    if chars != than_chars:
        return chars > than_chars
    return than_key is None or (key is not None and key < than_key)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning, by halving on whole slices."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A Patricia trie of byte strings. ``size`` estimates its bytes, ``ends`` counts its texts; ``insert`` is false for a text below a spilled subtree."""

    def __init__(self):
        self.root, self.size, self.ends = Node(b""), 0, 0

    def insert(self, text: bytes, chars: int, key, count: int) -> bool:
        node, at = self.root, 0
        while True:
            if node.spilled:
                return False
            if at == len(text):
                self._own(node, chars, key, count)
                return True
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = Node(text[at:], [chars, key, count])
                self.size += _NODE + len(text) - at
                self.ends += 1
                return True
            if text.startswith(child.edge, at):
                node, at = child, at + len(child.edge)
                continue
            same = _common(child.edge, text[at : at + len(child.edge)])
            middle = Node(child.edge[:same])
            child.edge = child.edge[same:]
            middle.children[child.edge[0]] = child
            node.children[text[at]] = middle
            self.size += _NODE
            node, at = middle, at + same

    def _own(self, node: Node, chars: int, key, count: int) -> None:
        if node.owner is None:
            node.owner = [chars, key, count]
            self.ends += 1
            return
        node.owner[2] += count
        if better(chars, key, node.owner[0], node.owner[1]):
            node.owner[:2] = chars, key

    def entries(self, start: Node | None = None, before: bytes = b"") -> Iterator[tuple[bytes, list]]:
        """Texts below a node with their owners; ``before``: the bytes from the root to the node's parent."""
        stack = [(start or self.root, before)]
        while stack:
            node, text = stack.pop()
            text += node.edge
            if node.owner is not None:
                yield text, node.owner
            stack += [(child, text) for child in node.children.values()]

    def _weights(self) -> dict[int, tuple[int, int]]:
        """Texts and bytes below each node, by its identity."""
        order, stack, weight = [], [self.root], {}
        while stack:
            node = stack.pop()
            order.append(node)
            stack += node.children.values()
        for node in reversed(order):
            below = [weight[id(c)] for c in node.children.values()]
            weight[id(node)] = (node.owner is not None) + sum(e for e, _ in below), _NODE + len(node.edge) + sum(w for _, w in below)
        return weight

    def spill(self) -> Iterator[tuple[bytes, list]]:
        """Cut off the largest subtree with at most half of the bytes and not all texts (or a single text), and give its texts and owners.

        For a trie of two texts at least; one stays. What is cut off leaves a mark of one byte.
        """
        weight, node, before = self._weights(), self.root, b""
        while node.children:
            child = max(node.children.values(), key=lambda c: (weight[id(c)][0] > 0, weight[id(c)][1]))
            before, node = before + node.edge, child
            ends, size = weight[id(node)]
            if size <= self.size // 2 and ends < self.ends:
                break
        yield from self.entries(node, before)
        self.ends -= ends
        self.size -= size - _NODE - 1
        node.edge, node.children, node.owner, node.spilled = node.edge[:1], {}, None, True


def normalised(raw: bytes) -> bytes:
    return raw.translate(None, _BLANK)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), text.cast("binary").alias("raw"), F.char_length(text).cast("long").alias("chars"))


_ENTRY = "length long, sha binary, chars long, owner {kind}, n long, spilled boolean, text binary"


def _batch(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.int64(), kind, pa.int64(), pa.bool_(), pa.binary())
    columns = list(zip(*found, strict=True)) if found else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["length", "sha", "chars", "owner", "n", "spilled", "text"])


def _packed(entries: Iterator[tuple[bytes, list, bool, bool]], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Entries (text, owner, spilled, whether the text goes along) as batches of a few megabytes."""
    found, size = [], 0
    for text, (chars, key, count), spilled, along in entries:
        found.append((len(text), sha256(text).digest(), chars, key, count, spilled, text if along else None))
        size += len(text) if along else 64
        if size > 2 << 20:
            yield _batch(found, kind)
            found, size = [], 0
    if found:
        yield _batch(found, kind)


def folded(docs: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """The distinct texts of each task, a few times a text at most, with the owner and the number of rows so far."""
    rows = _rows(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            trie = Trie()
            for batch in batches:
                for key, raw, chars in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                    trie.insert(normalised(raw.as_py()), chars, key, 1)
                    if trie.size > s.combine_bytes:
                        yield from ((text, own, False, True) for text, own in trie.entries())
                        trie = Trie()
            yield from ((text, own, False, True) for text, own in trie.entries())

        first = next(batches, None)
        if first is None:
            return
        own = first.column(0).type
        batches = _chain(first, batches)
        yield from _packed(entries(), own)

    return rows.mapInArrow(fold, _ENTRY.format(kind=kind))


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def owned(dealt: DataFrame, s: Settings) -> DataFrame:
    """One entry for each text of a partition that the trie could keep (without the text), and the spilled ones with it."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries(batches):
            trie = Trie()
            for batch in batches:
                for text, chars, key, count in zip(batch.column(6), *(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                    text = text.as_py()
                    if not trie.insert(text, chars, key, count):
                        yield text, [chars, key, count], True, True
                    while trie.size > s.trie_bytes and trie.ends > 1:
                        yield from ((t, o, True, True) for t, o in trie.spill())
            yield from ((t, o, False, False) for t, o in trie.entries())

        first = next(batches, None)
        if first is not None:
            yield from _packed(entries(_chain(first, batches)), first.column(3).type)

    return dealt.mapInArrow(own, _ENTRY.format(kind=dealt.schema["owner"].dataType.simpleString()))


def owners(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``length``, ``sha``, ``owner``, ``chars`` (the owner's code points) and ``n`` (rows) of every text that several rows hold."""
    dealt = folded(docs, s, id_col, text_col).repartition("length", "sha")
    parts: list[DataFrame] = []
    while True:
        # What stands alone is not stored: its row is its own owner.
        done = saved(owned(dealt, s).where("spilled or n > 1"), "owners")
        parts.append(done.where("not spilled").select("length", "sha", "owner", "chars", "n"))
        left = done.where("spilled").agg(F.sum(F.col("length") + _NODE)).first()[0]
        if not left:
            return reduce(DataFrame.union, parts)
        dealt = done.where("spilled").repartition(2 + 2 * left // s.trie_bytes, "length", "sha")


def exact_copies(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (lower-case hex, of the text without whitespace).

    Texts are equal when they are without the characters ``[\\x20\\x09-\\x0D]``. Of equal ones the row with the most
    code points in its original text stays, then the one with the smallest id. A null text is an empty one, and equals
    every blank one. A null id comes after all others: such a row owns a group (``keep_id`` null) only where no row with
    as many code points has an id. ``kept`` marks rows with the owner's id and number of code points, so repeated
    rows (one id, one text) are all marked; ``without_copies`` keeps one of them. Other columns are left out,
    whatever their names; an empty table gives an empty table. Long texts are taken whole: a task holds a few
    copies of the longest one.
    """
    rows = _rows(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normalised(raw.as_py()) for raw in batch.column(1)]
            columns = [batch.column(0), batch.column(2), pa.array(map(len, texts), pa.int64()), pa.array([sha256(t).digest() for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "chars", "length", "sha"])

    own = rows.mapInArrow(digest, f"id {kind}, chars long, length long, sha binary")
    groups = owners(docs, s, id_col, text_col).select("length", "sha", "owner", F.col("chars").alias("most"), "n")
    found = own.join(groups, ["length", "sha"], "left")
    alone = F.col("n").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("owner"))
    return found.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("id").eqNullSafe(F.col("owner")) & (F.col("chars") == F.col("most")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one row of each group of equal texts.

    Where several rows have the owner's id and text, the one with the smallest hash of all its columns stays. Rows that
    have no id and own no group are in it like others; a group of rows without any id keeps one.
    """
    kept = exact_copies(docs, s, id_col, text_col).where("kept").select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    plain = F.regexp_replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", "")
    chars = F.char_length(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.sha2(plain, 256).alias("_sha"), chars.alias("_chars"))
    same = named["_id"].eqNullSafe(kept["_id"]) & (named["_sha"] == kept["_sha"])
    chosen = named.join(kept, same, "left_semi").groupBy("_sha").agg(F.min_by("_row", F.struct(-F.col("_chars"), F.xxhash64("_row"))).alias("_row"))
    return chosen.select("_row.*")
