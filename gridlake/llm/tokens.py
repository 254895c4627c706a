"""Encoding of whole texts with a public tokenizer file, and the exact length histogram (operator 2)."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.text import Chunk, SpanHasher, chunks

# Workers live on after their stage and keep both halves, some 200 bytes a piece.
CACHED_PIECES = 250_000
# Arrays of an eight-byte number for each byte, several at a time.
ENCODED_BYTES = 1 << 20
_OTHER, _LETTER, _DIGIT, _SPACE, _BLANK = range(5)


def _byte_classes() -> np.ndarray:
    table = np.full(256, _OTHER, np.uint8)
    table[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = _LETTER
    table[ord("0") : ord("9") + 1] = _DIGIT
    table[9:14] = _BLANK
    table[32] = _SPACE
    table[0x80:] = _LETTER
    return table


_CLASS = _byte_classes()
_RARE_LEAD = np.zeros(256, bool)
_RARE_LEAD[[0xC2, *range(0xCA, 0x100)]] = True


def _printable_bytes() -> dict[int, str]:
    """The published byte-level alphabet: printable Latin-1 bytes stand for themselves, others for U+0100 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_ALPHABET = _printable_bytes()


class Encoder:
    """Token ids of the rows of a chunk, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    For a byte-level BPE file with the usual split pattern, rows of ASCII, Latin letters and common punctuation are
    split with whole-array steps, and each distinct piece goes through the tokenizer's own BPE model once (the
    results are kept for later chunks, at most CACHED_PIECES of them). All other rows, rows that hold an added
    token's string, and other kinds of tokenizer go through ``encode_batch``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        model = spec["model"]
        self.fast = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not spec.get("normalizer")
            and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        self.added = [t["content"].encode() for t in spec.get("added_tokens") or []]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.known: dict[int, bytes] = {}
        self.before: dict[int, bytes] = {}

    def __call__(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk one after another, and the border of each row in them."""
        if not self.fast:
            return self._join([self._plain(chunk, i) for i in range(len(chunk))])
        ids, border = self._split(chunk)
        slow = self._slow_rows(chunk)
        if not len(slow):
            return ids, border
        parts = [ids[border[i] : border[i + 1]] for i in range(len(chunk))]
        for i in slow:
            parts[i] = self._plain(chunk, i)
        return self._join(parts)

    def _join(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        border = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=border[1:])
        return np.concatenate([*parts, np.zeros(0, self.dtype)]), border

    def _plain(self, chunk: Chunk, i: int) -> np.ndarray:
        text = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes().decode()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _slow_rows(self, chunk: Chunk) -> np.ndarray:
        data = chunk.data
        rare = np.flatnonzero(_RARE_LEAD[data])
        lead = data[rare]
        follow = lambda d: data[np.minimum(rare + d, len(data) - 1)]
        dash_or_quote = (lead == 0xE2) & (follow(1) == 0x80) & (follow(2) >= 0x90) & (follow(2) <= 0xA7)
        sign = np.flatnonzero(data[:-1] == 0xC3)
        sign = sign[(data[sign + 1] == 0x97) | (data[sign + 1] == 0xB7)]
        at = [rare[~dash_or_quote], sign]
        whole = None
        for content in self.added:
            if whole is None:
                whole = data.tobytes()
            found = whole.find(content)
            while found >= 0:
                at.append(np.array([found]))
                found = whole.find(content, found + 1)
        return np.unique(np.searchsorted(chunk.offsets[1:], np.concatenate(at), "right"))

    def _split(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        data, n = chunk.data, len(chunk.data)
        if not n:
            return np.zeros(0, self.dtype), np.zeros(len(chunk) + 1, np.int64)
        kind = _CLASS[data]
        for p in np.flatnonzero(data == 0xE2):
            kind[p : p + 3] = _OTHER
        first = np.zeros(n + 1, bool)
        first[chunk.offsets[:-1]] = True
        first[n] = True
        blank = kind >= _SPACE
        begins = first[:n].copy()
        begins[1:] |= (kind[1:] != kind[:-1]) & ~(blank[1:] & blank[:-1])
        # The last blank before other text: a space joins what follows, others stand alone.
        last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~first[1:n])
        begins[last] = True
        begins[last + 1] = data[last] != 0x20
        quote = np.flatnonzero((data == 0x27) & begins)
        if len(quote):
            room = chunk.offsets[np.searchsorted(chunk.offsets, quote, "right")] - quote
            one, two = data[np.minimum(quote + 1, n - 1)], data[np.minimum(quote + 2, n - 1)]
            short = (room > 1) & np.isin(one, np.frombuffer(b"stmd", np.uint8))
            e = (two == ord("e")) & ((one == ord("r")) | (one == ord("v")))
            long = (room > 2) & (e | ((one == ord("l")) & (two == ord("l"))))
            for at, size in ((quote[short], 2), (quote[long], 3)):
                begins[at + 1] = False
                begins[(at + size)[at + size < n]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], n)
        code, sample, which = np.unique(SpanHasher(data)(start, end), return_index=True, return_inverse=True)
        pieces = self._pieces(data, code.tolist(), start[sample], end[sample])
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(pieces), self.dtype)
        count = size[which]
        upto = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=upto[1:])
        source = np.repeat((np.cumsum(size) - size)[which] - upto[:-1], count) + np.arange(upto[-1])
        return flat[source], upto[np.searchsorted(start, chunk.offsets)]

    def _pieces(self, data: np.ndarray, code: list[int], start: np.ndarray, end: np.ndarray) -> list[bytes]:
        """The ids of each distinct piece, as bytes; pieces not seen lately go through the BPE model."""
        known, before = self.known, self.before
        found = [known.get(c) or before.get(c) for c in code]
        new = [i for i, piece in enumerate(found) if piece is None]
        size = (end - start)[new]
        shift = np.cumsum(size) - size
        taken = data[np.repeat(start[new] - shift, size) + np.arange(size.sum())].tobytes()
        letters = taken.decode("latin-1").translate(_ALPHABET)
        tokenize, kind = self.tokenizer.model.tokenize, "H" if self.dtype.itemsize == 2 else "I"
        for i, first, length in zip(new, shift.tolist(), size.tolist(), strict=True):
            found[i] = array(kind, [t.id for t in tokenize(letters[first : first + length])]).tobytes()
        known.update(zip(code, found, strict=True))
        if len(known) > CACHED_PIECES // 2:  # frequent pieces come back from the former half
            self.known, self.before = {}, known
        return found


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker."""
    return Encoder(path)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and ``n_tokens``, the number of tokens of its whole text.

    Null and empty texts have 0 tokens; a null id stays null; repeated rows are counted each; other columns are
    left out, so their names don't matter; an empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for batch in batches:
            sizes = [np.diff(encode(chunk)[1]) for chunk in chunks(batch.column(1), ENCODED_BYTES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]))], ["id", "n_tokens"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)


def length_histogram(counted: DataFrame, buckets: int = 64) -> DataFrame:
    """The exact histogram of ``n_tokens`` with prefix and suffix sums; one row for each length that occurs.

    For a length L: ``n_docs`` of that length; ``docs_up_to`` and ``tokens_up_to`` for lengths up to L;
    ``docs_from`` for lengths of L or more; ``truncated_tokens``, the tokens left when each document is cut to L;
    ``quantile``, the share of documents up to L. Every answer for a context limit comes from one of these rows
    (see ``totals_at_limits``). The sums run in two passes, inside ranges of lengths and over the ranges' totals,
    so no task sorts more than one range.
    """
    by_length = counted.where(F.col("n_tokens").isNotNull()).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    # A length's range: its bit length and the next bits, so ranges widen with the lengths.
    scale = F.greatest(F.floor(F.log2(F.col("n_tokens") + 1)) - 6, F.lit(0)).cast("int")
    ranged = by_length.withColumn("_range", scale * 256 + F.expr("shiftright(n_tokens, 0)") / F.pow(F.lit(2.0), scale))
    ranged = ranged.withColumn("_range", F.floor(F.col("_range") / 4))
    totals = ranged.groupBy("_range").agg(F.sum("n_docs").alias("_d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("_t"))
    over = Window.orderBy("_range")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = totals.select(
        "_range",
        F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_docs0"),
        F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_tokens0"),
        F.sum("_d").over(everything).alias("_docs"),
    )
    inside = Window.partitionBy("_range").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.join(bases, "_range").select(
        "n_tokens",
        "n_docs",
        (F.col("_docs0") + F.sum("n_docs").over(inside)).alias("docs_up_to"),
        (F.col("_tokens0") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside)).alias("tokens_up_to"),
        "_docs",
    )
    longer = F.col("_docs") - F.col("docs_up_to")
    return summed.select(
        "n_tokens",
        "n_docs",
        "docs_up_to",
        "tokens_up_to",
        (longer + F.col("n_docs")).alias("docs_from"),
        (F.col("tokens_up_to") + longer * F.col("n_tokens")).alias("truncated_tokens"),
        (F.col("docs_up_to") / F.col("_docs")).alias("quantile"),
    )


def totals_at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents that fit, tokens of those, and tokens left when all are cut to the limit."""
    picks = []
    for limit in limits:
        fits = F.when(F.col("n_tokens") <= limit, F.col("n_docs"))
        picks += [
            F.coalesce(F.sum(fits), F.lit(0)).alias(f"fit_{limit}"),
            F.coalesce(F.sum(fits * F.col("n_tokens")), F.lit(0)).alias(f"tokens_{limit}"),
            F.coalesce(F.sum(F.col("n_docs") * F.least(F.col("n_tokens"), F.lit(limit))), F.lit(0)).alias(f"cut_{limit}"),
        ]
    wide = histogram.agg(*picks)
    cells = ", ".join(f"{limit}L, fit_{limit}, tokens_{limit}, cut_{limit}" for limit in limits)
    return wide.selectExpr(f"stack({len(limits)}, {cells}) as (context_limit, docs_that_fit, tokens_that_fit, truncated_tokens)")


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """For each share the smallest length such that at least that share of the documents is no longer."""
    picks = [F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(shares)]
    cells = ", ".join(f"double({q}), q{i}" for i, q in enumerate(shares))
    return histogram.agg(*picks).selectExpr(f"stack({len(shares)}, {cells}) as (share, n_tokens)")
