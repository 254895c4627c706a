"""Secret scans (operator 5) over a trigram inverted index.

For each rule a Boolean query over trigrams is derived from its regular expression: an AND of ORs of ANDs, all of
which a matching text must satisfy. Each block of documents gets an inverted index (trigram to posting list) of the
trigrams that any rule asks for; posting lists are united and intersected, and only the candidates left are scanned
with the expression. A rule without a mandatory trigram scans every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as c
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.text import Chunk, chunks


@dataclass(frozen=True)
class Rule:
    """``kind`` names the finding. Matches are leftmost and don't overlap; one whose ``group`` is shorter than ``least`` is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The base rules of the contract, in order. A run of one character class is long enough or is dropped, so the
# least length of "hex" stands in its expression.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Published formats of other credentials.
MORE = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("github", r"\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"\b(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    # From the start of its run of characters only: with a word boundary each "-eyJ" inside would scan the run's rest again.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"\b[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)
RULES = BASE + MORE

#: A query: the text must satisfy every member; a member is a set of alternatives, each a set of trigrams to hold.
Query = tuple[frozenset[frozenset[bytes]], ...]
_MOST_STRINGS = 32


@lru_cache(256)
def trigram_query(rule: Rule) -> Query:
    """The trigram query of a rule's expression; empty where no trigram is mandatory. Trigrams are lower-case (A-Z)."""
    clauses: list[frozenset[frozenset[bytes]]] = []
    _walk(list(parser.parse(rule.pattern)), clauses)
    return tuple(clauses)


def _walk(tree: list, clauses: list) -> None:
    """Join neighbouring parts with few possible strings, and turn each maximal such part into a clause."""
    strings: set[str] | None = {""}
    for op, value in [*tree, (None, None)]:
        part = _strings(op, value) if op is not None else None
        if part is not None and strings is not None and len(part) * len(strings) <= _MOST_STRINGS:
            strings = {a + b for a in strings for b in part}
            continue
        _clause(strings, clauses)
        strings = part if part is not None and len(part) <= _MOST_STRINGS else {""}
        if part is None and op is c.SUBPATTERN:
            _walk(list(value[-1]), clauses)
        elif part is None and op is c.MAX_REPEAT and value[0] >= 1:
            _walk(list(value[2]), clauses)


def _clause(strings: set[str] | None, clauses: list) -> None:
    alternatives = frozenset(frozenset(_trigrams(x)) for x in strings or {""})
    if frozenset() not in alternatives:
        clauses.append(alternatives)


def _trigrams(text: str) -> Iterator[bytes]:
    raw = text.encode().lower()
    return (raw[i : i + 3] for i in range(len(raw) - 2))


def _strings(op: object, value: object) -> set[str] | None:
    """All strings that a node of the parsed expression matches, or None where there are too many to list."""
    if op is c.LITERAL:
        return {chr(value)}
    if op is c.AT:
        return {""}
    if op is c.IN and all(k is c.LITERAL for k, _ in value) and len(value) <= 8:
        return {chr(v) for _, v in value}
    if op is c.SUBPATTERN:
        return _sequence(list(value[-1]))
    if op is c.BRANCH:
        parts = [_sequence(list(x)) for x in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is c.MAX_REPEAT and value[1] is not c.MAXREPEAT and value[1] <= 2:
        inner = _sequence(list(value[2]))
        if inner is None:
            return None
        out: set[str] = set()
        for n in range(value[0], value[1] + 1):
            found = {""}
            for _ in range(n):
                found = {a + b for a in found for b in inner}
            out |= found
        return out if len(out) <= _MOST_STRINGS else None
    return None


def _sequence(tree: list) -> set[str] | None:
    found = {""}
    for op, value in tree:
        part = _strings(op, value)
        if part is None or len(part) * len(found) > _MOST_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


class BlockIndex:
    """Posting lists (sorted row numbers) of the given trigrams over the rows of one chunk."""

    def __init__(self, chunk: Chunk, wanted: dict[bytes, int], slot: np.ndarray):
        low = np.frombuffer(chunk.data.tobytes().lower(), np.uint8)
        self.rows, self.wanted = len(chunk), wanted
        if len(low) < 3:
            self.lists = {}
            return
        code = low[:-2].astype(np.int32) << 16
        code |= low[1:-1].astype(np.int32) << 8
        code |= low[2:]
        found = slot[code]
        at = np.flatnonzero(found)
        row = np.searchsorted(chunk.offsets[1:], at, "right")
        inside = at + 3 <= chunk.offsets[row + 1]  # not across two rows
        pair = np.unique(found[at[inside]].astype(np.int64) * self.rows + row[inside])
        own, row = pair // self.rows, pair % self.rows
        cut = np.searchsorted(own, np.arange(len(wanted) + 2))
        self.lists = {t: row[cut[k] : cut[k + 1]] for t, k in wanted.items()}

    def candidates(self, query: Query) -> np.ndarray:
        """Rows that satisfy every clause; all rows for an empty query."""
        result = np.arange(self.rows)
        none = np.zeros(0, np.int64)
        for clause in query:
            either = [none]
            for together in clause:
                both = result
                for t in together:
                    both = np.intersect1d(both, self.lists.get(t, none), assume_unique=True)
                either.append(both)
            result = np.unique(np.concatenate(either))
        return result


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and ``findings``, an array of (kind, start, end) in code points, end exclusive, by start and then rule.

    Null and empty texts have no finding; a null id stays null; repeated rows are scanned each; a long text is
    scanned whole, in time that grows with its length (tests scan 1 MB of each rule's worst text); other columns are
    left out; an empty table gives an empty table. Findings of different kinds may overlap, those of one kind don't.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(r) for r in rules]
        every = sorted({t for q in queries for clause in q for together in clause for t in together})
        wanted = {t: k + 1 for k, t in enumerate(every)}
        slot = np.zeros(1 << 24, np.uint16)
        for t, k in wanted.items():
            slot[int.from_bytes(t, "big")] = k
        compiled = [r.compiled() for r in rules]
        for batch in batches:
            texts = batch.column(1)
            for chunk in chunks(texts):
                index = BlockIndex(chunk, wanted, slot)
                found: list[list] = [[] for _ in range(len(chunk))]
                decoded: dict[int, str] = {}
                for k, (rule, query, regex) in enumerate(zip(rules, queries, compiled, strict=True)):
                    for i in index.candidates(query).tolist():
                        if i not in decoded:
                            decoded[i] = texts[chunk.first + i].as_py() or ""
                        for m in regex.finditer(decoded[i]):
                            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                                found[i].append((m.start(), k, m.end()))
                out = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(x)] for x in found]
                own = batch.column(0)[chunk.first : chunk.first + len(chunk)]
                shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([own, pa.array(out, shape)], ["id", "findings"])

    schema = f"id {kind}, findings array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(find, schema).withColumnRenamed("id", id_col)


def joined(findings: F.Column) -> F.Column:
    """Findings as kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
