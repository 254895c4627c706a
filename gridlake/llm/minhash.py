"""MinHash near-deduplication (operator 1) with min-max hashing.

Under each of ``permutations`` hash functions a document keeps the smallest and the largest value of its shingles, so a
signature has two values for each evaluation. Bands of ``rows`` values are hashed to bucket keys. Exact copies are
one class from the start. Links are confirmed on full shingle sets, first between each member of a bucket and one hub.
While a bucket's members are in several components, another of those outside the first hub's component is the hub of a
further turn; a turn costs one confirmation a member, and templates with shared alternatives become one component
after few. What is still apart when turns find no more links is confirmed pair by pair across components, unless too
few of its shingles stand in any other candidate for a link to be possible, so no link between components is missed.

Texts are read again for confirmation. Those that no pair needs leave at the scan, by a broadcast filter of bounded size
(``_sieved``); the join behind it decides. One text of a class moves once, and its set once more for each confirmation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.components import components
from gridlake.llm.scratch import dropped, saved
from gridlake.llm.text import CHUNK_BYTES, chunks, mix, shingle_sets

_U = np.uint64
_BIT_WORDS = 8
_FILTER_WORDS = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``shingle`` words; links at ``numerator`` / 100 of the union or more.

    With 40 bands of 5 values a pair at similarity 0.85 shares no bucket with probability 7e-11, at 0.80 with
    1e-7. ``sketch`` bits (one for each signature value) drop a candidate pair before its sets are read when they
    differ more than a pair at the threshold does with probability 1e-9 (six standard deviations). ``turns`` is the
    most hubs that a bucket tries before its components are compared pair by pair; turns end where that costs a member
    ``crowd`` comparisons or fewer, or after one that leaves over half of them. Both change the work, not the result.
    """

    shingle: int = 5
    numerator: int = 80
    permutations: int = 100
    rows: int = 5
    turns: int = 6
    crowd: int = 16

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.rows

    @property
    def sketch_words(self) -> int:
        return -(-2 * self.permutations // 64)

    @property
    def most_different_bits(self) -> int:
        n, p = 2 * self.permutations, (1 - self.numerator / 100) / 2
        return int(n * p + 6 * (n * p * (1 - p)) ** 0.5)


def signatures(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text_key`` (a hash of the text), ``n_shingles``, ``high`` and ``low`` (128 bits of a hash of the set; null without words), ``bands``, ``sketch``."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    rng = np.random.default_rng(11)
    factor = rng.integers(0, 1 << 63, s.permutations, dtype=np.uint64) * _U(2) + _U(1)
    shift = rng.integers(0, 1 << 63, s.permutations, dtype=np.uint64)
    place = rng.integers(0, 1 << 63, (s.bands, s.rows), dtype=np.uint64) * _U(2) + _U(1)
    salt = mix(np.arange(1, s.bands + 1, dtype=np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), CHUNK_BYTES // 4):
                sets = [found for _, found in shingle_sets(chunk, s.shingle)]
                size = np.array([len(x) for x in sets], np.int64)
                full = np.flatnonzero(size)
                out = np.zeros((len(full), 2 * s.permutations), np.uint64)
                code = np.concatenate([*sets, np.zeros(0, np.uint64)])
                cut = (np.cumsum(size) - size)[full]
                if len(full):
                    for j in range(s.permutations):
                        value = (code ^ shift[j]) * factor[j]
                        out[:, 2 * j] = np.minimum.reduceat(value, cut)
                        out[:, 2 * j + 1] = np.maximum.reduceat(value, cut)
                out = mix(out)
                bands = mix((out.reshape(len(full), s.bands, s.rows) * place).sum(axis=2, dtype=np.uint64) ^ salt)
                bits = np.zeros((len(full), 64 * s.sketch_words), np.uint8)
                bits[:, : out.shape[1]] = out & _U(1)
                sketch = np.packbits(bits, axis=1).view(np.int64)
                at = np.cumsum(size > 0) - 1
                here = slice(chunk.first, chunk.first + len(chunk))
                hashes = [pa.array(half).take(pa.array(at, mask=size == 0)) for half in _set_codes(code, cut, size[full])]
                columns = [batch.column(0)[here], batch.column(2)[here], pa.array(size), *hashes, _lists(bands.view(np.int64), size > 0), _lists(sketch, size > 0)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text_key", "n_shingles", "high", "low", "bands", "sketch"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"id {kind}, text_key long, n_shingles long, high long, low long, bands array<long>, sketch array<long>")


def _lists(values: np.ndarray, full: np.ndarray) -> pa.Array:
    """A list for each row: the next row of ``values`` where ``full``, else empty."""
    border = np.zeros(len(full) + 1, np.int32)
    np.cumsum(full * values.shape[1], out=border[1:])
    return pa.ListArray.from_arrays(pa.array(border), pa.array(values.ravel()))


def _set_codes(code: np.ndarray, cut: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each non-empty set of shingle hashes; the sets lie one after another from ``cut`` on."""
    if not len(cut):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = size.astype(np.uint64)
    return tuple(mix(np.add.reduceat(mix(code ^ salt), cut) + n).view(np.int64) for salt in (_U(0), _U(0x5851F42D4C957F2D)))


def shingle_table(rows: DataFrame, s: Settings) -> DataFrame:
    """``class`` and the full set of shingle hashes of each row's ``text`` that has a word."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), CHUNK_BYTES // 4):
                found = [(i, x) for i, x in shingle_sets(chunk, s.shingle) if len(x)]
                code = np.concatenate([*(x for _, x in found), np.zeros(0, np.uint64)])
                border = np.cumsum([0, *(len(x) for _, x in found)]).astype(np.int32)
                owner = batch.column(0).take(pa.array([chunk.first + i for i, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([owner, pa.ListArray.from_arrays(pa.array(border), pa.array(code.view(np.int64)))], ["class", "shingles"])

    return rows.select("class", F.col("text").cast("string").alias("text")).mapInArrow(sets, "class long, shingles array<long>")


def _sieved(rows: DataFrame, wanted: DataFrame, *names: str) -> DataFrame:
    """``rows`` without most of those that have no equal in ``wanted`` under the columns ``names``; none that has one is lost.

    A Bloom filter of at most ``_FILTER_WORDS`` words of 64 bits is broadcast, each key in three bits of one word. It lets 3
    of 100 other rows pass at 2 million keys, and more beyond; then more rows reach the join that follows.
    """
    code = F.xxhash64(*names)
    word = F.pmod(code, F.lit(_FILTER_WORDS))
    bit = "shiftleft(1L, cast(shiftrightunsigned(_code, {}) & 63 as int))"
    mask = " | ".join(bit.format(shift) for shift in (40, 46, 52))
    kept = wanted.select(word.alias("_word"), code.alias("_code")).groupBy("_word").agg(F.bit_or(F.expr(mask)).alias("_bits"))
    marked = rows.select("*", code.alias("_code")).alias("r")
    fits = (F.pmod("_code", F.lit(_FILTER_WORDS)) == F.col("_word")) & F.expr(f"(_bits & ({mask})) = ({mask})")
    return marked.join(F.broadcast(kept), fits, "left_semi").drop("_code")


def near_duplicates(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, ``n_shingles``, ``class_id``, ``component_id``, ``kept``, ``first_class`` and ``text_key``.

    ``class_id`` is a hash shared by rows with equal shingle sets; ``component_id`` is the smallest id reachable over
    links between sets with 100 * intersection >= numerator * union; ``kept`` is true where it is the row's own id.
    ``first_class`` marks one class of each component, that of its smallest id; ``text_key`` is the text's xxhash64.

    A row with fewer words than a shingle has the whole sequence as its one shingle. A null, empty or blank text
    has no shingle and is linked with nothing: it is its own component and kept. A row with a null id is linked with
    nothing and kept too. Repeated rows all come back, with the same component; rows of one id with different texts
    are decided each by its own text. Other columns are left out. An empty table gives an empty table. Long texts are
    taken whole: a task holds some 100 bytes for each word of the longest one.
    """
    signed = signatures(docs, s, id_col, text_col)
    named = F.col("id").isNotNull()
    signed = saved(signed.withColumns({"high": F.when(named, F.col("high")), "low": F.when(named, F.col("low"))}), "signatures")
    classes = signed.where("high is not null").groupBy("high", "low")
    classes = classes.agg(F.min(F.struct("id", "text_key")).alias("one"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    classes = saved(classes.select("high", "low", "one.*", "n", "sketch", "bands", F.monotonically_increasing_id().alias("class")), "classes")
    info = classes.select("class", "n", "sketch")
    keyed = classes.select("class", "id", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min_by("class", "id").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = saved(keyed.join(hubs, "key").select("key", "hub", "class"), "members")

    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    linked, groups = _links(members, info, classes, texts, s)
    named = classes.select("class", "id", "high", "low").join(groups.select(F.col("node").alias("class"), "component"), "class", "left")
    named = named.select("id", "high", "low", F.coalesce("component", "class").alias("component"))
    least = named.groupBy("component").agg(F.min(F.struct("id", "high", "low")).alias("least"))
    first = (F.col("high") == F.col("least.high")) & (F.col("low") == F.col("least.low"))
    owner = named.join(least, "component").select("high", "low", F.col("least.id").alias("component_id"), first.alias("first_class"))
    found = signed.select("id", "text_key", "n_shingles", "high", "low").join(owner, ["high", "low"], "left")
    alone = F.col("high").isNull()
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.col("high").alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
        (alone | F.col("first_class")).alias("first_class"),
        "text_key",
    )


def _links(members: DataFrame, info: DataFrame, classes: DataFrame, texts: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Confirmed links (a, b) that connect all that is linked, and the components (node, component) they make."""
    pairs = members.where("class <> hub").select(F.least("hub", "class").alias("a"), F.greatest("hub", "class").alias("b")).distinct()
    tested, sets = _confirmed(saved(_plausible(pairs, info, s), "pairs"), classes, texts, s)
    linked = tested.where("linked").select("a", "b")
    groups = saved(components(linked.toDF("u", "v")), "components")
    state = _apart(members, groups)
    dropped(members)
    if state.isEmpty():
        return linked, groups
    state, bounds = _linkable(state, info, sets, s)
    near = _bounded(state, bounds)
    left, memberships = _pairs_apart(near)
    crowded = left > s.crowd * memberships
    for turn in range(s.turns if crowded else 0):
        pairs = saved(next_hub_pairs(near, turn, s).join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            break
        more, sets = _confirmed(pairs, classes, texts, s, sets)
        tested, new = tested.union(more), more.where("linked").select("a", "b")
        if new.isEmpty():
            break
        linked, (groups, moved) = linked.union(new), _joined(groups, new)
        before, state = state, _moved(state, moved)
        dropped(before)
        dropped(near)
        near = _bounded(state, bounds)
        before, (left, memberships) = left, _pairs_apart(near)
        if 2 * left > before or left <= s.crowd * memberships:
            break
    pairs = saved(_across(near, s).join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    if not pairs.isEmpty():
        more, _ = _confirmed(pairs, classes, texts, s, sets)
        new = more.where("linked").select("a", "b")
        if not new.isEmpty():
            linked, (groups, _) = linked.union(new), _joined(groups, new)
    return linked, groups


def _pairs_apart(near: DataFrame) -> tuple[int, int]:
    """Ordered pairs of a bucket's members in different components, over all buckets, and the memberships."""
    parts = near.groupBy("key", "component").agg(F.count("*").alias("c"))
    buckets = parts.groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("same"))
    left, memberships = buckets.agg(F.sum(F.col("n") * F.col("n") - F.col("same")), F.sum("n")).first()
    return left or 0, memberships or 0


def _joined(groups: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The components (node, component) with the links ``new`` (a, b) added, and where components went (component, target); only those that the links touch are worked on."""
    place = groups.select(F.col("node").alias("a"), F.col("component").alias("u"))
    other = groups.select(F.col("node").alias("b"), F.col("component").alias("v"))
    edges = new.join(place, "a", "left").join(other, "b", "left").select(F.coalesce("u", "a").alias("u"), F.coalesce("v", "b").alias("v"))
    moved = components(edges)
    first = groups.join(moved.toDF("component", "target"), "component", "left").select("node", F.coalesce("target", "component").alias("component"))
    after = saved(first.union(moved.join(groups.select("node"), "node", "left_anti")), "components")
    dropped(groups)
    return after, moved.toDF("component", "target")


def _moved(state: DataFrame, moved: DataFrame) -> DataFrame:
    """``state`` after components have been joined."""
    names = state.columns
    for column in ("component", "hub_component"):
        state = state.join(moved.toDF(column, "_target"), column, "left").withColumn(column, F.coalesce("_target", column)).drop("_target")
    return saved(state.select(*names), "state")


def _bounded(state: DataFrame, bounds: DataFrame) -> DataFrame:
    """The rows of ``state`` in buckets that still have members outside the first hub's component, with sizes, sketches and bounds."""
    open_keys = state.where("component <> hub_component").select("key").distinct()
    return saved(state.join(open_keys, "key", "left_semi").join(bounds, ["hub", "class"]), "near")


def _apart(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The members (key, hub, class and more) of the buckets that lie in several components, with ``component`` and ``hub_component``.

    The join reads written tables on both sides, so that adaptive execution can split a bucket that many share.
    """
    placed = members.drop("component", "hub_component").join(groups.select(F.col("node").alias("class"), "component"), "class", "left")
    placed = saved(placed.withColumn("component", F.coalesce("component", "class")), "placed")
    own = F.coalesce(F.max(F.when(F.col("class") == F.col("hub"), F.col("component"))), F.min("component")).alias("hub_component")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), own).where("low < high")
    mixed = saved(mixed.select("key", "hub_component"), "mixed")
    found = saved(placed.join(mixed, "key"), "apart")
    dropped(placed)
    dropped(mixed)
    return found


def _linkable(state: DataFrame, info: DataFrame, sets: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The rows of ``state`` that can still be linked, and for each hub and class of them size, sketch and what bounds their intersections.

    The bounds are kept apart, one row for the many buckets that a class shares with a hub.
    """
    members = state.select("hub", "class").distinct()
    bounds = members.join(info, "class").join(_profiles(state, sets), ["hub", "class"], "left")
    bounds = saved(bounds.where(F.col("common").isNull() | (100 * F.col("common") >= s.numerator * F.col("n"))), "bounds")
    able = saved(state.join(bounds.select("hub", "class"), ["hub", "class"], "left_semi"), "state")
    dropped(state)
    return able, bounds


def next_hub_pairs(near: DataFrame, turn: int, s: Settings) -> DataFrame:
    """Pairs (a, b) of each bucket's next hub with the members of other components, where a link is possible.

    The next hub is outside the first hub's component; that of the smallest hash, so buckets with one membership choose alike.
    """
    order = F.xxhash64("class", F.lit(turn))
    chosen = near.where("component <> hub_component").groupBy("key").agg(F.min(F.struct(order.alias("order"), "class")).alias("next"))
    chosen = chosen.select("key", F.col("next.class").alias("class"))
    x, y = near.join(chosen, ["key", "class"], "left_semi").alias("x"), near.alias("y")
    return _pairs(x, y, (F.col("x.component") != F.col("y.component")) & _possible(s))


def _profiles(members: DataFrame, sets: DataFrame) -> DataFrame:
    """What bounds the intersection of two members of a bucket, for members and hubs whose sets are known.

    ``common``: the member's shingles that another known set has too; ``outside``: those of them that the hub lacks;
    ``hub_n``: the hub's size; ``lost``: the hub's shingles that the member lacks, hashed into 512 bits; ``added``: the member's
    that the hub lacks, likewise; ``doubled``: by how many they are more than their bits.
    """
    shingle = sets.select("class", F.explode("shingles").alias("shingle"))
    alone = shingle.groupBy("shingle").agg(F.count("*").alias("holders"), F.min("class").alias("class")).where("holders = 1")
    alone = alone.groupBy("class").agg(F.count("*").alias("alone"))
    hubs = sets.select(F.col("class").alias("hub"), F.col("shingles").alias("hub_set"))
    both = members.select("hub", "class").distinct().join(sets, "class").join(hubs, "hub")
    both = both.select(
        "hub",
        "class",
        F.size("shingles").alias("own_n"),
        F.size("hub_set").alias("hub_n"),
        F.array_except("hub_set", "shingles").alias("gone"),
        F.array_except("shingles", "hub_set").alias("new"),
    )
    word = "aggregate({}, 0L, (b, s) -> if(pmod(s, {}) = w, b | shiftleft(1L, cast(pmod(shiftright(s, 3), 64) as int)), b))"
    bits = {name: F.expr(f"transform(sequence(0, {_BIT_WORDS - 1}), w -> {word.format(of, _BIT_WORDS)})") for name, of in (("lost", "gone"), ("added", "new"))}
    both = both.select("hub", "class", "own_n", "hub_n", F.size("gone").alias("n_lost"), F.size("new").alias("n_added"), *[x.alias(name) for name, x in bits.items()])
    known = both.join(alone, "class", "left").withColumn("common", F.col("own_n") - F.coalesce("alone", F.lit(0)))
    outside = F.greatest(F.col("common") - (F.col("hub_n") - F.col("n_lost")), F.lit(0))  # the hub itself has none
    doubled = F.col("n_added") - sum((F.bit_count(F.col("added")[i]) for i in range(_BIT_WORDS)), F.lit(0))
    return known.select("hub", "class", "common", outside.alias("outside"), "hub_n", "lost", "added", doubled.alias("doubled"))


def _pairs(x: DataFrame, y: DataFrame, condition: F.Column) -> DataFrame:
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & condition)
    return pairs.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()


def _possible(s: Settings) -> F.Column:
    """Members ``x`` and ``y`` of a bucket may be linked.

    Two members share at most the hub's shingles that neither lacks and what both have outside the hub: no more than either
    has there with others, and than the bits which both set, each for one shingle and for those of one member that
    share a bit. Where that is too little for the threshold the pair can't be a link. This spares near copies with
    edits of their own, and fillings of one template that differ in more places than a link allows.
    """
    kept = F.col("x.hub_n") - sum((F.bit_count(F.col("x.lost")[i].bitwiseOR(F.col("y.lost")[i])) for i in range(_BIT_WORDS)), F.lit(0))
    met = sum((F.bit_count(F.col("x.added")[i].bitwiseAND(F.col("y.added")[i])) for i in range(_BIT_WORDS)), F.lit(0))
    most = F.least("x.common", "y.common", kept + F.least("x.outside", "y.outside", met + F.least("x.doubled", "y.doubled")))
    bounded = F.col("x.common").isNull() | F.col("y.common").isNull() | ((100 + s.numerator) * most >= s.numerator * (F.col("x.n") + F.col("y.n")))
    return _near(F.col("x.n"), F.col("y.n"), F.col("x.sketch"), F.col("y.sketch"), s) & bounded


def _across(near: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b) of a bucket's classes in different components that can still be linked; one side is not linked to the hub."""
    x, y = near.where("component <> hub_component").alias("x"), near.alias("y")
    once = (F.col("y.component") == F.col("y.hub_component")) | (F.col("x.class") < F.col("y.class"))
    return _pairs(x, y, (F.col("x.component") != F.col("y.component")) & once & _possible(s))


def _near(n: F.Column, m: F.Column, sketch: F.Column, other: F.Column, s: Settings) -> F.Column:
    """Sizes and sketches allow a link."""
    differ = sum((F.bit_count(sketch[i].bitwiseXOR(other[i])) for i in range(s.sketch_words)), F.lit(0))
    return (100 * F.least(n, m) >= s.numerator * F.greatest(n, m)) & (differ <= s.most_different_bits)


def _plausible(pairs: DataFrame, info: DataFrame, s: Settings) -> DataFrame:
    left = info.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    right = info.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(right, "b").join(left, "a")
    return both.where(_near(F.col("n_a"), F.col("n_b"), F.col("sketch_a"), F.col("sketch_b"), s)).select("a", "b")


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, s: Settings, sets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a written table) with ``linked``, decided on the full shingle sets of one document of each class; and those sets."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()  # a hub stands in many pairs
    missing = classes.select("class", "id", "text_key").join(used, "class", "left_semi")
    missing = saved(missing if sets is None else missing.join(sets, "class", "left_anti"), "wanted")
    if sets is None or not missing.isEmpty():
        one = _sieved(texts, missing, "id", "text_key").groupBy("id", "text_key").agg(F.first("text").alias("text"))
        read = saved(shingle_table(one.join(missing, ["id", "text_key"]), s), "sets")
        known = read if sets is None else sets.union(read)
    else:
        known = sets
    if sets is not None:  # few of the sets known from before are needed
        sets = saved(_sieved(known, used, "class").join(used, "class", "left_semi"), "needed")
    else:
        sets = known
    dropped(missing)
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    decided = pairs.join(right, "b").join(left, "a").select("a", "b", (100 * both.cast("long") >= s.numerator * union).alias("linked"))
    decided = saved(decided, "links")
    dropped(pairs)
    return decided, known


def without_near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one document of each group, the smallest id.

    Of rows that share an id and a shingle set one stays (the smallest hash of all columns decides). Rows of one id with
    different texts are different documents: each stays unless its text is in a group of which another text stays.
    Wordless texts stay, once for each id and text; rows with a null id all stay. Columns may have any names.
    """
    kept = near_duplicates(docs, s).where("kept and first_class and doc_id is not null")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.coalesce("class_id", "text_key").alias("_class")).distinct()
    named = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_key"))
    named = named.join(kept, ["_id", "_key"]).groupBy("_id", "_class").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return named.select("_row.*").union(docs.where(F.col("doc_id").isNull()))
