"""Operators 11, 12 and 13 against plain versions, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.llm import centroids, copies, resampling
from gridlake.llm.text import chunks
from tests.llm.brute import low

# ---- plain versions ----------------------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, scale=64):
    """[(id, cluster, distance)] and the final centroids, in whole numbers."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    now = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((far(v, c), n) for n, c in enumerate(now))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(now)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == n]
            if mine:
                now[n] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], now


def plain_copies(rows):
    """[(id, keep_id, size, kept, sha)] of rows with ids."""
    groups = {}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i))
    out = []
    for i, t in rows:
        own = groups[norm(t)]
        out.append((i, min(own)[1], len(own), (-len(t or ""), i) == min(own), hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


def plain_resampling(rows, target, buckets, percent, least):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))

    def bag(t):
        w = words(t)
        return [zlib.crc32(f.encode()) % buckets for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]

    docs = [(i, bag(t), len(words(t))) for i, t in rows]
    s, t = Counter(b for _, x, _ in docs for b in x), Counter(b for x in target for b in bag(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, x, n in docs:
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, x)) // len(x) if x else 0
        out.append((i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((-r[3], r[0]) for r in out if r[4] >= least)
    rank = {i: n + 1 for n, (_, i) in enumerate(able[: percent * len(able) // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in out)


# ---- centroid clustering -----------------------------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(3)
    blobs = rng.normal(size=(6, 64))
    rows = [(i, (blobs[i % 6] + 0.05 * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(150 + i, rng.normal(size=64).astype(np.float32).tolist()) for i in range(50)]
    rows += [(200 + i, rows[7][1]) for i in range(40)] + [rows[3], rows[3]]  # copies, and repeated rows
    odd = [None, [], [1.0] * 63, [1.0] * 65, [*[1.0] * 63, None], [*[1.0] * 63, float("nan")], [float("inf"), *[1.0] * 63], [1e20, *[1.0] * 63]]
    return rows, [(300 + i, v) for i, v in enumerate(odd)], [(None, [0.5] * 64), (None, [-0.25] * 64)]


KIND = "vec_id long, embedding array<float>, cluster string, id string"


def test_clusters_equal_plain_ones(spark):
    rows, odd, unnamed = vectors()
    df = spark.createDataFrame([(i, v, "c", "x") for i, v in rows + odd + unnamed], KIND).repartition(5)
    got = centroids.clusters(df).collect()
    want, final = plain_clusters(rows + unnamed, 16, 3)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=key) == sorted(want, key=key)
    inertia = Counter()
    for _, c, d in want:
        inertia[c] += d
    for r in got:
        assert r["cluster_inertia"] == inertia[r["cluster"]] and r["inertia"] == sum(inertia.values())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, final[r["cluster"]])).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors_give_few_clusters(spark, n):
    rows = vectors()[0][:n]
    got = centroids.clusters(spark.createDataFrame([(i, v, "c", "x") for i, v in rows], KIND))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(plain_clusters(rows, 16, 3)[0])


def test_equal_vectors(spark):
    """All starts are one point, so the pivots are one point too and all ties go to number 0."""
    got = centroids.clusters(spark.createDataFrame([(i, [0.25] * 64, "", "") for i in range(30)], KIND)).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)}


def test_bounds_hold_and_discard():
    """On vectors in groups most centroids are ruled out; bounds never rule the nearest out, small and large components alike."""
    rng = np.random.default_rng(9)
    for size in (10, 1000, centroids.LARGEST // 8):
        base = rng.integers(-size, size, (16, 64))
        points = base[rng.integers(0, 16, 800)] + rng.integers(-1 - size // 20, 2 + size // 20, (800, 64))
        now = np.array([points[rng.integers(0, 800, 9)].sum(axis=0) // 9 if j % 5 == 0 else base[j] + 1 for j in range(16)])
        pivots = centroids.choose_pivots(points[:16], 12)
        nearest = centroids.Nearest(pivots, now)
        number, best = nearest(points, centroids.squared_distances(points, pivots))
        exact = centroids.squared_distances(points, now)
        assert (best == exact.min(axis=1)).all() and (number == exact.argmin(axis=1)).all()
        assert nearest.compared < 0.6 * exact.size


# ---- exact copies ------------------------------------------------------------------------------------------------


def texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))
    rows = [None, "", " ", "\t\n\x0b\x0c\r ", "a", " a", "a ", " a", "é è", "éè", "é  è", " "]
    rows += [" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(300)]
    long = "".join(rng.choice("abcdefgh ") for _ in range(200_000))
    return list(enumerate(rows + [long, long + "x", " " + long, long[:-1]]))


DOCS = "doc_id long, text string, length int, sha string, n int"


@pytest.mark.parametrize("limits", [copies.Settings(), copies.Settings(combine_bytes=3000, trie_bytes=4000)])
def test_copies_equal_plain_ones(spark, limits):
    """With small limits tries are flushed before the shuffle, and spilled after it, again and again."""
    df = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in texts()], DOCS).repartition(6)
    assert sorted(tuple(r) for r in copies.exact_copies(df, limits).collect()) == sorted(plain_copies(texts()))


def test_copies_without_ids_and_repeated(spark):
    rows = [(None, "x y"), (None, "xy"), (5, "xy"), (5, "xy"), (6, "x y"), (6, "xy"), (None, "z"), (None, "z"), (None, "  z"), (8, "w")]
    df = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], DOCS)
    got = [tuple(r)[:4] for r in copies.exact_copies(df).collect()]
    want = [(None, 6, 6, False)] * 2 + [(5, 6, 6, False)] * 2 + [(6, 6, 6, False), (6, 6, 6, True), (8, 8, 1, True)] + [(None, None, 3, False)] * 2 + [(None, None, 3, True)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in copies.without_copies(df).collect()))) == sorted(map(str, [(6, "x y"), (None, "  z"), (8, "w")]))
    assert copies.without_copies(df).columns == df.columns
    assert copies.exact_copies(df.limit(0)).collect() == []


def test_trie_spills_subtrees():
    rng = random.Random(2)
    trie, seen = copies.Trie(), {}
    for i in range(4000):
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 7)))
        left = [] if trie.insert(text, len(text), i, 1) else [(text, [len(text), i, 1])]
        if i % 500 == 499:
            before = trie.size
            left += trie.spill()
            assert trie.size < before and trie.ends >= 1
        for t, own in left:
            seen.setdefault(t, []).append((own[1], own[2]))
    for t, own in trie.entries():
        seen.setdefault(t, []).append((own[1], own[2]))
    rng = random.Random(2)
    want = {}
    for i in range(4000):
        want.setdefault(bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 7))), []).append(i)
    assert {t: (min(i for i, _ in x), sum(n for _, n in x)) for t, x in seen.items()} == {t: (x[0], len(x)) for t, x in want.items()}


def test_trie_shares_beginnings():
    trie = copies.Trie()
    for t in (b"romane", b"romanus", b"romulus", b"rom", b"", b"romane"):
        trie.insert(t, 1, 1, 1)
    assert dict((t, o[2]) for t, o in trie.entries()) == {b"romane": 2, b"romanus": 1, b"romulus": 1, b"rom": 1, b"": 1}
    assert [bytes([k]) for k in trie.root.children] == [b"r"] and trie.root.children[ord("r")].edge == b"rom"


# ---- importance resampling ---------------------------------------------------------------------------------------


def sampled():
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcdeéXY9") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    text = lambda n: "".join(rng.choice(pool) + rng.choice([" ", ", ", "\n", " ", "-", "\x00"]) for _ in range(n))
    rows = [None, "", " ", "one", "one two", "x" * 70 + " " + "y" * 300, "é" * 50] + [text(rng.randint(0, 60)) for _ in range(300)] + [text(4000)]
    return list(enumerate(rows)), [text(20) for _ in range(20)] + [None, ""]


SAMPLED = "doc_id long, text string, rank int, a string, score string"


def test_resampling_equals_plain_one(spark):
    rows, target = sampled()
    docs = spark.createDataFrame([(i, t, 1, "a", "s") for i, t in rows], SAMPLED).repartition(7)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    for s in (resampling.Settings(), resampling.Settings(buckets=50, finish=1), resampling.Settings(percent=100, least_words=0), resampling.Settings(percent=0)):
        got = sorted(tuple(r) for r in resampling.resample(docs, bench, s).collect())
        assert got == plain_resampling(rows, target, s.buckets, s.percent, s.least_words)


def test_resampling_edges(spark):
    rows, target = sampled()
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    none = spark.createDataFrame([], "text string")
    docs = spark.createDataFrame([(i, t, 1, "a", "s") for i, t in rows], SAMPLED)
    assert resampling.resample(docs.limit(0), bench).columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert resampling.resample(docs.limit(0), bench).collect() == []
    assert sorted(tuple(r) for r in resampling.resample(docs, none).collect()) == plain_resampling(rows, [], 10_000, 25, 20)
    # Repeated rows are drawn one by one, and ranks stay distinct; rows without an id have no score.
    twice = docs.union(docs).union(docs.withColumn("doc_id", F.lit(None).cast("long")))
    got = resampling.resample(twice, bench, resampling.Settings(finish=1)).collect()
    able = sum(r["n_features"] >= 39 for r in got if r["doc_id"] is not None)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, able // 4 + 1))
    assert all(r["score"] is None and r["rank"] is None for r in got if r["doc_id"] is None) and len(got) == 3 * len(rows)


def test_features_are_crcs_of_runs():
    rows, _ = sampled()
    for chunk in chunks(pa.array([t for _, t in rows])):
        bucket, border = resampling.features(chunk, 1 << 32)
        for i in range(len(chunk)):
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(rows[chunk.first + i][1]))
            assert bucket[border[i] : border[i + 1]].tolist() == [zlib.crc32(f.encode()) for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


@pytest.mark.parametrize("finish", [1, 40])
def test_cutoff_is_exact(spark, finish):
    rng = random.Random(1)
    keys = sorted({(rng.randint(-3, 3) if rng.random() < 0.5 else rng.randint(-900, 900), rng.randint(-9, 9), i) for i in range(600)})
    rng2 = random.Random(2)
    df = spark.createDataFrame(rng2.sample(keys, len(keys)), "a long, b long, c long").repartition(9)
    for draw in (1, 2, 150, 299, 599, 600):
        assert resampling.cutoff(df, draw, resampling.Settings(finish=finish)) == keys[draw - 1]
    assert resampling.cutoff(df, 0) is None and resampling.cutoff(df, 601) is None


def test_weighted_median_halves():
    medians = [((1, 0, 0), 5), ((2, 0, 0), 1), ((9, 0, 0), 5)]
    assert resampling.weighted_median(medians) == (2, 0, 0)
