"""Operators 1 and 3 against plain versions, and their edge cases."""

import random

import ahocorasick
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.llm import components, minhash, queries, substrings, text
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def corpus():
    """Exact copies, near copies in chains, shared passages, short and empty texts, one long text."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    base = [word() for _ in range(120)]
    texts = [None, "", " \n ", "one", "one two", "ONE two", "a b c"]
    passage = [word() for _ in range(60)]
    chain = list(base)
    for step in range(12):
        chain = list(chain)
        chain[7 * step + 3] = word()
        texts.append(" ".join(chain))
    texts += [" ".join(base).upper()] * 3 + ["  ".join(base)]
    for _ in range(6):
        texts.append(" ".join([word() for _ in range(30)] + passage[: rng.randint(49, 60)] + [word() for _ in range(20)]))
    texts.append(" ".join(word() for _ in range(8000)) + " " + " ".join(passage))
    texts += ["spam " * 200, "spam " * 130]
    return texts


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dedup"))
    rows = [(i, t, "en", 1, 2) for i, t in enumerate(corpus())]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, id int, key int").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def rows_of(spark, path):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]


@pytest.mark.parametrize("fixture", ["own", "sf"])
def test_near_duplicates(spark, docs, fixture):
    path = docs if fixture == "own" else SF
    want = brute.near_duplicates(rows_of(spark, path), 3, 85)
    got = {r.doc_id: r for r in queries.op1_minhash(spark, path).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_duplicates_five_words(spark, docs):
    got = minhash.near_duplicates(spark.read.parquet(f"{docs}/documents.parquet")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows_of(spark, docs), 5, 80)


def test_near_duplicates_nulls_and_repeats(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(5, words), (5, words), (3, words), (None, words), (9, None), (9, "other words here"), (None, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str)
    assert found == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, None, True), (9, 9, True), (9, 9, True), (None, None, True)], key=str)
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("with_base", [True, False])
def test_large_group_around_the_threshold(spark, with_base):
    """Copies with edits of their own: links to the base and between copies lie on both sides of the threshold."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(200)]
    rows = [(0, " ".join(base))] if with_base else []
    for i in range(1, 121):
        rate = rng.uniform(0.005, 0.06)
        copy = [word() if rng.random() < rate else w for w in base]
        if i % 10 == 0:
            copy += [word() for _ in range(12)]
        rows.append((i, " ".join(copy)))
    want = brute.near_duplicates(rows, 3, 85)
    assert 2 < len({c for _, c in want.values()}) < 100
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), minhash.Settings(shingle=3, numerator=85)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_bands_find_a_pair_at_the_threshold():
    s = minhash.Settings()
    assert (1 - 0.8**s.rows) ** s.bands < 2e-7 and s.bands * s.rows == 2 * s.permutations


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (60, 100), (7, 7), (None, 1), (60, 100)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 60: 50, 100: 50}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("fixture", ["own", "sf"])
def test_substring_dedup(spark, docs, fixture):
    path = docs if fixture == "own" else SF
    want = brute.substring_dedup(rows_of(spark, path), 50)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op3_substring_dedup(spark, path).collect()}
    assert got == {i: (n, gone, brute.digest(" ".join(kept))) for i, (n, gone, kept) in want.items()}
    assert any(gone for _, gone, _ in got.values())


def test_substring_dedup_nulls_and_repeats(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (5, text), (None, text), (6, text + " tail"), (6, "something else"), (4, None)]
    got = substrings.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_words", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, 60, 0), (5, 60, 0), (None, 60, 0), (6, 61, 60), (6, 2, 0), (4, 0, 0)], key=str)
    assert substrings.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_kept_words_are_whole(spark, docs):
    found = substrings.remove_repeated(spark.read.parquet(f"{docs}/documents.parquet"), substrings.Settings(window=10, phrase=3))
    want = brute.substring_dedup(rows_of(spark, docs), 10)
    assert {r.doc_id: r.kept_text for r in found.where(F.col("doc_id").isNotNull()).collect()} == {i: " ".join(k) for i, (_, _, k) in want.items()}


def template_pages(n, slots=10, choices=5, words=200):
    """Pages of one template whose slots take their words from shared pools: links to any one page are few, chains reach all."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, pools = [word() for _ in range(words)], [[word() for _ in range(choices)] for _ in range(slots)]
    out = []
    for i in range(n):
        page = list(base)
        for k in range(slots):
            page[10 + 19 * k] = rng.choice(pools[k])
        out.append((i, " ".join(page)))
    return out


def test_template_pages_cost_a_few_confirmations_each(spark, monkeypatch):
    confirm, counts = minhash._confirmed, []

    def counting(*args):
        found = confirm(*args)
        counts.append(found[0].count())
        return found

    monkeypatch.setattr(minhash, "_confirmed", counting)
    pages = template_pages(800)
    got = minhash.near_duplicates(spark.createDataFrame(pages, "doc_id long, text string"), minhash.Settings(shingle=3, numerator=85)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: 0 for i, _ in pages}
    assert sum(counts) < 40 * len(pages)  # all pairs of the buckets are 72,602


def test_template_pages_that_are_apart_are_confirmed_with_hubs_only(spark, monkeypatch):
    confirm, counts = minhash._confirmed, []

    def counting(*args):
        found = confirm(*args)
        counts.append(found[0].count())
        return found

    monkeypatch.setattr(minhash, "_confirmed", counting)
    pages = template_pages(400, slots=14, choices=40, words=290)
    got = minhash.near_duplicates(spark.createDataFrame(pages, "doc_id long, text string"), minhash.Settings(shingle=3, numerator=85)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i for i, _ in pages}
    assert sum(counts) < 20 * len(pages)  # all pairs are 79,800


@pytest.mark.parametrize("words", [1, 64, 1 << 18])
def test_sieve_loses_no_row_that_is_wanted(spark, monkeypatch, words):
    monkeypatch.setattr(minhash, "_FILTER_WORDS", words)
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 7 > 0, F.xxhash64("id")).alias("text_key"), F.lit("x").alias("_note"))
    wanted = rows.where("id % 50 = 3").select("id", "text_key")
    got = minhash._sieved(rows, wanted, "id", "text_key")
    assert got.columns == rows.columns
    found = {r.id for r in got.collect()}
    assert found >= set(range(3, 20_000, 50))
    assert len(found) < 500 or words < 1 << 18  # a full filter lets others pass, the join behind it decides
    assert minhash._sieved(rows, wanted.limit(0), "id", "text_key").count() == 0


def test_without_near_duplicates_keeps_texts_of_one_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text, "a"), (5, text, "b"), (3, text, "c"), (9, None, "d"), (9, "other words here", "e"), (9, "Other words here", "f"), (9, "third text", "g"), (None, text, "h"), (None, text, "h"), (8, "", "i"), (8, "", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").withColumn("class", F.lit(1)).withColumn("_row", F.lit(2))
    got = minhash.without_near_duplicates(docs)
    assert got.columns == docs.columns
    found = sorted((str(r.doc_id), str(r.text).lower()) for r in got.collect())
    assert found == sorted([("3", text), ("9", "none"), ("9", "other words here"), ("9", "third text"), ("None", text), ("None", text), ("8", "")])
    assert minhash.without_near_duplicates(docs.limit(0)).count() == 0


def test_passages_are_found_by_the_automaton():
    """The stored passages of a chunk are located only where the shard's automaton meets their phrase."""
    s = substrings.Settings(window=10, phrase=3)
    rng = random.Random(2)
    body = [rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 for _ in range(60)]
    chunk = next(text.chunks(pa.array([" ".join(["own", *body]), "x " + " ".join(body)])))
    found = text.words(chunk)
    p = substrings.passages(found, s)
    first = substrings._leftmost(p, p.first, p.anchor, s)
    short = (found.code >> np.uint64(32)).astype("<u4")
    here = np.flatnonzero(found.row[p.first] == 0)
    stored = pa.StructArray.from_arrays(
        [
            pa.array([short[first[k] : first[k] + 3].tobytes() for k in here], pa.binary()),
            pa.array((first - p.first)[here].astype(np.int32)),
            pa.array((p.windows + s.window - 1)[here].astype(np.int32)),
            pa.array(p.code[here].view(np.int64)),
            pa.array([7] * len(here)),
        ],
        ["phrase", "left", "size", "code", "owner"],
    )

    def covered(shard):
        return sum(len(begin) for begin, _, _ in shard.verified(found))

    shard = substrings.Shard(stored, s)
    assert covered(shard) >= len(here)
    shard.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    assert covered(shard) == 0
    other = substrings.Shard(stored, s)
    other.key = other.key + np.uint64(1)  # an occurrence alone isn't enough: the passage must be the stored one
    assert covered(other) == 0
