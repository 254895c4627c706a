"""Registered queries against their oracle SQL, operators 2, 4, 6, 7 and 9 on edge cases, and the pipeline."""

import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gridlake.llm import decontaminate, lines, packing, quality, queries, scratch, text, tokens
from tests.llm import brute

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    want = db.execute(queries.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_encoder_equals_the_tokenizer():
    rng = random.Random(3)
    parts = ["'", "'s", "'re", "'ll", "'ve", "'t", "'d", "'m", " ", "  ", "\n", "\t", "\r\n", "a", "é", "Ā", "1", "23", "!", "#", "-", "–", "’", "€", "×", "中", " ", "\x1c", "\x85", "<|endoftext|>", "The", "x y", "_", "١"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [None]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for name, expected in (("byte_bpe_50k.json", want), ("word_bpe_49k.json", None)):
        path = public_tokenizers.path(name)
        expected = expected or [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
        encode, got = tokens.Encoder(path), []
        for chunk in text.chunks(pa.array(texts), 500):
            ids, border = encode(chunk)
            got += [ids[a:b].tolist() for a, b in zip(border[:-1], border[1:], strict=True)]
        assert got == expected


def token_rows():
    rng = random.Random(4)
    return [(1, None), (2, ""), (3, "word " * 5000), (None, "no id"), (4, "again"), (4, "again")] + [(i, "some words " * rng.randint(1, 60)) for i in range(5, 60)]


def test_packing_round_trip(spark):
    rows = token_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("ids", F.lit(2)).repartition(5)
    pieces = packing.pack(docs, PATH, window=128).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows)
    stream = b"".join(p.ids for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)))
    at, got = 0, []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 128 + p.offset == at and p.offset + p.length <= 128 and len(p.ids) == 4 * p.length
        at += p.length
        if p.start == 0:
            got.append((p.doc_id, p.doc_tokens))
    assert len(stream) == 4 * at == 4 * sum(map(len, want))
    ids = np.frombuffer(stream, "<u4").tolist()
    docs_back, first = [], 0
    for _, n in got:
        docs_back.append(ids[first : first + n])
        first += n
    assert sorted(docs_back) == want
    assert packing.boundaries(packing.pack(docs, PATH, window=128)).count() == len(rows)
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_length_histogram(spark):
    rows = token_rows()
    counted = tokens.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    tokenizer = Tokenizer.from_file(PATH)
    sizes = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    assert sorted(r.n_tokens for r in counted.collect()) == sizes
    histogram = tokens.length_histogram(counted).cache()
    for r in histogram.collect():
        n = r.n_tokens
        assert (r.n_docs, r.docs_up_to, r.docs_from) == (sizes.count(n), sum(x <= n for x in sizes), sum(x >= n for x in sizes))
        assert (r.tokens_up_to, r.truncated_tokens) == (sum(x for x in sizes if x <= n), sum(min(x, n) for x in sizes))
    for r in tokens.totals_at_limits(histogram, [1, 50, 100000]).collect():
        n = r.context_limit
        assert (r.docs_that_fit, r.tokens_that_fit, r.truncated_tokens) == (sum(x <= n for x in sizes), sum(x for x in sizes if x <= n), sum(min(x, n) for x in sizes))
    assert [r.n_tokens for r in tokens.quantiles(histogram, [0.5, 1.0]).collect()] == [sizes[-(-len(sizes) // 2) - 1], sizes[-1]]
    assert tokens.length_histogram(counted.limit(0)).count() == 0


def test_line_dedup_edges(spark):
    long = "a line of ten words or more is enough by itself"
    rows = [(1, f"{long}\nx\n\ny\nz"), (2, f"{long}\nown"), (3, "x\ny\nother\n"), (3, "x\ny\nother\n"), (None, f"{long}"), (4, None), (5, ""), (6, "s\ns\ns\ns"), (7, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rest", F.lit(1)).withColumn("key", F.lit("k")).withColumn("n_lines", F.lit(9))
    got = lines.remove_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", "rest", "key", "n_lines", "n_removed", "longest_run"]
    found = sorted(((r.doc_id, r.text, r.n_removed) for r in got.collect()), key=str)
    want = [(1, f"{long}\nx\n\ny\nz", 0), (2, "own", 1), (3, "other\n", 2), (3, "other\n", 2), (None, long, 0), (4, None, 0), (5, "", 0), (6, "s", 3), (7, "", 1)]
    assert found == sorted(want, key=str)
    assert {r.doc_id for r in lines.without_emptied(got).collect()} == {1, 2, 3, None, 4, 5, 6}
    assert lines.remove_repeated_lines(docs.limit(0)).count() == 0


def test_runs_of_every_length_are_covered(spark):
    run = [f"line number {i}" for i in range(37)]
    rows = [(1, "\n".join(run)), (2, "\n".join(["own start", *run[3:30], "own end"]))]
    got = {r.doc_id: (r.n_removed, r.longest_run) for r in lines.remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (0, 0), 2: (27, 27)}


def test_contamination_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 6, 9, 30, 33, 64, 150])))) for i in range(60)] + [(100, ""), (101, None), (None, "null id")]
    rows = []
    for i in range(120):
        body = [word() for _ in range(rng.choice([0, 20, 300, 3000]))]
        for _ in range(rng.randint(0, 2)):
            own = (rng.choice(items)[1] or "").upper().split()
            if own and rng.random() < 0.5:
                own[rng.randrange(len(own))] = word()
            at = rng.randint(0, len(body))
            body[at:at] = own
        rows.append((i, " ".join(body)))
    rows += [(None, items[20][1]), (500, None), (3, rows[3][1]), (501, next(t for _, t in items if t and len(t.split()) == 3).upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_ids", F.lit(0))
    tests = spark.createDataFrame(items, "item_id long, text string")

    def holds(doc, item):
        own = brute.shingles(item, 5)
        return bool(own) and 10 * len(own & brute.shingles(doc, 5)) >= 8 * len(own)

    want = sorted((str(i), [j for j, item in items if j is not None and holds(t, item)]) for i, t in rows)
    for s in (decontaminate.Settings(), decontaminate.Settings(block_shingles=300)):
        got = decontaminate.contaminated(docs, tests, s).collect()
        assert sorted((str(r.doc_id), r.item_ids) for r in got) == want
        clean = decontaminate.without_contaminated(docs, tests, s)
        assert clean.columns == docs.columns and sorted(str(r.doc_id) for r in clean.collect()) == [i for i, x in want if not x]
    assert decontaminate.contaminated(docs.limit(0), tests).count() == 0 and not any(r.contaminated for r in decontaminate.contaminated(docs, tests.limit(0)).collect())


def test_quality_classifier(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_quality_classifier(spark, sf).cache()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").isEmpty()
    for r in got.select("doc_id", "held_out").limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert held > 0.9
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.quality_scores(docs, flipped).select("doc_id", "score")
    assert again.exceptAll(got.select("doc_id", "score")).isEmpty()  # held-out labels change nothing


def test_quality_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x y"), (3, "x"), (3, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0), (3, 0), (3, 1)], "doc_id long, quality int")
    assert quality.quality_scores(docs, labels).count() == 5
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF).cache()
        if name == "packing":
            break
        assert kept.columns == docs.columns and kept.count() <= before.count()
        given, left = {r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in kept.collect()}
        if name == "quality_classifier":
            weights = quality.train(quality.training_sample(before, spark.read.parquet(f"{SF}/labels.parquet")))
            assert set(left) == {r.doc_id for r in quality.score(before, weights).where("score >= 0.3").collect()}
        if name == "line_dedup":
            plain = brute.line_dedup(given.items())
            assert left == {i: text for i, (text, n, gone) in plain.items() if n == 0 or gone < n}
            assert all(r.n_chars == len(r.text) for r in kept.collect())
        if name == "minhash_near_dedup":
            assert set(left) == {i for i, (_, c) in brute.near_duplicates(given.items(), 5, 80).items() if i == c}
        if name == "decontamination":
            sets = [s for s in (brute.shingles(t, 5) for t in benchmark) if s]
            assert set(left) == {i for i, t in given.items() if not any(10 * len(s & brute.shingles(t, 5)) >= 8 * len(s) for s in sets)}
        if name != "line_dedup":
            assert all(given[i] == t for i, t in left.items())
    assert {r.doc_id for r in kept.select("doc_id").distinct().collect()} == set(left)
    tokenizer = Tokenizer.from_file(PATH)
    assert kept.agg(F.sum("length")).first()[0] == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in left.values())
    whole = corpus_pipeline.run(spark, SF)  # the order of rows, and so where windows cut, is free
    assert whole.select("doc_id", "doc_tokens").distinct().exceptAll(kept.select("doc_id", "doc_tokens").distinct()).isEmpty()
    assert whole.agg(F.sum("length")).first() == kept.agg(F.sum("length")).first()


def test_suffix_ranks_and_maximal_runs(spark):
    """Ranks follow the order of the line sequences; maximal runs have their exact lengths and sources."""
    rng = random.Random(6)
    body = [rng.choice("abcd") for _ in range(60)]
    seqs = {1: body, 2: ["x", *body[5:28], "y", *body[30:33]], 3: [*body[10:21], "z", *body[5:28]], 4: ["q", "r"], 5: [rng.choice("ab") for _ in range(40)]}
    docs = spark.createDataFrame([(i, "\n".join(s)) for i, s in seqs.items()] * 2, "id long, text string").withColumn("key", F.lit(0).cast("long"))
    levels = lines.suffix_ranks(lines.line_table(docs))
    name = {}
    for r in lines.line_table(docs).collect():
        name[seqs[r.id][r.pos]] = r.name  # lines are ordered by their hash
    coded = {i: [name[x] for x in s] for i, s in seqs.items()}
    for k, level in enumerate(levels):
        size, prefix = 1 << k, {}
        for i, s in coded.items():
            for p in range(len(s) - size + 1):
                prefix.setdefault(tuple(s[p : p + size]), []).append((i, p))
        shared = {x: places for x, places in prefix.items() if len(places) > 1}
        got = {(r.id, r.pos): (r.rank, (r.first.id, r.first.pos), r.later) for r in level.collect()}
        assert set(got) == {q for places in shared.values() for q in places}
        assert all(got[q][1:] == (min(places), q > min(places)) for places in shared.values() for q in places)
        order = [x for _, x in sorted((got[places[0]][0], x) for x, places in shared.items())]
        assert order == sorted(shared) and len({r for r, _, _ in got.values()}) == len(shared)
    gone = set()
    for r in lines.copied_runs(levels).collect():
        s, f = seqs[r.id], seqs[r.first.id]
        assert (r.first.id, r.first.pos) < (r.id, r.pos) and s[r.pos : r.pos + r["size"]] == f[r.first.pos : r.first.pos + r["size"]]
        assert s[r.pos + r["size"] : r.pos + r["size"] + 1] != f[r.first.pos + r["size"] : r.first.pos + r["size"] + 1] or r.pos + r["size"] == len(s)
        if r["size"] > 1:
            gone |= {(r.id, r.pos + d) for d in range(r["size"])}
    want, seen = set(), {}
    for i, s in seqs.items():
        for p in range(len(s) - 1):
            if seen.setdefault(tuple(s[p : p + 2]), (i, p)) != (i, p):
                want |= {(i, p), (i, p + 1)}
    assert gone == want


def test_plans_of_runs_dont_grow_with_levels(spark, monkeypatch):
    """A copied run of 70 lines has seven levels; no written plan holds a join for each, and no table but the result's stays."""
    body = [f"line {i} of the run" for i in range(70)]
    docs = spark.createDataFrame([(1, "\n".join(body)), (2, "\n".join(["own", *body, "tail"])), (3, "\n".join(body[7:40]))], "doc_id long, text string")
    joins, before = [], set(scratch._written)
    real = scratch.saved

    def counted(df, name):
        joins.append(len(re.findall(r"\bJoin \w", df._jdf.queryExecution().optimizedPlan().toString())))
        return real(df, name)

    for module in (lines, scratch):
        monkeypatch.setattr(module, "saved", counted)
    cleaned = lines.remove_repeated_lines(docs)
    assert max(joins) == 2
    assert [x.split("/")[-1].split("-")[0] for x in set(scratch._written) - before] == ["runs"]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed, r.longest_run) for r in cleaned.collect()}
    assert got == {1: ("\n".join(body), 70, 0, 0), 2: ("own\ntail", 72, 70, 70), 3: ("", 33, 33, 33)}


def test_scores_in_small_chunks(monkeypatch):
    """Texts are scored half a megabyte at a time, whatever the batch; each row's score is that of its text alone."""
    rng = random.Random(4)
    rows = [" ".join(rng.choice(["alpha", "Beta", "g4mma", "delta,"]) for _ in range(2000)) for _ in range(150)]
    weights, sizes = np.random.default_rng(2).normal(size=1 << 12), []
    real = quality.features
    monkeypatch.setattr(quality, "features", lambda chunk, bits: sizes.append(len(chunk.data)) or real(chunk, bits))
    got = quality._scores(pa.array([*rows, None]), weights, 12)
    assert sum(sizes) == sum(map(len, rows)) > 3 * max(sizes) and max(sizes) <= 1 << 19
    assert got.tolist() == [quality._scores(pa.array([row]), weights, 12)[0] for row in [*rows, None]]


def test_ftrl_against_a_plain_version():
    rng = random.Random(9)
    s = quality.Settings(bits=6, passes=3)
    rows = [sorted({rng.randrange(64): rng.uniform(0.1, 1) for _ in range(rng.randint(1, 8))}.items()) for _ in range(60)]
    labels = [int(sum(i for i, _ in r) % 3 == 0) for r in rows]
    visits = np.random.default_rng(7)
    order = [r for _ in range(s.passes) for r in visits.permutation(len(rows))]
    want = brute.ftrl(rows, labels, order, 64, s.alpha, s.beta, s.l1, s.l2)
    got = quality.fit([np.array([i for i, _ in r]) for r in rows], [np.array([v for _, v in r]) for r in rows], np.array(labels, float), s)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-12) and any(want)


def test_scores_are_sparse_dot_products():
    rng = np.random.default_rng(5)
    w = rng.normal(size=1 << 12)
    texts = ["", None, "one", "Some words here, some WORDS there 12!", "x y " * 300, "  \n "]
    got = quality._scores(pa.array(texts), w, 12)
    for value, one in zip(got, texts, strict=True):
        (chunk,) = text.chunks(pa.array([one], pa.string()))
        index, weight, border = quality.features(chunk, 12)
        assert border[-1] == len(index) and (len(index) == 0 or abs((weight**2).sum() - 1) < 1e-9)
        total = w[0] + sum(w[i] * v for i, v in zip(index.tolist(), weight.tolist(), strict=True))
        assert abs(value - 1 / (1 + np.exp(-total))) < 1e-12
        assert value == quality._scores(pa.array([one], pa.string()), w, 12)[0]  # to the last bit


def test_packing_query(spark):
    """The registered columns: places without gaps, pieces cut from each document's own ids."""
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(PATH)
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in given.items()}
    pieces = sorted(queries.op4_packing(spark, SF).collect(), key=lambda p: (p.sequence_id, p.offset))
    at, seen = 0, {i: 0 for i in given}
    for p in pieces:
        assert p.sequence_id * 2048 + p.offset == at and 0 < p.length <= 2048 - p.offset and p.start == seen[p.doc_id]
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids[p.doc_id])
        at += p.length
        seen[p.doc_id] += p.length
    assert seen == {i: len(x) for i, x in ids.items()}


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and ids, clashing and missing columns; then empty tables. Nothing is left in the shared folder but the last tables."""
    body = [f"word{i} is followed by line {i}" for i in range(40)]
    good = "\n".join(body)
    rows = [(1, good, "en"), (1, good, "en"), (1, "a text of its own with quite some words in it", None), (2, None, "en"), (2, "", "de"), (None, good + "\nmore", "en"), (3, "x " + good.upper(), "en"), (4, " ".join(f"t{i}" for i in range(30)), "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("rest", "runs", "key", "class", "id", "stored", "_row"):
        docs = docs.withColumn(name, F.lit(name))
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    tests = spark.createDataFrame([(9, " ".join(f"t{i}" for i in range(20))), (None, None)], "item_id long, text string")
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    for part, n in (("a", None), ("b", 0)):
        tests.write.parquet(f"{tmp_path}/{part}/benchmark.parquet")
        labels.write.parquet(f"{tmp_path}/{part}/labels.parquet")
        pieces = corpus_pipeline.run(spark, f"{tmp_path}/{part}").collect()
        if n is None:
            found = sorted({(str(p.doc_id), p.doc_tokens) for p in pieces})
            assert {i for i, _ in found} == {"1", "2", "None"}  # 3 is a near copy of 1, and 4 holds a test passage
            assert len([i for i, _ in found if i == "1"]) == 2  # both texts, each once
        else:
            assert pieces == []
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, f"{tmp_path}/a")
        assert kept.columns == docs.columns


def test_an_encoder_keeps_a_bounded_number_of_pieces():
    """Workers outlive their stage: what one keeps counts with its executor's memory in all later stages."""
    own = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" ".join(f"x{k:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for k in range(i, i + 4000)) for i in range(0, 400_000, 4000)]
    for chunk in text.chunks(pa.array(texts), 64 << 10):
        own(chunk)
    assert 100_000 < len(own.known) + len(own.before) < 300_000
