"""DuckDB SQL for the operators' queries that SQL can express; each runs over the whole tables."""

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINHASH = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, {_WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, a AS b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(m.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(text, {_WORD}) AS w FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
f AS (SELECT g, min(doc_id) AS owner FROM v GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM v JOIN f USING (g) WHERE owner < doc_id),
k AS (SELECT u.doc_id, count(c.j) AS n_removed, string_agg(u.x, ' ' ORDER BY u.j) FILTER (c.j IS NULL) AS kept
      FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM w) u
      LEFT JOIN c ON c.doc_id = u.doc_id AND c.j = u.j GROUP BY u.doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
"""

LINES = f"""
WITH a AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS ord FROM documents),
b AS (SELECT *, len(regexp_extract_all(line, {_WORD})) AS words FROM a),
p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS pos,
             lead(line) OVER (PARTITION BY doc_id ORDER BY ord) AS after FROM b WHERE words > 0),
q AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1 AND words >= 10 AS one,
             after IS NOT NULL AND row_number() OVER (PARTITION BY line, after ORDER BY doc_id, pos) > 1 AS two FROM p),
r AS (SELECT *, one OR two OR coalesce(lag(two) OVER (PARTITION BY doc_id ORDER BY pos), false) AS gone FROM q),
g AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, gone ORDER BY pos) AS island FROM r),
h AS (SELECT doc_id, max(n) AS longest_run FROM (SELECT doc_id, island, count(*) AS n FROM g WHERE gone GROUP BY doc_id, island) GROUP BY doc_id),
t AS (SELECT b.doc_id, count(g.ord) AS n_lines, count(*) FILTER (g.gone) AS n_removed,
             string_agg(b.line, chr(10) ORDER BY b.ord) FILTER (NOT coalesce(g.gone, false)) AS kept
      FROM b LEFT JOIN g ON g.doc_id = b.doc_id AND g.ord = b.ord GROUP BY b.doc_id)
SELECT d.doc_id, n_lines, n_removed, coalesce(longest_run, 0) AS longest_run, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d JOIN t USING (doc_id) LEFT JOIN h USING (doc_id)
"""


def _grams(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, array_to_string(w[i : i + 4], ' ') AS g
      FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
            FROM (SELECT {key}, regexp_extract_all({_LOW}, {_WORD}) AS w FROM {table}) WHERE len(w) > 0)"""


DECONTAMINATION = f"""
WITH s AS ({_grams('documents', 'doc_id')}),
t AS ({_grams('benchmark', 'item_id')}),
n AS (SELECT item_id, count(*) AS n FROM t GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS c FROM s JOIN t USING (g) GROUP BY doc_id, item_id),
h AS (SELECT doc_id, item_id, c / n AS share FROM c JOIN n USING (item_id) WHERE 10 * c >= 8 * n),
a AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids, max(share) AS best FROM h GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_items, 0) AS n_items, coalesce(item_ids, '') AS item_ids, coalesce(best, 0.0) AS max_containment,
       n_items IS NOT NULL AS contaminated
FROM documents d LEFT JOIN a USING (doc_id)
"""



def _centroids(k: int = 16, rounds: int = 3) -> str:
    """Every vector against every centroid, round by round; all integers."""
    gap = "list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = f"SELECT v.r, min({gap} * {k} + c.c) AS m FROM v, c{{i}} c GROUP BY v.r"
    usable = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64"
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, sha256('1:' || vec_id) AS h,
        list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings WHERE {usable})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, q FROM (SELECT h, q FROM v ORDER BY h LIMIT {k}))",
    ]
    for i in range(rounds):
        parts += [
            f"a{i} AS MATERIALIZED ({near.format(i=i)})",
            f"""u{i} AS MATERIALIZED (SELECT c, list(s ORDER BY i) AS q FROM (SELECT m % {k} AS c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS s
            FROM (SELECT m, unnest(q) AS x, unnest(range(64)) AS i FROM v JOIN a{i} USING (r)) GROUP BY 1, 2) GROUP BY c)""",
            f"c{i + 1} AS MATERIALIZED (SELECT c, coalesce(u{i}.q, c{i}.q) AS q FROM c{i} LEFT JOIN u{i} USING (c))",
        ]
    parts += [
        f"a{rounds} AS MATERIALIZED ({near.format(i=rounds)})",
        f"d AS (SELECT vec_id, CAST(m % {k} AS INT) AS cluster, CAST(m // {k} AS BIGINT) AS distance FROM v JOIN a{rounds} USING (r))",
    ]
    return f"""WITH {", ".join(parts)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM d JOIN c{rounds} c ON c.c = d.cluster"""


COPIES = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = first_value(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM t WINDOW g AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""

# CRC-32 bit by bit: a table of 256 registers, then the bytes of each distinct feature.
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TABLE = """(SELECT list(list_reduce(range(8), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END, n) ORDER BY n)
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n))"""
_STEP = "xor(a // 256, k[xor(a % 256, ('0x' || substr(x, 2 * b + 1, 2))::BIGINT) + 1])"


def _features(name: str, rows: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT doc, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
    FROM (SELECT doc, {_WORDS} AS w FROM ({rows})))"""


RESAMPLING = f"""
WITH {_features('d', 'SELECT doc_id AS doc, text FROM documents')}, {_features('b', 'SELECT item_id AS doc, text FROM benchmark')},
f AS MATERIALIZED (SELECT f, xor(list_reduce(range(len(x) // 2), lambda a, b: {_STEP}, 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket
    FROM (SELECT f, hex(f) AS x FROM (SELECT f FROM d UNION SELECT f FROM b)), (SELECT {_TABLE} AS k)),
s AS (SELECT bucket, count(*) AS s FROM d JOIN f USING (f) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM b JOIN f USING (f) GROUP BY bucket),
z AS (SELECT (SELECT count(*) FROM d)::DOUBLE AS all_s, (SELECT count(*) FROM b)::DOUBLE AS all_t),
g AS (SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)) / ((s + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), z),
w AS (SELECT doc, count(*) AS n, CAST(sum(gain) AS BIGINT) AS gain FROM d JOIN f USING (f) JOIN g USING (bucket) GROUP BY doc),
c AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce((gain - ((gain % n) + n) % n) // n, 0) AS weight, ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM documents LEFT JOIN w ON w.doc = doc_id),
e AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM c),
r AS (SELECT *, n_features >= 39 AS able, row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 39) OVER () AS all_able FROM e)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * all_able // 100 THEN place END AS rank FROM r
"""

ORACLES = {
    "op1_minhash": MINHASH,
    "op3_substring_dedup": SUBSTRINGS,
    "op6_line_dedup": LINES,
    "op7_decontamination": DECONTAMINATION,
    "op11_centroid_clustering": _centroids(),
    "op12_exact_dedup": COPIES,
    "op13_importance_resampling": RESAMPLING,
}
