"""Plain versions of the operators, for small inputs."""

import math
import re
from collections import Counter, defaultdict
from hashlib import sha256


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = words(low(text))
    return frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()


def near_duplicates(rows, k, numerator):
    """{id: (size, component)} for rows of distinct ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders, common = defaultdict(list), Counter()
    for i, x in sets.items():
        for g in x:
            holders[g].append(i)
    for own in holders.values():
        for a in range(len(own)):
            for b in range(a):
                common[own[b], own[a]] += 1
    for (a, b), n in common.items():
        if 100 * n >= numerator * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def substring_dedup(rows, window):
    """{id: (n_words, n_removed, kept words)} for rows of distinct ids."""
    first = {}
    all_words = {i: words(t) for i, t in rows}
    for i, w in all_words.items():
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in all_words.items():
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                gone.update(range(j, j + window))
        out[i] = (len(w), len(gone), [x for j, x in enumerate(w) if j not in gone])
    return out


def secret_base(text):
    """Base spans of the contract: [(start, order, kind, end)]."""
    kinds = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    )
    return sorted((m.start(), n, kind, m.end()) for n, (kind, p, g, least) in enumerate(kinds) for m in p.finditer(text or "") if len(m[g]) >= least)


def quality_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    repeat = {j + d for j in range(len(w) - 4) if grams[tuple(w[j : j + 5])] > 1 for d in range(5)}
    failed = len(w) < 10 or 100 * len(repeat) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat), failed


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def license_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    places = [(j, label) for phrase, label in PHRASES.items() for j in range(len(w)) if w[j : j + len(phrase.split())] == phrase.split()]
    at = [j for j, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def digest(text):
    return sha256(text.encode()).hexdigest()


def line_dedup(rows, min_words=10):
    """{id: (text, lines with a word, removed ones)} for rows of distinct ids: later copies of line pairs and of long lines go."""
    seqs = {i: [(n, x) for n, x in enumerate((t or "").split("\n")) if words(x)] for i, t in rows}
    first, gone = {}, {i: set() for i in seqs}
    for i in sorted(seqs):
        for size in (1, 2):
            for p in range(len(seqs[i]) - size + 1):
                run = seqs[i][p : p + size]
                if first.setdefault(tuple(x for _, x in run), (i, p)) != (i, p) and (size == 2 or len(words(run[0][1])) >= min_words):
                    gone[i].update(n for n, _ in run)
    text = lambda i, t: t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])
    return {i: (text(i, t), len(seqs[i]), len(gone[i])) for i, t in rows}


def ftrl(rows, labels, order, size, alpha, beta, l1, l2):
    """Weights after visiting rows (lists of (feature, value)) in the given order, one number at a time."""
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)

    for r in order:
        w = {i: weight(i) for i, _ in rows[r]}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in rows[r])))
        for i, v in rows[r]:
            g = (p - labels[r]) * v
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
            n[i] += g * g
    return [weight(i) for i in range(size)]
