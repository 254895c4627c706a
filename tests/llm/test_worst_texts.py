"""Scans take time in proportion to a text's length, whatever the text: each rule against texts that nearly match it."""

from __future__ import annotations

import time
from re import _constants as C
from re import _parser

import pytest

from gridlake.llm import licenses, secrets
from tests.llm.test_license_gate import alternatives


def _seconds(work) -> float:
    began = time.perf_counter()
    work()
    return time.perf_counter() - began


# Texts whose every part begins a match that can't be completed, or begins one inside another.
NEARLY = {
    "assign": ["token ", "token=", "api_key" + " " * 50, "password'  :  '", "secretsecret"],
    "access": ["AKIA", "AKIAa", "AKI"],
    "hex": ["0123456789abcdef0123456-", "abcdef0123456789" * 2 + "g"],
    "private_key": ["-----BEGIN ", "-----BEGIN RSA PRIVATE KEY", "-"],
    "github": ["ghp_", "ghp_" + "a" * 35 + "-", "gho_ghp"],
    "slack": ["xoxb-", "xoxb-aaaa ", "xoxxox"],
    "google": ["AIza", "AIza" + "a" * 34 + "."],
    "stripe": ["sk_live_", "sk_live_" + "a" * 15 + " "],
    "jwt": ["eyJ-eyJabcdefgh", "eyJabcdefgh.", "eyJabcdefgh.eyJabcdefgh", "-eyJ", "eyJabcdefgh.eyJabcdefgh.é"],
    "url_login": ["a://", "http://a:", "a.b-c+", "ftp://user:pw", "x" * 64 + ":"],
}


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_secret_rules_on_a_megabyte(rule):
    regex = rule.compiled()
    for part in [*NEARLY[rule.kind], "a", "-", " ", "é"]:
        text = part * (1_000_000 // len(part))
        assert _seconds(lambda text=text: sum(1 for _ in regex.finditer(text))) < 3, part


def test_secret_scan_of_long_texts(spark):
    texts = [(i, part * (1_000_000 // len(part))) for i, part in enumerate(p for parts in NEARLY.values() for p in parts)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert _seconds(lambda: secrets.scan(df).selectExpr("sum(size(findings))").collect()) < 60


def test_tokens_in_a_run_are_found(spark):
    """Three parts after any other character than those of a token's alphabet."""
    part = "eyJabcdefghij"
    found = lambda t: [(m.start(), m.end()) for m in next(r for r in secrets.RULES if r.kind == "jwt").compiled().finditer(t)]
    assert found(f"x={part}.{part}.sigsigsig ") == [(2, 2 + 13 + 1 + 13 + 1 + 9)]
    assert found(f"{part}.{part}.{part}.{part}") == [(0, 41)] and found(f"{part}.{part}") == []


def _longest_prefixes(rule: licenses.Signature) -> list[str]:
    """Beginnings of what a rule matches, and the whole ended by another letter: nearly matches."""
    out = []
    for text in sorted(alternatives(rule), key=len)[-3:]:
        words = text.split(" ")
        out += [" ".join(words[:-1]) or text[:-1], text + "é", " ".join([*words[:-1], words[-1] * 3 + "é"])]
    return out


def test_license_rules_on_long_texts(spark):
    """20 KB of each nearly matching text, and of each alternative without its last words again and again: 20 MB in all."""
    rows = []
    for rule in licenses.signatures():
        parts = _longest_prefixes(rule)
        rows += [((part + " ") * (20_000 // (len(part) + 1)),) for part in parts[:2]] + [(" ".join(parts) + " " + "a" * 10_000 + "é",)]
    df = spark.createDataFrame([(i, t) for i, (t,) in enumerate(rows)], "doc_id long, text string").repartition(4)
    assert _seconds(lambda: licenses.scan(df).selectExpr("sum(size(found))").collect()) < 120


@pytest.mark.parametrize("word", ["a" * 1_000_000 + "é", "a" * 150 + "é " + "b" * 150 + "é", ("c" * 500 + "é ") * 1000, "SPDX-License-Identifier: " * 20_000, "mit-" * 200_000])
def test_identifier_line_with_a_long_word(spark, word):
    """A license identifier followed by long words that aren't plain letters: scanned in seconds, in the JVM."""
    df = spark.createDataFrame([(1, f"SPDX-License-Identifier: {word} end"), (2, "SPDX-License-Identifier: MIT\nx")], "doc_id long, text string")
    got = {}
    assert _seconds(lambda: got.update({r.doc_id: [f.label for f in r.found] for r in licenses.scan(df).collect()})) < 30
    assert "spdx" in got[2]


def test_no_rule_repeats_an_open_repeat():
    """The shape that backtracks without bound: a repeat without an upper limit inside another repeat."""

    def nested(tree, inside=False):
        for op, value in tree:
            if op in (C.MAX_REPEAT, C.MIN_REPEAT):
                low, high, inner = value
                if inside and high is C.MAXREPEAT:
                    return True
                if nested(inner, inside or high is C.MAXREPEAT or high > 1):
                    return True
            elif op is C.BRANCH and any(nested(b, inside) for b in value[1]) or op is C.SUBPATTERN and nested(value[3], inside):
                return True
        return False

    assert [r.label for r in licenses.signatures() if nested(_parser.parse(r.pattern))] == []
    assert [r.kind for r in secrets.RULES if nested(_parser.parse(r.pattern))] == []
