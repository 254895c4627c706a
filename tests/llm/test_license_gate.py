"""The license scan's keyword prefilter lets every text through that a rule matches."""

from __future__ import annotations

import dataclasses
import re
import time
from itertools import product
from re import _constants as C
from re import _parser

from gridlake.llm import licenses


def texts_of(tree) -> list[str]:
    """All texts that a parsed pattern matches; of a set of characters more than three, one; of open repeats, the fewest."""
    parts = []
    for op, value in tree:
        if op is C.LITERAL:
            parts.append([chr(value)])
        elif op is C.ANY:
            parts.append(["a"])
        elif op is C.IN:
            chars = [chr(v) for k, v in value if k is C.LITERAL]
            parts.append(chars if len(chars) == len(value) else [chr(next(v[0] for k, v in value if k is C.RANGE))])
        elif op is C.BRANCH:
            parts.append([t for branch in value[1] for t in texts_of(branch)])
        elif op is C.SUBPATTERN:
            parts.append(texts_of(value[3]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, inner = value
            once = texts_of(inner)
            parts.append(["", *once] if (low, high) == (0, 1) else once)
        else:
            assert op is C.ASSERT, op
    return sorted({"".join(p) for p in product(*parts)})


def alternatives(rule: licenses.Signature) -> list[str]:
    found = [t for t in texts_of(_parser.parse(rule.pattern)) if re.fullmatch(rule.pattern[6:-5], t)]
    assert found
    return found


def test_every_alternative_holds_a_keyword():
    lost = {}
    for rule in licenses.signatures():
        missed = [t for t in alternatives(rule) if not any(f" {k}" in f" {t} " for k in rule.keywords)]
        if missed:
            lost[rule.label] = missed[:3]
    assert lost == {}
    assert len(licenses.signatures()) > 350 and len((licenses.GRANTS + licenses.NOTICES).strip().splitlines()) > 140


def test_prefix_expression():
    words = ["gpl", "gnu org", "g", "apache", "asl", "a b"]
    found = re.compile(" " + licenses._any_prefix(words))
    for text in (" gp", " g", " asl", " as", "apache", " x a", " a bc", ""):
        assert bool(found.search(text)) == any(f" {w}" in text for w in words)


def test_long_texts_take_seconds(spark):
    """A megabyte of one phrase, of a name and of whole notices: every place is found, in time that grows with the text."""
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction. "
    texts = ["cc by " * 170_000, "GPL version 2 or later, " * 45_000, notice * 5_000]
    docs = spark.createDataFrame([(-1, "cc by")] + list(enumerate(texts)), "doc_id long, text string")
    licenses.scan(docs.where("doc_id < 0")).collect()
    began = time.perf_counter()
    rows = licenses.scan(docs).selectExpr("doc_id", "size(base) n", "try_element_at(base, -1).word at", "size(found) found", "transform(slice(found, 1, 2), f -> f.label) labels", "try_element_at(found, -1).finish finish").collect()
    assert time.perf_counter() - began < 60
    got = {r.doc_id: tuple(r)[1:] for r in rows}
    assert got[0] == (170_000, 339_998, 170_000, ["cc-by", "cc-by"], 340_000)
    assert got[1] == (0, None, 45_000, ["gpl-2-or-later"] * 2, 225_000)
    assert got[2] == (0, None, 5_000, ["mit", "mit"], 5_000 * len(notice.split()))


def test_scan_with_and_without_the_gate(spark):
    rules = licenses.signatures()
    open_rules = tuple(dataclasses.replace(r, keywords=("",)) for r in rules)
    texts = {"MPLv2.0", "EPLv2", "OSLv3", "AFLv3", "ZPLv2.1", "OFLv1.1", "BSLv1", "ASL 2.0", "ASLv2", "CC Attribution 4.0", "oslo and mples"}
    for rule in rules:
        every = alternatives(rule)
        texts |= {every[0], every[-1], min(every, key=len), max(every, key=len)} | {t for t in every if re.search(r"[a-z0-9]v\d", t)}
    docs = spark.createDataFrame(list(enumerate(sorted(texts))), "doc_id long, text string")
    gated = {r.doc_id: r.found for r in licenses.scan(docs, rules).collect()}
    ungated = {r.doc_id: r.found for r in licenses.scan(docs, open_rules).collect()}
    assert gated == ungated
    labels = {text: {f.label for f in gated[i]} for i, text in enumerate(sorted(texts))}
    assert labels["MPLv2.0"] == {"mpl-2"} and labels["ASL 2.0"] == {"apache-2"} and labels["CC Attribution 4.0"] == {"cc-by-4.0"}
    assert labels["oslo and mples"] == set()
