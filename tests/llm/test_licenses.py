"""License rules against every rule run on every text, with each pair of detections compared."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from tickloom.llm import licensescan
from tickloom.llm.licensescan import Rule, rules

from .cases import SF, awkward, clashing

TEXTS = {
    "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "// SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0-or-later",
    "see https://www.gnu.org/licenses/gpl-3.0.html": "gpl-3.0",
    "http://www.apache.org/licenses/LICENSE-2.0": "apache-2.0",
    "under the GNU Lesser General Public License, version 2.1 or (at your option) any later version": "lgpl-2.1-or-later",
    "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software": "mit",
    "three-clause BSD license; all rights reserved": "all-rights-reserved,bsd-3-clause",
    "Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported": "cc-by-nc-sa-3.0",
    "submit licenses to the apache": "",
    "gnu general public licensed": "",
}


PATTERNS = [re.compile(f"(?<= )(?:{r.pattern})(?= )") for r in rules()]


def brute(text):
    """All rules without keywords, all pairs of detections."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    line = " " + " ".join(words) + " "
    found = [(m.start(), m.end(), r.priority, k, r) for k, r in enumerate(rules()) for m in PATTERNS[k].finditer(line)]

    def beats(x, y):
        inside = x[0] <= y[0] and y[1] <= x[1]
        return inside and (x[2], -(x[1] - x[0]), x[3]) < (y[2], -(y[1] - y[0]), y[3])

    kept = [y for y in found if not any(beats(x, y) for x in found)]
    places = {label: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p, label in licensescan.PHRASES.items()}
    at = [i for own in places.values() for i in own]
    base = sorted(k for k, own in places.items() if own)
    score = max([licensescan.PHRASE_SCORE if base else 0.0, *(y[4].score for y in kept)])
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(base), ",".join(sorted({y[4].label for y in kept} | set(base))), score


def test_known_texts():
    assert len(rules()) > 300
    for text, labels in TEXTS.items():
        assert licensescan.scan(text)[5] == labels, text
        assert licensescan.scan(text) == brute(text)


def test_every_match_holds_a_keyword():
    """A text made of a rule's own pattern is found through its keywords."""
    for text in TEXTS:
        for r, pattern in zip(rules(), PATTERNS, strict=True):
            for m in pattern.finditer(licensescan.normal(text)[1]):
                assert any(k in f" {m[0]} " for k in r.keywords), r
    assert all(isinstance(r, Rule) and r.keywords and 0 <= r.score <= 1 for r in rules())


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def test_query_against_brute_force(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op12_license_scan"](spark, SF).collect()}
    assert got == {i: brute(t) for i, t in texts.items()}


def test_mixed_and_long_texts():
    mixed = " ".join(TEXTS) * 3
    assert licensescan.scan(mixed) == brute(mixed)
    many = "mit license gnu general public license version 2 " * 20_000
    n, base, first, last, *_ = licensescan.scan(many)
    assert (n, base, first, last) == (160_000, 40_000, 0, 159_994)
    assert licensescan.scan("é" * 2_000_000)[0] == 1


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = licensescan.scan_licenses(docs).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in docs.collect())
    assert {tuple(r)[1:] for r in out if r.doc_id in (4, 5, 6)} == {(0, 0, None, None, "", "", 0.0)}
    assert sorted(map(repr, licensescan.scan_licenses(clashing(docs)).collect())) == sorted(map(repr, out))
    assert licensescan.scan_licenses(docs.limit(0)).count() == 0
