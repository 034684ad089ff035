"""Source divergence audit against counting every term of every document."""

import re
from collections import Counter, defaultdict

import pytest

from tickloom.llm import sourceaudit

from .cases import DOCS, awkward, clashing


def brute(rows, least, top):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))) for _, text, lang, source, _ in rows]
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for g, s in counts if g == lang]

        def share(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)}
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize(("least", "top"), [(1, 50), (2, 3), (99, 50)])
def test_awkward_rows_against_brute_force(spark, least, top):
    docs = awkward(spark)
    want = brute([tuple(r) for r in docs.collect()], least, top)
    assert result(sourceaudit.audit_sources(clashing(docs) if top == 3 else docs, least, top)) == want


def test_long_and_nested_terms(spark):
    """Terms that are prefixes of each other, at the lengths of prefixes, cut inside a character, and very long ones."""
    words = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "é", "éé", "aé", "abé", "x" * 5_000, "x" * 5_001, "ABCD", "ÀÉ"]
    rows = [(i, " ".join(words[i % 5 :]), "en", f"s{i % 3}", 1) for i in range(12)] + [(99, "abcd1abcd", "en", "s0", 1), (100, "abcd", "de", "s9", 1)]
    assert result(sourceaudit.audit_sources(spark.createDataFrame(rows, DOCS), 3)) == brute(rows, 3, 50)


def test_counts_are_handed_on_early():
    held = sourceaudit._Held()
    assert held.add("en", "s", [b"y" * 10_000]) and not sourceaudit._Held().add("en", "s", [b"y"])
    assert {b.column("level")[0].as_py() for b in held.hand_on()} == {*range(14), sourceaudit.OCCURRENCES} and not held.nodes


def test_interleaved_sources_are_counted_together(spark, monkeypatch):
    """Eight tasks read documents of all eight sources: without dealing them by source, each hands on every source's terms."""
    word = lambda s, i: "".join(chr(97 + int(x)) for x in f"{s}{i:03}")
    rows = [(i, " ".join(word(i % 8, (i + j) % 100) for j in range(60)), "en", f"s{i % 8}", 1) for i in range(640)]
    docs, handed_on, durable = spark.createDataFrame(rows, DOCS).repartition(8), [], sourceaudit.durable

    def counted(df, name):
        out = durable(df, name)
        if name == "prefix-counts":
            handed_on.append(out.where(f"level = {sourceaudit.OCCURRENCES}").count())
        return out

    monkeypatch.setattr(sourceaudit, "durable", counted)
    assert result(sourceaudit.audit_sources(docs, 3)) == brute(rows, 3, 50)
    assert 800 <= handed_on[0] <= 2 * 800, handed_on  # a row for each source and term, twice for a source that two tasks share


def test_levels_of_whole_terms():
    for n in range(1, 70):
        assert sourceaudit.whole_level(b"x" * n) == next(k for k in range(9) if sourceaudit.prefix_bytes(k) >= n)


def test_empty_table(spark):
    assert sourceaudit.audit_sources(awkward(spark).limit(0)).count() == 0
