"""Ranked search against scoring every document for every item."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickloom.llm import lexsearch
from tickloom.llm.lexsearch import Best, DocumentTree, impact

from .cases import DOCS, awkward, clashing, passage

ITEMS = "item_id long, text string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top=50):
    docs = [(i, Counter(ts), len(ts)) for i, t in docs if (ts := terms(t))]
    n, total = len(docs), sum(k for *_, k in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    by_item = defaultdict(set)
    for i, t in items:
        by_item[i] |= set(terms(t))
    out = []
    for item, own in by_item.items():
        scored = []
        for doc, c, size in docs:
            m = 100 - 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("block", [lexsearch.BLOCK_TERMS, 40])
def test_awkward_rows(spark, block):
    docs = awkward(spark)
    items = [(1, "one two"), (2, None), (None, "Ba be 13 É spam"), (3, passage(1, 300)), (4, ""), (1, "one SPAM a"), (5, "nothing here occurs zzz"), (6, passage(6, 5000))]
    table = spark.createDataFrame(items, ITEMS)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], items, 3)
    assert got(lexsearch.search(docs, table, 3, block)) == want
    if block == 40:
        assert got(lexsearch.search(clashing(docs), clashing(table).withColumn("term", table.text), 3)) == want


def test_many_copies_and_ties(spark):
    rows = [(i % 700, f"alpha {'beta ' * (i % 3)} gamma{i % 7}", "en", "s", 1) for i in range(1500)] + [(None, "alpha beta", "en", "s", 1)] * 3
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    items = [(1, "alpha beta"), (2, "gamma1 gamma2"), (3, "beta")]
    assert got(lexsearch.search(docs, spark.createDataFrame(items, ITEMS))) == brute([(r[0], r[1]) for r in rows], items)


def test_empty_tables(spark):
    docs, items = awkward(spark), spark.createDataFrame([(1, "one two")], ITEMS)
    assert lexsearch.search(docs.limit(0), items).count() == 0
    assert lexsearch.search(docs, items.limit(0)).count() == 0
    assert lexsearch.search(docs, spark.createDataFrame([(1, "not in there")], ITEMS)).count() == 0


def test_tree_leaves_branches_out_and_loses_nothing(monkeypatch):
    r = np.random.default_rng(5)
    n, vocabulary = 4000, 120
    sizes = r.integers(1, 25, n)
    docs = [np.sort(r.choice(vocabulary, k, replace=False, p=(p := 1 / np.arange(1, vocabulary + 1)) / p.sum())) for k in sizes]
    docs[10:900] = [docs[10]] * 890  # copies
    ends = np.cumsum([len(d) for d in docs])
    flat = np.concatenate(docs)
    tfs, m, ids = r.integers(1, 4, len(flat)), r.integers(50, 400, n), r.permutation(n)
    tree = DocumentTree(ends, flat, tfs, m, ids, np.zeros(n, bool))
    scored = 0
    plain = lexsearch._Entries.score
    monkeypatch.setattr(lexsearch._Entries, "score", lambda self, w: (seen.append(len(self.at)), plain(self, w))[1])
    for _ in range(20):
        seen = []
        weights = np.zeros(vocabulary, np.int64)
        own = r.choice(vocabulary, 12, replace=False)
        weights[own] = r.integers(1, 9000, 12)
        best = Best(50)
        tree.search(weights, best)
        scores = np.add.reduceat(weights[flat] * impact(tfs, np.repeat(m, [len(d) for d in docs])), np.concatenate([[0], ends[:-1]]))
        by = [i for i in np.lexsort((ids, -scores)) if scores[i] > 0][:50]
        assert [(int(scores[i]), int(ids[i])) for i in by] == list(zip(best.scores.tolist(), best.ids.tolist(), strict=True))
        scored += sum(seen)
    assert scored < 20 * n
