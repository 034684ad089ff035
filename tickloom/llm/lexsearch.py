"""Ranked lexical search: the best documents for each of a set of items, through FP-trees of documents.

Items come in blocks of a bounded number of terms. For each block one pass over the texts writes every document's term vector restricted to
the block's terms; counts over all documents follow from these vectors. A task then orders its documents' vectors by document frequency and
lays them into tries, where documents with the same frequent terms share a path. A node knows the largest tf of each term and the smallest m
below it, which bound the score of any document there, so an item's search goes down the best branches first and leaves out those that can't
reach its list. Each task hands on a list for each item; lists are merged by item.

No document vector is shuffled: what moves is a list of the best documents for each item and task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, durable, remove

#: Documents in an item's result; pairs of an item and a term in a block, on average.
TOP, BLOCK_TERMS = 50, 200_000
#: Entries of the vectors of one trie, about; documents below a node that are scored without going further down.
TREE_ENTRIES, LEAF = 1_000_000, 64

#: A term, for Spark and for bytes (A-Z lower-cased, a space for what belongs to no term), and the parts of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FULL, TF_PART, M_PART = 1_000_000_000, 1_000, 20

_FOUND = "item int, doc_id long, score long"
#: Of rows without an id: they come after all others of their score.
_NO_ID = np.iinfo(np.int64).max


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``: the different terms of each item."""
    low = F.translate(col(items, "text", "string"), _UPPER, _LOWER)
    return items.select(col(items, "item_id", "long").alias("item_id"), F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)))).alias("term")).distinct()


def restricted_vectors(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, ids, tfs`` of each row of ``docs`` with a term: its number of terms, and those of ``places`` with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, n, ids, tfs = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                terms = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()
                if terms:
                    own = Counter(t for t in map(places.get, terms) if t is not None)
                    rows.append(i)
                    n.append(len(terms))
                    ids.append(list(own))
                    tfs.append(list(own.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "ids", "tfs"])

    return docs.select(col(docs, "doc_id", "long").alias("doc_id"), col(docs, "text", "string").alias("text")).mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<int>")


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's weight is multiplied by; grows with tf, falls with m."""
    return (FULL * tf) // (TF_PART * tf + M_PART * m)


class _Entries:
    """Rows of (term, impact) pairs, one after the other."""

    def __init__(self, terms: np.ndarray, impacts: np.ndarray, at: np.ndarray) -> None:
        self.terms, self.impacts, self.at = terms, impacts, at

    def score(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.terms] * self.impacts, self.at) if len(self.terms) else np.zeros(len(self.at), np.int64)


class _Node:
    """A trie node: ``bounds`` has a row for each child; a leaf has none, and its documents are those from ``low`` to ``high``."""

    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high
        self.children: list[_Node] = []
        self.bounds: _Entries | None = None
        self.leaf: _Entries | None = None


class DocumentTree:
    """An FP-tree of documents' vectors: ``ends[i]`` is where document i's entries end in ``terms`` (numbered by falling document frequency)
    and ``tfs``; every document has at least one."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        order = np.lexsort((terms, doc))
        terms, tfs = terms[order], tfs[order]
        starts = np.concatenate([[0], ends[:-1]])
        spelled = terms.astype(">u4").tobytes()  # big-endian, so that bytes are in the order of terms
        keys = [spelled[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        by = sorted(range(len(keys)), key=lambda i: (keys[i], i))
        lengths = (ends - starts)[by]
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(starts[by] - self.at[:-1], lengths) + np.arange(self.at[-1])
        self.terms, self.tfs, self.m, self.ids, self.no_id = terms[take], tfs[take], m[by], ids[by], no_id[by]
        self.impacts = impact(self.tfs, np.repeat(self.m, lengths))
        self.root = _Node(0, len(by))
        self._grow()

    def _grow(self) -> None:
        order, stack = [], [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            order.append(node)
            while node.high - node.low > LEAF:
                at = self.at[node.low : node.high] + depth
                over = at < self.at[node.low + 1 : node.high + 1]
                following = np.where(over, self.terms[np.minimum(at, len(self.terms) - 1)], -1)  # -1: the path ends here
                cuts = node.low + np.flatnonzero(np.diff(following, prepend=following[0] - 1))
                if len(cuts) > 1:
                    node.children = [_Node(a, b) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), node.high], strict=True)]
                    # documents whose path ends are scored here; the others share a longer path
                    stack += [(c, depth + 1) for c, next_ in zip(node.children, following[cuts - node.low].tolist(), strict=True) if next_ >= 0]
                    order += [c for c, next_ in zip(node.children, following[cuts - node.low].tolist(), strict=True) if next_ < 0]
                    break
                if following[0] < 0:  # copies of one vector
                    break
                depth += 1
        most: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        for node in reversed(order):  # children before their parents
            if node.children:
                parts = [most.pop(id(c)) for c in node.children]
                lengths, low = np.array([len(t) for t, _, _ in parts]), np.array([x for *_, x in parts])
                terms, tfs = np.concatenate([t for t, _, _ in parts]), np.concatenate([f for _, f, _ in parts])
                node.bounds = _Entries(terms, impact(tfs, np.repeat(low, lengths)), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
            else:
                a, b = self.at[node.low], self.at[node.high]
                terms, tfs, low = self.terms[a:b], self.tfs[a:b], self.m[node.low : node.high]
                node.leaf = _Entries(terms, self.impacts[a:b], self.at[node.low : node.high] - a)
            by = np.argsort(terms, kind="stable")
            first = np.flatnonzero(np.diff(terms[by], prepend=-1))
            most[id(node)] = terms[by][first], np.maximum.reduceat(tfs[by], first), int(low.min())

    def search(self, weights: np.ndarray, best: Best) -> None:
        """Adds to ``best`` the documents that belong to it, by depth-first branch and bound."""
        stack = [(best.least, self.root)]
        while stack:
            bound, node = stack.pop()
            if bound < best.least:
                continue
            if node.leaf is not None:
                scores = node.leaf.score(weights)
                own = np.flatnonzero(scores >= best.least)
                if len(own):
                    best.add(scores[own], self.ids[node.low + own], self.no_id[node.low + own])
                continue
            bounds = node.bounds.score(weights)
            for c in np.argsort(bounds, kind="stable").tolist():  # the best branch last, to be taken first
                if bounds[c] >= best.least:
                    stack.append((int(bounds[c]), node.children[c]))


class Best:
    """The ``top`` highest scores above 0, equal ones by id, rows without an id last."""

    def __init__(self, top: int) -> None:
        self.top, self.least = top, 1
        self.scores, self.ids, self.no_id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        scores, ids, no_id = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.no_id, no_id])
        by = np.lexsort((ids, no_id, -scores))[: self.top]
        self.scores, self.ids, self.no_id = scores[by], ids[by], no_id[by]
        if len(by) == self.top:
            self.least = int(self.scores[-1])


def search_vectors(vectors: DataFrame, rank_of: np.ndarray, items: list[tuple[np.ndarray, np.ndarray]], top: int) -> DataFrame:
    """``item, doc_id, score``: each task's best rows of ``vectors`` (doc_id, m, ids, tfs) for each of ``items`` (ranks of terms, weights)."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[DocumentTree]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("ids").flatten())
            if size >= TREE_ENTRIES:
                yield tree(held)
                held, size = [], 0
        if size:
            yield tree(held)

    def tree(held: list[pa.RecordBatch]) -> DocumentTree:
        column = lambda name: pa.concat_arrays([b.column(name) for b in held])
        ids, doc_ids = column("ids"), column("doc_id")
        ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        return DocumentTree(ends, rank_of[ids.flatten().to_numpy()], column("tfs").flatten().to_numpy().astype(np.int64), column("m").to_numpy(), doc_ids.fill_null(_NO_ID).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, weights = [Best(top) for _ in items], np.zeros(len(rank_of), np.int64)
        for t in trees(batches):
            for own, (terms, weight) in zip(best, items, strict=True):
                weights[terms] = weight
                t.search(weights, own)
                weights[terms] = 0
        for k, own in enumerate(best):
            if len(own.ids):
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(k, pa.int32()), len(own.ids)), pa.array(own.ids, pa.int64(), mask=own.no_id), pa.array(own.scores)], ["item", "doc_id", "score"])

    return vectors.where(F.size("ids") > 0).select("doc_id", "m", "ids", "tfs").mapInArrow(run, _FOUND)


def _search_block(docs: DataFrame, own: list[tuple[int | None, str]], top: int) -> DataFrame:
    """The result of one block of (item_id, term) pairs, which is bounded."""
    spark = docs.sparkSession
    places = {t: i for i, t in enumerate(sorted({t for _, t in own}))}
    vectors = durable(restricted_vectors(docs, {t.encode("utf-8", "surrogatepass"): i for t, i in places.items()}), "term-vectors")
    total = vectors.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    weight = F.floor(1000 * F.log((2 * F.lit(total.n).cast("double") + 2) / (2 * F.col("df") + 1)))
    # a row for each term of the block
    known = vectors.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("df")).select("id", "df", weight.alias("w")).collect()
    rank_of, weights = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    for rank, r in enumerate(sorted(known, key=lambda r: (-r.df, r.id))):
        rank_of[r.id], weights[r.id] = rank, r.w
    terms_of: dict[int | None, list[int]] = {}
    for item, term in own:
        terms_of.setdefault(item, []).append(places[term])
    occurring = {r.id for r in known}
    queries = [(item, np.array([i for i in ids if i in occurring], np.int64)) for item, ids in terms_of.items()]
    m = F.lit(50) + F.call_function("div", F.lit(50).cast("decimal(2,0)") * F.col("n").cast("decimal(17,0)") * F.lit(total.n).cast("decimal(18,0)"), F.lit(total.l).cast("decimal(19,0)"))
    found = durable(search_vectors(vectors.withColumn("m", m.cast("long")), rank_of, [(rank_of[ids], weights[ids]) for _, ids in queries], top), "best-by-task")
    remove(spark, *{f.rsplit("/", 1)[0] for f in vectors.inputFiles()})
    names = spark.createDataFrame([(k, item) for k, (item, _) in enumerate(queries)], "item int, item_id long")
    w = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    merged = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return merged.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a row for each item of the block


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item of ``items`` (item_id, text) the ``top`` rows of ``docs`` (doc_id, text) with the highest
    scores above 0, equal scores by doc_id (null last).

    Null and empty texts and items without terms are in no result; items of the same id are one item with the terms of all; repeated
    documents are ranked each; other columns don't matter; empty tables give an empty result.
    """
    pairs = durable(item_terms(items), "item-terms")
    blocks = -(-pairs.count() // block_terms)
    out = None
    for k in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else pairs
        found = _search_block(docs, [(r.item_id, r.term) for r in own.orderBy("item_id", "term").collect()], top)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
