"""MinHash near-duplicates by tensored banding, with every link confirmed on the full shingle sets.

Two collections of ``SIDE`` half keys, each made of two minima, are combined to ``SIDE * SIDE`` table keys, so 4 * SIDE minima do the
work of SIDE * SIDE * 4. At a similarity of 0.75 a half key agrees with probability 0.5625, and a pair shares no table with probability
below 2 * 0.4375 ** SIDE, about 4e-6 for 16.

Texts with equal shingle sets are one class from the start. Half keys that no other class has are dropped before tables are formed,
and buckets with the same members count once. Within buckets no group of pairs is formed: rounds compare each class with one pivot of
its bucket, and only what is still in another component than the pivot; components are contracted between rounds. What rounds can't
settle (buckets that hold unlinked classes) is compared class by class across components, so that no link is lost, but for pairs that
their rare shingles rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SIMILAR, WordHashes, col, durable, mix, shingles, small

SIDE = 16
MINIMA = 4 * SIDE
_RNG = np.random.default_rng(75)
_XOR = _RNG.integers(0, 2**63, MINIMA, dtype=np.uint64)
_ODD = (_RNG.integers(0, 2**63, MINIMA, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
#: Of the 64 two-bit digests of minima so many agree for a similar pair but once in 10 million: at 0.75, 52 do, with a deviation of 3.1.
AGREE = 36
#: Classes, of those compared last, that have a rare shingle at most.
RARE = 8
#: Classes of one half key, of those compared last, that one task compares with all others of it.
TOGETHER = 256
#: Rounds with pivots, at most; then the rest is compared directly.
ROUNDS = 8
_ROW = "doc_id long, t long, n long, f1 long, f2 long, half array<long>, s1 long, s2 long"


def minima(hashes: np.ndarray) -> np.ndarray:
    """The 32-bit minima of a shingle set under all hash functions."""
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        x = (hashes[i : i + 2048, None] ^ _XOR) * _ODD
        out = np.minimum(out, (x ^ (x >> np.uint64(29))).min(0))
    return out >> np.uint64(32)


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of hashes, in any order."""
    with np.errstate(over="ignore"):
        a, b = mix(hashes ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(hashes + np.uint64(0xD1B54A32D192ED03)), initial=np.uint64(len(hashes)))
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, t, text): id, size and fingerprint of its shingle set, its half keys, and two bits of each minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                h = shingles(text, seen)
                if not len(h):
                    rows.append((0, 0, 0, None, 0, 0))
                    continue
                m = minima(h)
                half = _signed((m[0::2] << np.uint64(32)) | m[1::2])
                s1, s2 = _signed(np.array([(weights * (m & np.uint64(1))).sum(dtype=np.uint64), (weights * ((m >> np.uint64(1)) & np.uint64(1))).sum(dtype=np.uint64)]))
                rows.append((len(h), *fingerprint(h), half.tolist(), int(s1), int(s2)))
            c = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), *(pa.array(x, k) for x, k in zip(c, kinds, strict=True))], ["doc_id", "t", "n", "f1", "f2", "half", "s1", "s2"])

    return docs.mapInArrow(run, _ROW)


def table_rows(classes: DataFrame) -> DataFrame:
    """``(key, node, n, s1, s2)``: the tables that each class shares with another."""
    flat = classes.select("node", F.posexplode("half").alias("i", "k"))
    shared = flat.groupBy("i", "k").agg(F.count("*").alias("c")).where("c > 1").select("i", "k")
    kept = flat.join(shared, ["i", "k"]).groupBy("node").agg(F.collect_list(F.struct("i", "k")).alias("h"))  # at most 2 * SIDE of a class
    pick = lambda first: F.filter("h", lambda x: (x["i"] < SIDE) if first else (x["i"] >= SIDE))
    keyed = kept.select("node", F.explode(pick(True)).alias("a"), pick(False).alias("bs")).select("node", "a", F.explode("bs").alias("b")).select("node", F.xxhash64("a", "b").alias("key"))
    stats = keyed.groupBy("key").agg(F.count("*").alias("c"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y")).where("c > 1")
    once = stats.groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key")  # buckets with the same members
    return keyed.join(once, "key").join(classes.select("node", "n", "s1", "s2"), "node")


def shingle_rows(texts: DataFrame) -> DataFrame:
    """``(h, node)``: the shingles of each text of ``texts`` (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
                h = shingles(text, seen)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), node, np.int64))], ["h", "node"])

    return texts.select("node", "text").mapInArrow(run, "h long, node long")


def last_pairs(open_: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``(a, b)``: every pair of classes that share a bucket, are in two components, and may be similar.

    Shingles that at most RARE of these classes have are rare. Pairs that share a rare one are read from its short list; for all others
    neither's rare shingles are in the intersection, and the union has all of both, which leaves few of a large group of loose copies.
    Classes share a table if they agree in a half key of either collection; they meet in the first of one that they agree in, so each pair
    comes once. A half key that many classes have is dealt to several tasks: each takes some of the classes on one side, and all on the other.
    """
    nodes = open_.select("node", "comp", "n", "s1", "s2").distinct()
    rows = durable(shingle_rows(texts.join(nodes.select("node"), "node", "left_semi")), "shingles")
    few = rows.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") <= RARE)
    rare = durable(rows.join(few, "h"), "rare")
    counts = rare.groupBy("node").agg(F.count("*").alias("u"))
    lists = rare.where("c > 1").groupBy("h").agg(F.array_sort(F.collect_list("node")).alias("ns")).select("ns").distinct()  # at most RARE in each
    listed = lists.select(F.explode("ns").alias("a"), "ns").select("a", F.explode("ns").alias("b")).where("a < b").distinct()
    side = lambda x: nodes.select(F.col("node").alias(x), F.struct("comp", "n", F.lit(0).alias("u"), "s1", "s2").alias(f"_{x}"))
    listed = listed.join(side("a"), "a").join(side("b"), "b").where((F.col("_a.comp") != F.col("_b.comp")) & comparable(F.col("_a"), F.col("_b"))).select("a", "b")
    known = nodes.join(counts, "node", "left").withColumn("u", F.coalesce("u", F.lit(0))).where((F.col("n") - F.col("u")) * SIMILAR[1] >= F.col("n") * SIMILAR[0])
    known = known.join(classes.select("node", F.slice("half", 1, SIDE).alias("first"), F.slice("half", SIDE + 1, SIDE).alias("second")), "node")
    flat = durable(known.select("*", F.posexplode("first").alias("i", "k")), "last")
    shared = flat.groupBy("i", "k").agg(F.count("*").alias("c")).where("c > 1").select("i", "k", F.ceil(F.col("c") / TOGETHER).cast("int").alias("parts"))
    flat = durable(flat.join(shared, ["i", "k"]), "last-shared")
    a = flat.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).alias("a")
    b = flat.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("b")
    near = comparable(F.struct("a.n", "a.u", "a.s1", "a.s2"), F.struct("b.n", "b.u", "b.s1", "b.s2"))
    agree = lambda c: F.zip_with(f"a.{c}", f"b.{c}", lambda x, y: x == y)
    once = (F.array_position(agree("first"), True) == F.col("a.i") + 1) & F.exists(agree("second"), lambda x: x)
    same = (F.col("a.i") == F.col("b.i")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.part") == F.col("b.part"))
    met = a.join(b, same & (F.col("a.node") < F.col("b.node")) & (F.col("a.comp") != F.col("b.comp")) & near & once)
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).unionByName(listed).distinct()


def comparable(a: Column, b: Column) -> Column:
    """Whether sizes and two-bit digests of the minima leave room for a similarity of 0.75; ``u`` counts shingles that are not in the other."""
    low, high = F.least(a["n"] - a["u"], b["n"] - b["u"]), F.greatest(a["n"] + b["u"], b["n"] + a["u"])
    differ = F.bit_count(a["s1"].bitwiseXOR(b["s1"]).bitwiseOR(a["s2"].bitwiseXOR(b["s2"])))
    return (low * SIMILAR[1] >= high * SIMILAR[0]) & (F.lit(64) - differ >= AGREE)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose full shingle sets have ``100 * |intersection| >= 75 * |union|``."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, last, own = WordHashes(), None, None
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                if y != last:
                    last, own = y, shingles(y, seen)
                other = shingles(x, seen)
                both = len(np.intersect1d(other, own, assume_unique=True))
                keep.append(SIMILAR[1] * both >= SIMILAR[0] * (len(other) + len(own) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    t = texts.select("node", "text")
    left = pairs.join(t.withColumnRenamed("node", "a").withColumnRenamed("text", "ta"), "a")
    both = left.join(t.withColumnRenamed("node", "b").withColumnRenamed("text", "tb"), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(linked, "a long, b long")


def contract(labels: DataFrame, links: DataFrame) -> DataFrame:
    """New ``(node, comp)``: components joined by ``links`` (a, b) between nodes, each named by its smallest member's name.

    Works on the graph of components that links join. In each round a vertex goes to its smallest neighbour's smallest neighbour, if that
    is smaller, and edges are renamed; a component has one name when none is left.
    """
    la, lb = labels.withColumnRenamed("node", "a").withColumnRenamed("comp", "ca"), labels.withColumnRenamed("node", "b").withColumnRenamed("comp", "cb")
    edges = links.join(la, "a").join(lb, "b").where("ca <> cb").select(F.least("ca", "cb").alias("u"), F.greatest("ca", "cb").alias("v")).distinct()
    edges = durable(edges, "edges")
    moved: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p"))
        parent = durable(parent, "parent")
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("now"))
        to = durable(parent.join(up, "p").select(F.col("u").alias("was"), "now"), "jump")
        if moved is None:
            moved = to
        else:
            later = to.select(F.col("was").alias("now"), F.col("now").alias("next"))
            moved = durable(moved.join(later, "now", "left").select("was", F.coalesce("next", "now").alias("now")), "moved")
        edges = durable(
            edges.join(to.select(F.col("was").alias("u"), F.col("now").alias("nu")), "u").join(to.select(F.col("was").alias("v"), F.col("now").alias("nv")), "v")
            .where("nu <> nv").select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v")).distinct(),
            "edges",
        )
    if moved is None:
        return labels
    return durable(labels.join(moved, labels["comp"] == moved["was"], "left").select("node", F.coalesce("now", "comp").alias("comp")), "comps")


def link_classes(members: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, comp)`` for the classes of ``members`` (key, node, n, s1, s2): connected components of the confirmed links."""
    counts = members.groupBy("node").agg(F.count("*").alias("tables"))
    labels = durable(counts.select("node", F.col("node").alias("comp")), "comps")
    members = durable(members.join(counts, "node"), "counted")
    tested: DataFrame | None = None
    before = None
    me = F.struct("n", F.lit(0).alias("u"), "s1", "s2")
    for turn in range(ROUNDS + 1):
        rows = members.join(labels, "node")
        sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
        per = sizes.groupBy("key").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("same"), F.count("*").alias("comps")).where("comps > 1")
        open_ = durable(rows.join(per.select("key"), "key"), "open")
        total = per.agg(F.sum((F.col("c") * F.col("c") - F.col("same")) / 2).alias("pairs"), F.sum("c").alias("rows")).first()
        if not total.rows:
            break
        last = turn == ROUNDS or total.pairs <= 2 * total.rows or (before is not None and total.pairs > 0.5 * before)
        before = total.pairs
        if last:
            pairs = last_pairs(open_, texts, classes)
        else:
            # first the class that is in most buckets, as what lies in the middle of a group is; then any
            order = F.struct("tables", F.xxhash64("node")) if not turn else F.xxhash64("node", F.lit(turn))
            pivot = open_.groupBy("key").agg(F.max_by(F.struct("node", "comp", "n", F.lit(0).alias("u"), "s1", "s2"), order).alias("pivot"))
            met = open_.join(pivot, "key").where((F.col("comp") != F.col("pivot.comp")) & comparable(me, F.col("pivot")))
            pairs = met.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = durable(pairs, "pairs")
        links = durable(confirmed(pairs, texts), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        labels = contract(labels, links)
        if last:
            break
    return labels


def linked_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, t, n, f1, f2, comp`` for every row of ``docs``: ``t`` is a hash of its text, ``comp`` names its component (null: no words)."""
    rows = _rows(docs)
    sketched = durable(sketches(rows), "sketches")
    found = sketched.where("n > 0")
    classes = found.groupBy("f1", "f2", "n").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t")).alias("rep"), F.any_value("half").alias("half"), F.any_value("s1").alias("s1"), F.any_value("s2").alias("s2"))
    classes = durable(classes.withColumn("node", F.xxhash64("f1", "f2", "n")).withColumn("rep", F.struct("rep.doc_id", "rep.t")), "classes")
    members = durable(table_rows(classes), "members")
    need = durable(members.select("node").distinct().join(classes.select("node", "rep.doc_id", "rep.t"), "node"), "needed")
    texts = durable(class_texts(rows, need), "texts")
    labels = link_classes(members, texts, classes)
    named = classes.join(labels, "node", "left").select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.coalesce("comp", "node").alias("comp"))
    cols = [c for c in sketched.columns if c not in ("half", "s1", "s2")]
    joined = found.select(cols).join(named, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2"))).select(*cols, "comp")
    return joined.unionByName(sketched.where("n = 0").select(*cols, F.lit(None).cast("long").alias("comp")))


def _rows(docs: DataFrame) -> DataFrame:
    text = col(docs, "text", "string")
    return docs.select(col(docs, "doc_id", "long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    A document's set: its distinct 5-word shingles; with fewer words the whole sequence as one; without words empty and linked with
    nothing (its component is itself). Rows with equal sets, repeated rows among them, are one class. ``component_id`` is the smallest
    id of a component; null ids are only taken where a component has no other. Very long texts are read whole. Empty table: empty result.
    """
    rows = durable(linked_rows(docs), "linked")
    least = rows.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = rows.where("n > 0").join(least, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def class_texts(rows: DataFrame, need: DataFrame) -> DataFrame:
    """``(node, text)``, one text for each class of ``need`` (node, doc_id, t): of a row with its smallest id, null if it has no other, and that row's text."""
    own = small(need.select("node", F.col("doc_id").alias("r"), F.col("t").alias("u")))
    return rows.join(own, (F.col("t") == F.col("u")) & F.col("doc_id").eqNullSafe(F.col("r"))).select("node", "text").dropDuplicates(["node"])


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, all columns: that with the smallest id (null last), then with the least hash of its text.

    A row is told by its id and text, so rows that share an id, or have none, are judged each on its own; of rows that repeat both, one
    stays. Rows without words all stay. The texts aren't shuffled while the rows that go are few enough to be sent to all tasks.
    """
    linked = durable(linked_rows(docs).where("n > 0").groupBy("comp", "doc_id", "t").agg(F.count("*").alias("times")), "linked")
    first = linked.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t")).alias("first"))
    judged = linked.join(first, "comp").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("t") == F.col("first.t")))
    gone = durable(judged.where("not stays or times > 1").select(F.col("doc_id").alias("_gone_id"), F.col("t").alias("_gone_t"), F.col("stays").alias("_again")), "gone")
    same = col(docs, "doc_id", "long").eqNullSafe(F.col("_gone_id")) & (F.xxhash64(col(docs, "text", "string")) == F.col("_gone_t"))
    kept = docs.join(small(gone), same, "left_anti")
    again = gone.where("_again")
    if again.isEmpty():
        return kept
    return kept.unionByName(docs.join(small(again), same, "left_semi").dropDuplicates([c for c in ("doc_id", "text") if c in docs.columns]))
