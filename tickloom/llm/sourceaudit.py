"""Source divergence audit: which terms, and which other sources, a language's sources differ in; terms by iceberg prefix refinement.

Documents are dealt by language and source, so that a task meets the same terms again and again; a source larger than a task goes to several.
One pass over the texts then counts, for each task, the documents that hold each byte prefix of 2, 4, 8, ... bytes and each whole term, and the
occurrences of each term by source: a document lies in one task, so its prefixes are told apart there and the tasks' counts add up. These
partial counts, as large as the tasks' vocabularies and not as the texts, are written once. Refinement then goes level by level over them:
a prefix or term is counted only if the prefix above it is still in, and stays in if enough documents hold it, until no prefix is left to
extend. What remains are the terms that enough documents of their language hold; only their occurrences are joined and compared.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, durable, remove, small

#: Documents of its language that a kept term is in, at least; ranks of a source's terms.
LEAST_DOCS, TOP_TERMS = 30, 50
#: Added to every count; parts that shares are told in.
PRIOR, SCALE = 5, 1_000_000_000
#: Different prefixes and terms that a task counts before it hands on its counts; a term of so many bytes is handed on at once.
HELD, LONG = 400_000, 4_096
#: Rows of a table that is sent to all tasks, at most.
SENT_ROWS = 200_000
#: The level of a row that counts a source's occurrences of a term.
OCCURRENCES = -1

#: What bytes become: A-Z lower-case, and a space for every byte of ASCII that is no letter.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_COUNTS = "level int, lang string, source string, node binary, whole boolean, n long"


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and of all that isn't ASCII, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def prefix_bytes(level: int) -> int:
    """Bytes of a prefix of ``level``: 2, 4, 8, ..."""
    return 2 << level


def whole_level(term: bytes) -> int:
    """The level of a whole term: the first whose prefixes are not shorter."""
    return max(0, (len(term) - 1).bit_length() - 1)


class _Held:
    """Counts that a task has not handed on yet."""

    def __init__(self) -> None:
        self.nodes: dict[tuple[int, str], Counter] = defaultdict(Counter)
        self.whole: dict[str, Counter] = defaultdict(Counter)
        self.terms: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def add(self, lang: str, source: str, words: list[bytes]) -> bool:
        """Counts a document; True if it is time to hand on."""
        self.terms[lang, source].update(words)
        found = set(words)
        self.whole[lang].update(found)
        level, size = 0, prefix_bytes(0)
        while longer := [w for w in found if len(w) > size]:
            self.nodes[level, lang].update({w[:size] for w in longer})
            level, size, found = level + 1, prefix_bytes(level + 1), longer
        return 2 * size > LONG or sum(len(c) for held in (self.nodes, self.whole, self.terms) for c in held.values()) > HELD

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        for (level, lang), counts in self.nodes.items():
            yield _batch(level, lang, None, False, counts)
        for lang, counts in self.whole.items():
            levels: dict[int, dict[bytes, int]] = defaultdict(dict)
            for term, n in counts.items():
                levels[whole_level(term)][term] = n
            for level, found in levels.items():
                yield _batch(level, lang, None, True, found)
        for (lang, source), counts in self.terms.items():
            if counts:
                yield _batch(OCCURRENCES, lang, source, True, counts)
        for held in (self.nodes, self.whole, self.terms):
            held.clear()


def _batch(level: int, lang: str, source: str | None, whole: bool, counts: dict[bytes, int]) -> pa.RecordBatch:
    n = len(counts)
    same = lambda x, kind: pa.repeat(pa.scalar(x, kind), n)
    arrays = [same(level, pa.int32()), same(lang, pa.string()), same(source, pa.string()), pa.array(counts.keys(), pa.binary()), same(whole, pa.bool_()), pa.array(counts.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _COUNTS.split(", ")])


def side_by_side(docs: DataFrame) -> DataFrame:
    """``docs`` dealt so that a task has documents of few sources, whose terms repeat; a large source, or one of copies, is cut into several tasks."""
    return docs.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange("lang", "source", "_at").drop("_at")


def partial_counts(docs: DataFrame) -> DataFrame:
    """``level, lang, source, node, whole, n`` of tasks: documents by prefix (or whole term) and language, occurrences by term and source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                if held.add(lang.as_py(), source.as_py(), terms_of(text.as_py())):
                    yield from held.hand_on()
        yield from held.hand_on()

    return docs.select("lang", "source", "text").mapInArrow(run, _COUNTS)


def kept_terms(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``lang, term``: the terms in at least ``least`` documents of their language, by prefix refinement over ``partial_counts``."""
    found, above, level = [], None, 0
    while True:
        rows = counts.where(F.col("level") == level).withColumn("parent", F.substring("node", 1, prefix_bytes(level) // 2) if level else F.lit(b""))
        if above is not None:
            rows = rows.join(small(above, SENT_ROWS), ["lang", "parent"], "left_semi")
        # the parent among the keys: where the join has dealt rows by it, counting needs no other shuffle
        alive = rows.groupBy("lang", "parent", "whole", "node").agg(F.sum("n").alias("docs")).where(F.col("docs") >= least)
        alive = durable(alive.select("lang", "whole", "node"), f"alive-{level}")
        found.append(alive.where("whole").select("lang", F.col("node").cast("string").alias("term")))
        above = alive.where("not whole").select("lang", F.col("node").alias("parent"))
        if above.isEmpty():
            break
        level += 1
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _share(count: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (N + 5 V)) of whole numbers, exact; null without kept terms."""
    wide = lambda c: c.cast("decimal(19,0)")
    total = F.nullif(F.col("total") + PRIOR * F.col("vocabulary"), F.lit(0))
    return (F.lit(1) + F.call_function("div", wide(count + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), wide(total))).cast("long")


def audit_sources(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each source of each language, how far the other sources' shares of all kept terms are
    from its own (part ``pair``, all of them), and the terms that it has more of than its language (part ``term``, the first ``top``).

    Null text, lang and source count as ''. A source without terms is compared like any other; a language without kept terms has pairs of
    value 0. Repeated rows and ids are documents of their own; ties go by the item's bytes; other columns don't matter; an empty table gives
    an empty result.
    """
    own = docs.select(*[F.coalesce(col(docs, c, "string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = durable(partial_counts(side_by_side(own)), "prefix-counts")
    kept = durable(kept_terms(counts, least), "kept-terms")
    occurrences = counts.where(F.col("level") == OCCURRENCES).select("lang", "source", F.col("node").cast("string").alias("term"), "n")
    by_source = durable(occurrences.join(small(kept, SENT_ROWS), ["lang", "term"], "left_semi").groupBy("lang", "source", "term").agg(F.sum("n").alias("count")), "kept-counts")
    remove(docs.sparkSession, *{f.rsplit("/", 1)[0] for f in counts.inputFiles()})

    sizes = by_source.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("own_terms"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"))
    groups = own.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(vocabulary, "lang", "left").fillna(0, ["total", "own_terms", "vocabulary"])
    groups = durable(groups.withColumn("zero", F.coalesce(_share(F.lit(0)), F.lit(0))), "groups")
    shares = by_source.join(small(groups, SENT_ROWS), ["lang", "source"]).select("lang", "source", "term", "count", "zero", _share(F.col("count")).alias("p"))
    shares = durable(shares, "shares")
    pairs = _pairs(shares, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = _terms(by_source, shares, vocabulary).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    w = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(w)).unionByName(terms.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top))


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two sources of a language: the sum of differences over all kept terms.

    A term that neither has differs by their shares of nothing, ``zero``; so the sum takes each source's own terms against the other's
    zero, by the source's few different shares, and is set right at the terms that both have. No term is paired with a source that lacks it.
    """
    side = lambda df, s, keys, *cols: df.select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in cols])
    a, b = (side(shares, s, ["lang", "term"], "source", "zero", "p") for s in "ab")
    met = a.join(b, ["lang", "term"]).where("source_a < source_b")
    gain = F.abs(F.col("p_a") - F.col("p_b")) - F.abs(F.col("p_a") - F.col("zero_b")) - F.abs(F.col("p_b") - F.col("zero_a"))
    both = met.groupBy("lang", "source_a", "source_b").agg(F.sum(gain).alias("gain"), F.count("*").alias("both"))

    levels = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    zeros = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("_z"))
    against = levels.join(zeros, "lang").where("source <> other").groupBy("lang", "source", "other").agg(F.sum(F.col("times") * F.abs(F.col("p") - F.col("_z"))).alias("far"))

    pair = side(groups, "a", ["lang"], "source", "zero", "own_terms").join(side(groups, "b", ["lang", "vocabulary"], "source", "zero", "own_terms"), "lang").where("source_a < source_b")
    far = lambda one, other, name: against.select("lang", F.col("source").alias(f"source_{one}"), F.col("other").alias(f"source_{other}"), F.col("far").alias(name))
    keys = ["lang", "source_a", "source_b"]
    full = pair.join(both, keys, "left").join(far("a", "b", "far_a"), keys, "left").join(far("b", "a", "far_b"), keys, "left").fillna(0, ["gain", "both", "far_a", "far_b"])
    neither = F.col("vocabulary") - F.col("own_terms_a") - F.col("own_terms_b") + F.col("both")
    full = full.withColumn("value", F.col("far_a") + F.col("far_b") + F.col("gain") + neither * F.abs(F.col("zero_a") - F.col("zero_b")))
    ends = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    return full.select("lang", "value", ends.alias("e")).select("lang", "e.source", "e.item", "value")


def _terms(by_source: DataFrame, shares: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the terms of which a source has a larger share than its language."""
    in_all = by_source.groupBy("lang", "term").agg(F.sum("count").alias("count"))
    totals = by_source.groupBy("lang").agg(F.sum("count").alias("total")).join(vocabulary, "lang")
    q = in_all.join(F.broadcast(totals), "lang").select("lang", "term", _share(F.col("count")).alias("q"))
    return shares.join(q, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
