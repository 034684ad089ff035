"""Substring de-duplication by sliding sentence spans: runs of consecutive sentences that occur before are removed."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, col, durable, mix, word_hashes

#: Sentences of a span, and the words that it has at least: runs of a few tiny sentences meet by chance, so a span goes on until it has them.
SENTENCES, WORDS = 3, 12
#: Of every so many word ends in a row without a sentence's end, one is a cut (the least hash), so that equal passages are cut alike wherever
#: they begin: but for WINDOW - 1 words at its ends, a passage is cut by its own words, and 50 words hold a whole span at least.
WINDOW = 8
_END = re.compile(r"(?<=[.!?])[ \t\r\f\v]+|\s*\n\s*")
_TOKEN = re.compile(r"\S+")
#: Base of the polynomial that hashes runs of words, and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _sentence_words(text: str) -> tuple[list[str], list[int]]:
    """The lower-case words of a text and how many come up to each sentence's end: ``.``, ``!`` or ``?`` before white space, or a line's end."""
    words, ends, at, text = [], [], 0, text.lower()
    for m in [*_END.finditer(text), None]:
        words += text[at : m.start() if m else len(text)].split()
        at = m.end() if m else at
        if len(words) > (ends[-1] if ends else 0):
            ends.append(len(words))
    return words, ends


def cuts(hashes: np.ndarray, ends: list[int], window: int = WINDOW) -> np.ndarray:
    """Where units begin and end, as numbers of words before: at the sentences' ends, and inside them at the least hash of each ``window``."""
    n = len(hashes)
    h = hashes | np.uint64(1)
    h[np.array(ends, np.int64) - 1] = 0
    chosen = h == 0
    if n >= window:
        least = _filtered(h, window, np.minimum)
        padded = np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)])
        # a word end is the least of a window if and only if the largest of its windows' least hashes is its own
        chosen |= _filtered(padded, window, np.maximum) == h
    return np.concatenate([[0], np.flatnonzero(chosen) + 1])


def _filtered(x: np.ndarray, window: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every ``window`` values in a row."""
    width = 1
    while width < window:
        step = min(width, window - width)
        x = best(x[:-step], x[step:])
        width += step
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full((2, n), np.array([[_BASE], [_INVERSE]], np.uint64))
    out[:, 0] = 1
    return tuple(np.cumprod(out, axis=1))


def spans(text: str, n: int = SENTENCES, words: int = WORDS, seen: WordHashes | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where units begin and end (numbers of words before), and of each span its hash, its first unit and the unit after it.

    From each unit and up to each unit goes the shortest run of ``n`` units and ``words`` words; a text of fewer units is one span.
    """
    tokens, ends = _sentence_words(text)
    if len(tokens) < words:
        return np.array([0, *ends]), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = word_hashes(tokens, WordHashes() if seen is None else seen)
    at = cuts(hashes, ends)
    k = len(at) - 1
    n = min(n, k)
    i = np.arange(k + 1)
    to = np.maximum(i + n, np.searchsorted(at, at + words))
    since = np.minimum(i - n, np.searchsorted(at, at - words, side="right") - 1)
    pairs = np.unique(np.concatenate([(i * (k + 1) + to)[to <= k], (since * (k + 1) + i)[since >= 0]]))
    first, last = pairs // (k + 1), pairs % (k + 1)
    powers, inverse = _powers(len(tokens) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1])])
    found = mix((sums[at[last]] - sums[at[first]]) * inverse[at[first]] + (at[last] - at[first]).astype(np.uint64))
    return at, found.view(np.int64), first, last


def span_rows(docs: DataFrame) -> DataFrame:
    """``(h, key, n, again)``: each span of a document once; and a row without ``h`` for each document, with its number of units and whether
    a span occurs again in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            hashes, units, again = [], [], []
            for text in batch.column("text").to_pylist():
                at, found, _, _ = spans(text or "", seen=seen)
                hashes.append(np.unique(found))
                units.append(len(at) - 1)
                again.append(len(hashes[-1]) < len(found))
            docs = np.arange(len(hashes))
            own = np.repeat(docs, [len(h) for h in hashes])
            flat = np.concatenate([np.empty(0, np.int64), *hashes])
            below = lambda values, kind: pa.concat_arrays([pa.nulls(len(flat), kind), pa.array(values, kind)])  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(flat), pa.nulls(len(docs), pa.int64())]), batch.column("key").take(pa.array(np.concatenate([own, docs]))), below(units, pa.int64()), below(again, pa.bool_())], ["h", "key", "n", "again"]
            )

    return docs.select("key", "text").mapInArrow(run, f"h long, key {dict(docs.dtypes)['key']}, n long, again boolean")


def cut_text(text: str | None, repeated: set[int], words: WordHashes | None = None) -> tuple[str, list[tuple[int, int]], int]:
    """The text without the units of spans that are in ``repeated`` or occur before in the text; their ranges; the number of units."""
    text = text or ""
    at, hashes, first, last = spans(text, seen=words)
    n, seen = len(at) - 1, set()
    gone = np.zeros(n, bool)
    for h, i, j in zip(hashes.tolist(), first.tolist(), last.tolist(), strict=True):
        if h in repeated or h in seen:
            gone[i:j] = True
        seen.add(h)
    if not gone.any():
        return text, [], n
    starts = [m.start() for m in _TOKEN.finditer(text)]
    ranges, kept, done = [], [], 0
    for i in np.flatnonzero(gone).tolist():
        start, end = starts[at[i]], starts[at[i + 1]] if i + 1 < n else len(text)
        kept.append(text[done:start])
        done = end
        ranges.append((start, end))
    kept.append(text[done:])
    return "".join(kept), ranges, n


def repeated_spans(every: DataFrame) -> DataFrame:
    """``(key, hs)``: for each document the spans that a document with a smaller key holds too."""
    every = every.where("h is not null").select("h", "key")
    first = every.groupBy("h").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").select("h", "first")
    return every.join(first, "h").where("key > first").groupBy("key").agg(F.collect_set("h").alias("hs"))


def keyed(docs: DataFrame) -> DataFrame:
    """``(key, doc_id, text, times)``: documents by a key that has their order: id (null last), then text.

    Where ids are unique the key is the id. Else it is the id followed by 62 bits of a hash of the text, so that rows that share an id, or have none,
    are documents of their own; rows that repeat both are one with a number of ``times``.
    """
    rows = docs.select(col(docs, "doc_id", "long").alias("doc_id"), col(docs, "text", "string").alias("text"))
    if rows.where("doc_id is null").isEmpty() and rows.groupBy("doc_id").count().where("count > 1").isEmpty():
        return rows.select(F.col("doc_id").alias("key"), "doc_id", "text", F.lit(1).cast("long").alias("times"))
    wide = "decimal(38,0)"
    # null as 2 ** 63, which follows all ids
    key = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)")).cast(wide) * F.lit(str(1 << 62)).cast("decimal(19,0)") + F.shiftrightunsigned(F.xxhash64("text"), 2).cast("decimal(19,0)")
    return rows.withColumn("key", key.cast(wide)).groupBy("key").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"), F.count("*").alias("times"))


def deduplicate_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, n_removed, n_removed_chars, removed, kept_text`` for every row of ``docs`` (doc_id, text).

    A span stays in the first document that holds it, by id (null last) and then by a hash of the text, and there where it occurs first.
    Of rows that repeat id and text one is judged so, and the others lose all their spans. Null and empty texts have no sentences.
    ``removed`` has the character ranges that go, each unit with the white space after it. An empty table gives an empty result.
    """
    rows = keyed(docs)
    every = durable(span_rows(rows), "spans")
    marks = every.where("h is null").select("key", "n", "again").join(durable(repeated_spans(every), "repeated"), "key", "left").withColumnRenamed("key", "of")

    def batch_of(ids: pa.Array, found: list[tuple[str, list[tuple[int, int]], int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([n for _, _, n in found], pa.int64()),
                pa.array([len(r) for _, r, _ in found], pa.int64()),
                pa.array([sum(b - a for a, b in r) for _, r, _ in found], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in r] for _, r, _ in found], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([k for k, _, _ in found], pa.string()),
            ],
            ["doc_id", "n_sentences", "n_removed", "n_removed_chars", "removed", "kept_text"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            texts, times, marked, n, again = (batch.column(c).to_pylist() for c in ("text", "times", "hs", "n", "again"))
            # a text without repeated spans stays as it is
            yield batch_of(batch.column("doc_id"), [cut_text(t, set(hs or ()), words) if hs or twice else (t or "", [], k) for t, hs, k, twice in zip(texts, marked, n, again, strict=True)])
            for i, more in enumerate(times):
                for first in range(1, more, 1_000):  # a thousand copies at a time
                    n = min(1_000, more - first)
                    yield batch_of(batch.column("doc_id").take(pa.array([i] * n)), [cut_text(texts[i], set(spans(texts[i] or "", seen=words)[1].tolist()), words)] * n)

    met = rows.join(marks, F.col("key") == F.col("of"), "left").select("doc_id", "text", "times", "hs", "n", "again")
    return met.mapInArrow(run, "doc_id long, n_sentences long, n_removed long, n_removed_chars long, removed array<struct<start:long,end:long>>, kept_text string")
