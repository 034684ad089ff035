"""Benchmark decontamination: every training text queries a BM25 index of the test items by block-max WAND; hits are verified.

A query has the distinct terms of all passages of a text, so an item is met in however many places its parts stand. Each piece of an item
has a threshold of its own: what is left of its score when the terms that weigh most are gone, as many as an item can lack whose question
and answer still overlap enough. So whatever verification would accept is retrieved.

The index holds the test items, not the corpus. A long item is indexed by overlapping pieces and verified as a whole. Document frequencies and the mean length are counted over all pieces;
the index itself is built in parts by Spark, each from a bounded number of pieces, and lies in the shared folder as one file a part. A
task looks at all parts for each batch of its rows, so the corpus is read once however many parts there are. No item passes the driver.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections import Counter, OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SHINGLE, WordHashes, col, durable, runs, scratch_path, shared_store, word_hashes, words_of

#: Words of an item that is indexed as one piece, at most. Words of a longer item's pieces, which start every half of it.
WHOLE, PIECE = 64, 32
#: A hit is contaminated if of the item's question and of its answer this share of 5-word shingles is in the document.
OVERLAP = 0.75
K1, B = 1.2, 0.75
BLOCK = 8
#: Pieces of an index part, on average, and of one item in a row of a part, at most.
PART_PIECES = 4_096
#: Bytes of index files that a worker keeps in memory; characters of texts whose words it holds.
HELD, HELD_TEXT = 200 << 20, 1 << 20
#: What sums of impacts may be off by.
ROUNDING = 1e-9
_SENTENCE = re.compile(rb"(?<=[.!?])\s+")
#: Signs at a word's ends, which may come from its surroundings in either text.
_EDGE = b".,;:!?*#$%&|<>()[]{}\"'"


def bare_words(text: str | None) -> list[bytes]:
    return [w for x in words_of(text) if (w := x.strip(_EDGE))]


def split_item(text: str) -> tuple[list[bytes], int]:
    """The words of an item and where its answer begins: with its last sentence; with one sentence, its last third."""
    words = bare_words(text)
    sentences = [s for s in _SENTENCE.split(text.encode("utf-8", "surrogatepass").lower()) if s.strip(_EDGE + b" ")]
    answer = len(bare_words(sentences[-1].decode("utf-8", "surrogatepass"))) if len(sentences) > 1 else max(1, len(words) // 3)
    return words, max(len(words) - answer, 0)


def pieces(n: int) -> list[tuple[int, int]]:
    """What an item of ``n`` words is indexed by: all of it, or ``PIECE`` words every half of it."""
    if n <= WHOLE:
        return [(0, n)]
    return [(at, at + PIECE) for at in [*range(0, n - PIECE, PIECE // 2), n - PIECE]]


def may_lack(sides: tuple[np.ndarray, np.ndarray], n: int, overlap: float) -> int:
    """How many words of one of its pieces an item of ``n`` words can lack, if ``overlap`` of the distinct shingles on each of its sides are there.

    A word is lacking only if all shingles over it are. Left of a shingle that is there, the one that begins at a lacking word is lacking, right of
    it the one that ends there: no more words are lacking than shingles, counted with repeats. Of pieces side by side, one lacks no more than the mean.
    """
    lacking = 0
    for h in sides:
        repeats = np.sort(np.unique(h, return_counts=True)[1])[::-1]
        lacking += int(repeats[: int((1 - overlap) * len(repeats) + ROUNDING)].sum())
    return lacking if n <= WHOLE else lacking // (n // PIECE)


class ItemIndex:
    """Postings by term with BM25 impacts divided by the piece's own score, so that a piece scores 1 on itself; pieces lie in blocks of
    ``BLOCK``, and each term knows its largest impact in each block where it occurs. An item is ``(id, text)``, or ``(id, text, i, j)`` for its
    pieces i to j - 1. ``df``, ``n`` and ``mean`` are the counts over all parts; default: over this one. ``least`` is the score of each piece
    from which on its item can overlap by ``overlap``."""

    def __init__(self, items: list[tuple], df: dict[bytes, int] | None = None, n: int | None = None, mean: float | None = None, overlap: float = OVERLAP) -> None:
        parsed = sorted(((i, *split_item(t or ""), cut) for i, t, *cut in items), key=lambda x: (sorted(set(x[1]))[-3:], x[1], str(x[0]), x[3]))
        parsed = [p for p in parsed if p[1]]
        self.ids = [p[0] for p in parsed]
        indexed = [(at, ws[a:b]) for at, (_, ws, _, cut) in enumerate(parsed) for a, b in pieces(len(ws))[slice(*cut) if cut else slice(None)]]
        #: The item of each piece.
        self.item_of = [at for at, _ in indexed]
        if df is None:
            df, n, mean = piece_counts([ws for _, ws in indexed])
        seen = WordHashes()
        self.parts, lacking = [], []
        for _, ws, answer, _ in parsed:
            h = runs(word_hashes(ws, seen), SHINGLE)
            ends = np.arange(len(h)) + min(SHINGLE, len(ws))
            sides = h[ends <= answer], h[ends > answer]
            lacking.append(may_lack(sides, len(ws), overlap))
            self.parts.append((*map(np.unique, sides), min(SHINGLE, len(ws))))
        found: dict[bytes, list[tuple[int, float]]] = {}
        self.least = np.empty(len(indexed))
        for at, (item, ws) in enumerate(indexed):
            own = {w: np.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(ws) / mean)) for w, c in Counter(ws).items()}
            total = sum(own.values())
            self.least[at] = max(1 - sum(sorted(own.values(), reverse=True)[: lacking[item]]) / total, ROUNDING) - ROUNDING / 2
            for w, v in own.items():
                found.setdefault(w, []).append((at, v / total))
        self.terms = {w: k for k, w in enumerate(found)}
        self.postings = list(found.values())
        self.blocks = -(-len(indexed) // BLOCK)
        self.block_least = np.minimum.reduceat(self.least, np.arange(0, len(indexed), BLOCK)) if indexed else self.least
        # by term: the blocks that it occurs in, and its largest impact in each
        most = [{} for _ in found]
        for own, p in zip(most, self.postings, strict=True):
            for at, v in p:
                own[at // BLOCK] = max(own.get(at // BLOCK, 0.0), v)
        self.block_at = np.concatenate([[0], np.cumsum([len(x) for x in most], dtype=np.int64)]).astype(np.int64)
        self.block_of = np.fromiter((b for x in most for b in x), np.int64, int(self.block_at[-1]))
        self.block_max = np.fromiter((v for x in most for v in x.values()), np.float64, int(self.block_at[-1]))
        self.most = most

    def wand(self, terms: list[int], blocks: np.ndarray) -> list[tuple[int, float]]:
        """Pieces that reach their thresholds on the distinct ``terms``, in document-at-a-time order; only ``blocks`` can hold them."""
        cursors = [[self.postings[t], 0, self.most[t]] for t in terms]
        out = []
        for block in blocks.tolist():
            low, high, least = block * BLOCK, block * BLOCK + BLOCK, self.block_least[block]
            live = []
            for c in cursors:
                if block in c[2]:
                    p, i = c[0], c[1]
                    while i < len(p) and p[i][0] < low:
                        i += 1
                    c[1] = i
                    if i < len(p) and p[i][0] < high:
                        live.append(c)
            while live:
                live.sort(key=lambda c: c[0][c[1]][0])
                bound, pivot = 0.0, None
                for c in live:
                    bound += c[2][block]
                    if bound >= least:
                        pivot = c[0][c[1]][0]
                        break
                if pivot is None:
                    break
                if live[0][0][live[0][1]][0] == pivot:
                    score = 0.0
                    for c in live:
                        at, v = c[0][c[1]]
                        if at != pivot:
                            break
                        score += v
                        c[1] += 1
                    if score >= self.least[pivot]:
                        out.append((pivot, score))
                else:
                    for c in live:
                        if c[0][c[1]][0] >= pivot:
                            break
                        while c[1] < len(c[0]) and c[0][c[1]][0] < pivot:
                            c[1] += 1
                live = [c for c in live if c[1] < len(c[0]) and c[0][c[1]][0] < high]
        return out

    def retrieve(self, words: list[bytes]) -> dict[int, float]:
        """Best score by item of its pieces that reach their thresholds on the terms of a text. Blocks are bounded by their maxima first: one
        that stays below the least threshold in it is never scored."""
        get = self.terms.get
        terms = np.array(sorted(t for w in set(words) if (t := get(w)) is not None), np.int64)
        found: dict[int, float] = {}
        if not len(terms):
            return found
        n = self.block_at[terms + 1] - self.block_at[terms]
        entry = np.repeat(self.block_at[terms] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        bounds = np.bincount(self.block_of[entry], self.block_max[entry], self.blocks)
        blocks = np.flatnonzero(bounds >= self.block_least - ROUNDING)
        if not len(blocks):
            return found
        for piece, score in self.wand(terms.tolist(), blocks):
            item = self.item_of[piece]
            found[item] = max(found.get(item, 0.0), score)
        return found

    def verify(self, words: list[bytes], items: dict[int, float], seen: WordHashes) -> list[tuple[int | None, float, float, float]]:
        """``(item_id, score, question overlap, answer overlap)`` of the retrieved items, from all shingles of the text; a side without shingles counts as found."""
        out, sets, hashes = [], {}, word_hashes(words, seen)
        for at, score in sorted(items.items()):
            question, answer, n = self.parts[at]
            if n not in sets:
                sets[n] = np.unique(runs(hashes, n)) if len(words) >= n else np.empty(0, np.uint64)
            share = lambda x: float(np.mean(held(sets[n], x))) if len(x) else 1.0  # noqa: B023, E731
            out.append((self.ids[at], score, share(question), share(answer)))
        return out


def held(values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of ``x`` are among the sorted ``values``."""
    at = np.searchsorted(values, x)
    return (at < len(values)) & (values[np.minimum(at, len(values) - 1)] == x) if len(values) else np.zeros(len(x), bool)


def piece_counts(found: list[list[bytes]]) -> tuple[Counter, int, float]:
    """In how many pieces each word occurs, how many pieces there are, and their mean length."""
    return Counter(w for ws in found for w in set(ws)), max(len(found), 1), sum(map(len, found)) / max(len(found), 1) or 1.0


def build_index(benchmark: DataFrame, overlap: float = OVERLAP) -> tuple[str, int]:
    """Writes the index of ``benchmark`` (item_id, text) to a folder of the shared store; returns it and the number of parts.

    Rows of at most PART_PIECES pieces of one item are dealt to parts by hash; with each part go the document frequencies of its words.
    """
    spark = benchmark.sparkSession
    folder = scratch_path(spark, "items")
    items = benchmark.select(col(benchmark, "item_id", "long").alias("item_id"), F.trim(col(benchmark, "text", "string")).alias("text")).where("length(text) > 0").distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = pieces(len(bare_words(text)))
                rows += [(i, at, min(at + PART_PIECES, len(own)), sum(b - a for a, b in own[at : at + PART_PIECES])) for at in range(0, len(own), PART_PIECES) if own[-1][1]]
            if rows:
                i, a, b, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(i)) for c in ("item_id", "text")), *(pa.array(x, pa.int64()) for x in (a, b, n))], ["item_id", "text", "a", "b", "n_words"])

    rows = durable(items.mapInArrow(cut, "item_id long, text string, a long, b long, n_words long"), "item-rows")
    total = rows.agg(F.sum(F.col("b") - F.col("a")).alias("n"), F.sum("n_words").alias("words")).first()
    if not total.n:
        return folder, 0
    n, mean, parts = total.n, total.words / total.n, -(-total.n // PART_PIECES)
    dealt = rows.select(F.pmod(F.xxhash64("item_id", "text", "a"), F.lit(parts)).alias("part"), "item_id", "text", "a", "b")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text, a, b in zip(*(batch.column(c).to_pylist() for c in ("part", "text", "a", "b")), strict=True):
                words = bare_words(text)
                df = piece_counts([words[x:y] for x, y in pieces(len(words))[a:b]])[0]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(df), pa.int64()), pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], ["part", "word", "n"])

    counts = durable(dealt.mapInArrow(count, "part long, word binary, n long").groupBy("part", "word").agg(F.sum("n").alias("n")), "item-words")
    df = counts.groupBy("word").agg(F.sum("n").alias("df"))
    known = counts.select("part", "word").join(df, "word")

    def build(key: tuple, own: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        files, base = shared_store(folder)
        files.create_dir(base, recursive=True)
        index = ItemIndex([(None if i is None else int(i), t, int(a), int(b)) for i, t, a, b in zip(own["item_id"], own["text"], own["a"], own["b"], strict=True)], dict(zip(words["word"], words["df"], strict=True)), n, mean, overlap)
        target = part_file(base, int(key[0]))
        temp = f"{target}.{uuid.uuid4().hex}"
        with files.open_output_stream(temp) as out:
            out.write(pickle.dumps(index, protocol=5))
        files.move(temp, target)
        return pd.DataFrame({"part": [int(key[0])]})

    # as text: beside a null, pandas makes a float of an id, which rounds large ones
    exact = dealt.withColumn("item_id", F.col("item_id").cast("string"))
    built = exact.groupBy("part").cogroup(known.groupBy("part")).applyInPandas(build, "part long")
    return folder, durable(built, "item-parts").count() and parts


def part_file(base: str, part: int) -> str:
    return f"{base}/part-{part:06d}.index"


#: Index parts that this worker process holds, the last used last, and their bytes.
_LOADED: OrderedDict[str, tuple[ItemIndex, int]] = OrderedDict()


def load_part(folder: str, part: int) -> ItemIndex | None:
    files, base = shared_store(folder)
    path = part_file(base, part)
    if path in _LOADED:
        _LOADED.move_to_end(path)
        return _LOADED[path][0]
    if not files.get_file_info(path).is_file:  # no row was dealt to it
        return None
    with files.open_input_file(path) as f:
        data = f.read()
    _LOADED[path] = (pickle.loads(data), len(data))
    while len(_LOADED) > 1 and sum(n for _, n in _LOADED.values()) > HELD:
        _LOADED.popitem(last=False)
    return _LOADED[path][0]


def hits(texts: list[str | None], folder: str, parts: int, overlap: float, seen: WordHashes) -> Iterator[tuple[int, tuple]]:
    """``(place of the text, (item_id, score, question overlap, answer overlap))`` of all verified hits of a batch."""
    first = 0
    while first < len(texts):
        # the words of a few texts at a time are held while all parts are looked at
        words, size = [], 0
        while first + len(words) < len(texts) and size < HELD_TEXT:
            text = texts[first + len(words)]
            words.append(bare_words(text))
            size += len(text or "")
        for part in range(parts):
            if (index := load_part(folder, part)) is None:
                continue
            for i, own in enumerate(words, first):
                if found := index.retrieve(own):
                    yield from ((i, hit) for hit in index.verify(own, found, seen) if min(hit[2:]) >= overlap)
        first += len(words)


def contaminated(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` for each document and test item found in it; the score is that of the
    item's best piece.

    Null and empty texts and items match nothing; repeated rows give repeated results; empty tables give an empty result.
    """
    texts = docs.select(col(docs, "doc_id", "long").alias("doc_id"), col(docs, "text", "string").alias("text"))
    folder, parts = build_index(benchmark, overlap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            found = list(hits(batch.column("text").to_pylist(), folder, parts, overlap, seen))
            if found:
                a = list(zip(*(hit for _, hit in found), strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array([i for i, _ in found])), pa.array(a[0], pa.int64()), *(pa.array(x, pa.float64()) for x in a[1:])], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    found = texts.mapInArrow(run, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
    return found.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no test item. Texts aren't shuffled: each task judges its own rows."""
    folder, parts = build_index(benchmark, overlap)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        out = np.ones(len(texts), bool)
        for i, _ in hits(texts.tolist(), folder, parts, overlap, WordHashes()):
            out[i] = False
        return pd.Series(out)

    return docs.where(clean(col(docs, "text", "string")))
