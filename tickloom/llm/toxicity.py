"""Toxicity behind a noisy channel: restore disguised words under a character language model, then score the restored text.

A token that looks disguised (digits or signs among letters, long repeats, single letters in a row) becomes a lattice of readings; a
Viterbi search picks the likeliest under a trigram model whose counts come from all documents. Restored words are weighed by how much
oftener they occur in toxic labelled documents, backing off from the word to its beginnings, and a small logistic model turns a
document's strongest words into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col

#: Labelled rows of each class that the classifier is fitted on, at most; those with the lowest hash.
FIT_ROWS = 10_000
#: Documents that a feature must occur in.
SUPPORT = 6
#: What a sign may stand for.
READINGS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "*": "aeiou", "#": "aeiou"}
#: Log probabilities of the channel: a sign for a letter, a repeated letter, a sign that was dropped in.
SWAP, REPEAT, DROP = -1.0, -0.5, -2.0
_EDGE = ".,;:!?\"'()[]{}<>#$%&*|/\\-_=+~`"
_LETTERS = re.compile(r"[^\W\d_]+$")
_LETTER, _TRIPLE = re.compile(r"[^\W\d_]"), re.compile(r"([^\W\d_])\1\1")
#: Signs that may stand for letters, and those that count only behind a letter.
_SIGN, _SIGN_BEHIND = re.compile(r"[\d@$!|+*#€]"), re.compile(r"[.\-_=]")
_SPACED = re.compile(r"(?:(?<=\s)|^)(?:[^\W_][ .\-_*]){2,}[^\W_](?=[\s.,;:!?]|$)")


@dataclass
class CharModel:
    """Interpolated character trigrams over lower-case words between ``^`` and ``$``."""

    counts: dict[str, int]
    pairs: Counter = field(init=False)
    singles: Counter = field(init=False)
    total: int = field(init=False)

    def __post_init__(self) -> None:
        self.pairs, self.singles = Counter(), Counter()
        for g, n in self.counts.items():
            self.pairs[g[:2]] += n
            self.singles[g[2]] += n
        self.total = sum(self.counts.values())
        self.middles: Counter = Counter()
        for g, n in self.counts.items():
            self.middles[g[1:]] += n
        self.seen: dict[str, float] = {}

    def log(self, two: str, c: str) -> float:
        g = two + c
        if (known := self.seen.get(g)) is None:
            one = (self.singles[c] + 0.1) / (self.total + 100)
            bi = (self.middles[g[1:]] + 20 * one) / (self.singles[g[1]] + 20)
            known = self.seen[g] = math.log((self.counts.get(g, 0) + 10 * bi) / (self.pairs[two] + 10))
        return known


def readings(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a token: for each run of one character the strings that it may stand for, with their log probabilities."""
    out, i = [], 0
    while i < len(token):
        c, j = token[i], i
        while j < len(token) and token[j] == c:
            j += 1
        n, i = j - i, j
        letters = c if c.isalpha() else READINGS.get(c, "")
        cost = 0.0 if c.isalpha() else SWAP - math.log(max(len(letters), 1))
        arcs = [(x, cost + (REPEAT if n > 1 else 0.0)) for x in letters]
        if n > 1:
            arcs += [(x * 2, cost + (0.0 if n == 2 else REPEAT)) for x in letters]
        if not c.isalnum():
            arcs.append(("", DROP if letters else SWAP))
        elif not letters:
            arcs.append((c * min(n, 2), 2 * DROP))
        out.append(arcs)
    return out


def decode(token: str, model: CharModel, breaks: bool = False) -> str:
    """The likeliest reading of a token by a Viterbi search over the last two letters; with ``breaks``, as words with a space between them.

    A path is its last piece and the path before, so that a step costs the same at any place of a token.
    """
    paths: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    for arcs in readings(token):
        step: dict[str, tuple[float, tuple | None]] = {}
        for two, (p, path) in paths.items():
            for text, cost in arcs:
                state, q = two, p + cost
                for c in text:
                    q += model.log(state, c)
                    state = state[1] + c
                if state not in step or q > step[state][0]:
                    step[state] = (q, (text, path) if text else path)
        if breaks:
            q, path = max(((p + model.log(two, "$"), path) for two, (p, path) in step.items()), key=lambda x: x[0])
            if "^^" not in step or q > step["^^"][0]:
                step["^^"] = (q, (" ", path))
        paths = step
    path = max(((p + model.log(two, "$"), path) for two, (p, path) in paths.items()), key=lambda x: x[0])[1]
    pieces = []
    while path is not None:
        pieces.append(path[0])
        path = path[1]
    return "".join(reversed(pieces))


def disguised(token: str) -> bool:
    """Whether a token has a letter and a sign, or one letter three times in a row: each asked once, in time that grows with its length."""
    if (letter := _LETTER.search(token)) is None:
        return False
    return bool(_SIGN.search(token) or _SIGN_BEHIND.search(token, letter.end()) or _TRIPLE.search(token))


def restored(token: str, model: CharModel) -> str:
    """A white-space-delimited token as a plain lower-case word; only tokens that look disguised are decoded."""
    token = token.lower()
    bare = token.strip(_EDGE)
    if _LETTERS.match(bare) and not disguised(bare):
        return bare
    inner = token.strip(".,;:?\"'()[]{}<>")
    if not disguised(inner):
        return bare
    return decode(inner, model)


def spaced_words(text: str, model: CharModel) -> list[str]:
    """Words written as single letters in a row; the model finds where one ends and the next begins."""
    return [w for m in _SPACED.finditer(text) for w in decode(re.sub(r"[ .\-_*]", "", m.group()).lower(), model, True).split()]


def _words(text: str, model: CharModel, seen: dict[str, str], limit: int = 300_000) -> Iterator[str]:
    for token in text.split():
        if (word := seen.get(token)) is None:
            if len(seen) >= limit:
                seen.clear()
            word = seen[token] = restored(token, model)
        if word:
            yield word
    if _SPACED.search(text):
        yield from spaced_words(text, model)


def restore_text(text: str | None, model: CharModel) -> str:
    """The restored words of a text, in order, those written letter by letter at the end."""
    return " ".join(_words(text or "", model, {}))


def char_counts(docs: DataFrame) -> DataFrame:
    """``(gram, n)``: how often each trigram occurs in the plain words of all documents. Each task adds up its own words before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def flush() -> pa.RecordBatch:
            grams: Counter = Counter()
            for word, n in words.items():
                word = word.strip(_EDGE).lower()
                if _LETTERS.match(word):
                    word = f"^^{word}$"
                    for i in range(len(word) - 2):
                        grams[word[i : i + 3]] += n
            words.clear()
            return pa.RecordBatch.from_pydict({"gram": pa.array(list(grams), pa.string()), "n": pa.array(list(grams.values()), pa.int64())})

        for batch in batches:
            for text in batch.column("text").to_pylist():
                words.update((text or "").split())
            if len(words) > 300_000:
                yield flush()
        yield flush()

    return docs.select(col(docs, "text", "string").alias("text")).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def char_model(docs: DataFrame) -> CharModel:
    """The model of all trigrams that occur; it grows with the scripts of the corpus."""
    return CharModel({r.gram: r.n for r in char_counts(docs).orderBy("gram").toLocalIterator()})


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 5 is 0; null ids count as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_labels(labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``(of, toxic)``: the labels that may be learned from, at most ``rows`` of each class; a table of proven size."""
    marks = labels.select(col(labels, "doc_id", "long").alias("of"), col(labels, "toxic", "int").alias("toxic")).where("of is not null and toxic is not null").where(~held_out(F.col("of")))
    marks = marks.groupBy("of").agg(F.max("toxic").alias("toxic"))
    part = lambda t: marks.where((F.col("toxic") > 0) == F.lit(t)).orderBy(F.xxhash64("of"), "of").limit(rows)
    return part(True).unionByName(part(False))


def features_of(word: str) -> tuple[str, ...]:
    """A word and its beginnings of 6, 5 and 4 letters, from the most to the least special."""
    return (word + "$", *(word[:n] for n in (6, 5, 4) if len(word) >= n))


def feature_counts(fit: DataFrame, model: CharModel) -> DataFrame:
    """``(feature, toxic, clean)``: in how many of the labelled documents ``fit`` (text, toxic) each feature occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, str] = {}
        for batch in batches:
            found = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                found[int(toxic > 0)].update({f for w in set(_words(text or "", model, seen)) for f in features_of(w)})
            every = list(found[0] | found[1])
            yield pa.RecordBatch.from_pydict({"feature": pa.array(every, pa.string()), "toxic": pa.array([found[1][f] for f in every], pa.int64()), "clean": pa.array([found[0][f] for f in every], pa.int64())})

    return fit.select("text", "toxic").mapInArrow(run, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class ToxicModel:
    chars: CharModel
    weights: dict[str, float]
    logistic: np.ndarray

    def word(self, word: str) -> float:
        for f in features_of(word):
            if (w := self.weights.get(f)) is not None:
                return w
        return 0.0

    def evidence(self, text: str | None, seen: dict[str, float]) -> list[float]:
        """The three strongest words, and how many and what share of the words point to a toxic text."""
        top, hits, n = [0.0, 0.0, 0.0], 0, 0
        text = text or ""
        words = text.split()
        own = []
        for token in words:
            if (w := seen.get(token)) is None:
                if len(seen) > 300_000:
                    seen.clear()
                w = seen[token] = self.word(restored(token, self.chars))
            if w > 0.0:
                own.append(w)
        if _SPACED.search(text):
            own += [w for x in spaced_words(text, self.chars) if (w := self.word(x)) > 0.0]
        n = max(len(words), 1)
        if own:
            own.sort(reverse=True)
            top = (own[:3] + [0.0, 0.0])[:3]
            hits = sum(w > 2.0 for w in own)
        return [1.0, top[0], top[1], top[2], math.log1p(hits), hits / n]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(rows @ self.logistic, -30, 30)))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Newton's method with a ridge on a few columns."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * len(y) * w / 100
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1]) * (ridge * len(y) / 100 + 1e-6)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> ToxicModel:
    """Character counts over all documents; word weights and the logistic model from the labelled rows that ``fit_labels`` allows.

    Without labelled rows of both classes nothing is known about words and every document scores 0.
    """
    chars = char_model(docs)
    marks = fit_labels(labels, rows)
    texts = docs.select(col(docs, "doc_id", "long").alias("doc_id"), col(docs, "text", "string").alias("text"))
    fit = texts.join(F.broadcast(marks), F.col("doc_id") == F.col("of")).select("text", "toxic")  # at most 2 * rows ids
    sizes = fit.agg(F.count_if(F.col("toxic") > 0).alias("t"), F.count_if(F.col("toxic") <= 0).alias("c")).first()
    nothing = ToxicModel(chars, {}, np.array([-30.0, 0, 0, 0, 0, 0]))
    if not sizes.t or not sizes.c:
        return nothing
    share = lambda n, of: F.log((F.col(n) + 0.5) / F.lit(of + 1.0))
    weight = (share("toxic", sizes.t) - share("clean", sizes.c)).alias("weight")
    # all features with support; how many there can be is bounded by the labelled rows, of which there are at most 2 * rows
    found = feature_counts(fit, chars).where(F.col("toxic") + F.col("clean") >= SUPPORT).select("feature", weight)
    model = ToxicModel(chars, {r.feature: r.weight for r in found.toLocalIterator()}, nothing.logistic)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, float] = {}
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([model.evidence(t, seen) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))], ["toxic", "x"])

    # at most 2 * rows short rows, as bounded above; more only if ids repeat, hence the limit
    own = fit.mapInArrow(run, "toxic int, x array<double>").limit(4 * rows).toPandas()
    x, y = np.array(own["x"].tolist()), (own["toxic"].to_numpy() > 0).astype(float)
    return ToxicModel(chars, model.weights, logistic_fit(x, y))


def score_toxicity(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id, text).

    Null and empty texts have no evidence and get the score of a text without it; repeated rows are each scored; an empty table gives an
    empty result. Columns other than doc_id and text are not looked at.
    """
    model = fit_model(docs, labels, **how)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # all trigrams that occur, and the features of the labelled rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, float] = {}
        own = shared.value
        for batch in batches:
            x = np.array([own.evidence(t, seen) for t in batch.column("text").to_pylist()]).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own.score(x))], ["doc_id", "score"])

    scored = docs.select(col(docs, "doc_id", "long").alias("doc_id"), col(docs, "text", "string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
