"""Quality rules: an isolation forest over rule statistics, with its threshold calibrated from labelled rows.

Statistics are computed in one pass over whole texts, batch by batch; no text is shuffled.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, durable

#: Trees, rows a tree is grown from, and with them the most rows that are sampled (by a hash of id and statistics) for growing.
TREES, PER_TREE = 128, 256
SAMPLE_ROWS = TREES * PER_TREE
#: The threshold is the one with the best mean of both classes' shares of right verdicts among those that keep this share of the good.
KEEP_GOOD = 0.995
#: Score steps that the calibration counts labelled rows by.
STEPS = 2_000

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word", "symbols", "dup_lines", "repeats", "upper", "alpha", "distinct", "enders", "pipes", "long_line")
_SYMBOL = re.compile(rb"[#*$%&|<>]")
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_ROW = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, features array<float>"


def statistics(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """The base statistics of a text (null: as empty), and the forest's features."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    joined = b"".join(words)
    word_chars = len(joined) if len(data) == len(text) else len(joined.decode("utf-8", "surrogatepass"))
    symbols = len(_SYMBOL.findall(data))
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        counts = Counter(windows)
        if len(counts) < len(windows):
            starts = np.fromiter((counts[w] > 1 for w in windows), bool, n - 2)
            covered = np.zeros(n, bool)
            covered[:-2] |= starts
            covered[1:-1] |= starts
            covered[2:] |= starts
            repeat = int(covered.sum())
    base = (n, word_chars, symbols, dup, repeat)
    m, chars = max(n, 1), max(word_chars, 1)
    upper = len(data) - len(data.translate(None, _UPPER))
    other = len(data) - len(data.translate(None, _LETTERS))
    features = [
        math.log1p(n),
        word_chars / m,
        symbols / m,
        dup / max(len(lines), 1),
        repeat / m,
        upper / chars,
        other / max(len(joined), 1),
        math.log1p(len(set(words))) / math.log1p(m),
        (data.count(b".") + data.count(b"!")) / m,
        data.count(b"|") / m,
        math.log1p(n / max(len(lines), 1)),
    ]
    return base, features


def rule_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base statistics and ``features`` for every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in batch.column("text").to_pylist()]
            base = np.array([b for b, _ in found], np.int64).reshape(-1, len(BASE))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(base[:, i]) for i in range(len(BASE))), pa.array([f for _, f in found], pa.list_(pa.float32()))],
                ["doc_id", *BASE, "features"],
            )

    return docs.select(col(docs, "doc_id", "long").alias("doc_id"), col(docs, "text", "string").alias("text")).mapInArrow(run, _ROW)


def path_length(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    return 0.0 if n <= 1 else 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else 1.0


class IsolationForest:
    """Trees as flat arrays: a node's feature (-1: leaf), split value, children and, at leaves, the path length."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]], per_tree: int) -> None:
        self.trees, self.norm = trees, path_length(per_tree) or 1.0

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, seed: int = 7) -> IsolationForest:
        rng, out = np.random.default_rng(seed), []
        size = min(per_tree, len(rows))
        for _ in range(trees):
            own = rows[rng.choice(len(rows), size, replace=False)]
            nodes: list[list[float]] = []
            stack = [(own, 0, -1, 0)]
            while stack:
                x, depth, parent, side = stack.pop()
                at = len(nodes)
                if parent >= 0:
                    nodes[parent][2 + side] = at
                low, high = x.min(0), x.max(0)
                open_ = np.flatnonzero(high > low)
                if len(x) <= 1 or not len(open_) or depth >= math.ceil(math.log2(max(per_tree, 2))):
                    nodes.append([-1, 0.0, 0, 0, depth + path_length(len(x))])
                    continue
                f = int(rng.choice(open_))
                split = float(rng.uniform(low[f], high[f]))
                nodes.append([f, split, 0, 0, 0.0])
                right = x[:, f] > split
                stack += [(x[~right], depth + 1, at, 0), (x[right], depth + 1, at, 1)]
            t = np.array(nodes)
            out.append((t[:, 0].astype(np.int32), t[:, 1].astype(np.float32), t[:, 2].astype(np.int32), t[:, 3].astype(np.int32), t[:, 4].astype(np.float32)))
        return cls(out, size)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly from 0 to 1 of each row."""
        total = np.zeros(len(rows))
        for feature, split, left, right, depth in self.trees:
            at = np.zeros(len(rows), np.int32)
            while True:
                f = feature[at]
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                here = at[inner]
                at[inner] = np.where(rows[inner, f[inner]] > split[here], right[here], left[here])
            total += depth[at]
        return 2.0 ** (-total / max(len(self.trees), 1) / self.norm)


def fit_forest(stats: DataFrame, sample_rows: int = SAMPLE_ROWS) -> IsolationForest | None:
    """Grown from at most ``sample_rows`` rows, those with the lowest hash; None for an empty table. All rows but about twice as many as are
    wanted are left out before the sort, so that tasks send few."""
    n = stats.count()
    order = F.xxhash64("doc_id", "n_words", "word_chars", "n_symbols")
    below = int(min(1.0, 2.0 * sample_rows / max(n, 1)) * (1 << 32))
    near = stats.select("features", order.alias("o")).where(F.pmod("o", F.lit(1 << 32)) < below)
    rows = near.orderBy("o").limit(sample_rows).select("features").toPandas()["features"]
    return IsolationForest.grow(np.array(rows.tolist(), np.float32)) if len(rows) else None


def anomaly_scores(stats: DataFrame, forest: IsolationForest | None) -> DataFrame:
    """Adds ``anomaly`` to the statistics. The forest, of bounded size, goes with the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("features").to_pylist(), np.float32).reshape(batch.num_rows, -1)
            score = forest.score(rows) if forest and len(rows) else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "anomaly"])

    return stats.mapInArrow(run, _ROW + ", anomaly double")


def calibrate(scored: DataFrame, labels: DataFrame, keep_good: float = KEEP_GOOD) -> float:
    """The anomaly from which documents are rejected. All labelled rows are counted, by score step; without labels of both kinds: nothing is rejected."""
    marks = labels.select(col(labels, "doc_id", "long").alias("of"), col(labels, "quality", "int").alias("quality")).where("of is not null and quality is not null").groupBy("of").agg(F.max("quality").alias("quality"))
    step = F.floor(F.col("anomaly") * STEPS).cast("int")
    # the statistics without their features: a few bytes a row
    counts = scored.select(F.col("doc_id").alias("of"), step.alias("step")).join(marks, "of").groupBy("step").agg(F.sum((F.col("quality") > 0).cast("long")).alias("good"), F.sum((F.col("quality") <= 0).cast("long")).alias("bad"))
    rows = sorted((r.step, r.good, r.bad) for r in counts.collect())
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 2.0
    best, at = 0.0, 2.0
    rejected_good = rejected_bad = 0
    for step_, g, b in reversed(rows):
        rejected_good += g
        rejected_bad += b
        gain = rejected_bad / bad - rejected_good / good
        if rejected_good <= (1 - keep_good) * good and gain > best:
            best, at = gain, step_ / STEPS
    return at


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the base statistics, ``base_failed``, ``anomaly`` and ``kept``.

    Empty and null texts have no words and fail the base rules; repeated rows are judged alike; an empty table gives an empty result.
    """
    stats = durable(rule_statistics(docs), "quality-stats")
    scored = anomaly_scores(stats, fit_forest(stats))
    limit = calibrate(scored, labels)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select("doc_id", *BASE, failed.alias("base_failed"), (~failed & (F.col("anomaly") < F.lit(limit))).alias("kept"), "anomaly")


def model_json(forest: IsolationForest) -> str:
    """The forest as text, to keep beside a table of verdicts."""
    return json.dumps({"norm": forest.norm, "trees": [[x.tolist() for x in t] for t in forest.trees]})


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the base rules and the forest keep. Texts aren't shuffled: once the forest and its threshold
    are known, each task judges its own rows."""
    stats = durable(rule_statistics(docs), "quality-stats")
    forest = fit_forest(stats)
    limit = calibrate(anomaly_scores(stats, forest), labels)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        found = [statistics(t) for t in texts]
        rows = np.array([f for _, f in found], np.float32).reshape(len(found), -1)
        score = forest.score(rows) if forest and len(rows) else np.zeros(len(found))
        return pd.Series([not base_failed(b) and bool(s < limit) for (b, _), s in zip(found, score, strict=True)], dtype=bool)

    return docs.where(good(col(docs, "text", "string")))


def base_failed(base: tuple[int, ...]) -> bool:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return base[0] < 50 or 100 * base[4] > 50 * base[0]
