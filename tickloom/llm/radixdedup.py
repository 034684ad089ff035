"""Removal of repeated byte windows: a suffix sort that stops at the window's length, by most-significant-digit passes.

The suffixes of interest are those with ``WINDOW`` bytes left in their text. The first digit is the hash of the window's anchor, the
``GRAM`` bytes with the smallest hash in it: equal windows have equal anchors at equal offsets, and consecutive windows share theirs, so
one row stands for a run of suffixes. Runs that are equal are repeated as a whole (first digit and hash of the run: 128 bits); runs that
share the first digit alone are read again, and their suffixes are put in order eight bytes at a time: a pass sorts the members of each
group by their next digit, and those that are alone leave. Groups of two or more after the last digit are exactly the repeated windows.
Groups of more runs than a task sorts at once are settled by the shuffle: there one digit is the hash of the whole window, which has 128
bits together with the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, durable, mix, small

WINDOW, GRAM = 200, 24
#: Runs of one first digit that one task sorts; larger groups go through the shuffle, suffix by suffix.
IN_TASK = 4_000
#: Suffixes that are sorted at once in a task.
AT_ONCE = 4_000_000
#: Rows of a first digit from which it is joined by a broadcast, so that its rows stay where they are.
HOT = 10_000
_U = np.uint64
_B = _U(0x9E3779B97F4A7C15)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, which has their order."""
    return np.ndarray((len(data) - 7,), ">u8", np.ascontiguousarray(data), strides=(1,)) if len(data) >= 8 else np.empty(0, np.uint64)


def anchors(data: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(lo, hi, at, digit)`` of each run of windows: their first and last start, where their anchor is, and its hash."""
    n = len(data) - window + 1
    if n < 1:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    e = eights(data).astype(np.uint64)
    h = np.zeros(len(data) - GRAM + 1, np.uint64)
    for i in range(0, GRAM, 8):
        h = mix(h * _B + e[i : i + len(h)])
    # the place below the hash's upper bits: of equal ones the leftmost wins, whatever the text's length
    placed = (h >> _U(31) << _U(31)) | np.arange(len(h), dtype=np.uint64)
    # minima of w values in a row, from the minima of blocks up to and from each place
    w = window - GRAM + 1
    padded = np.full(-(-len(h) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(h)] = placed
    blocks = padded.reshape(-1, w)
    until = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(since[:n], until[w - 1 : w - 1 + n]) & _U((1 << 31) - 1)).astype(np.int64)
    lo = np.flatnonzero(np.diff(at, prepend=-1))
    return lo, np.append(lo[1:], n) - 1, at[lo], h[at[lo]]


_INVERSE = _U(pow(int(_B), -1, 1 << 64))


def range_hashes(data: np.ndarray, lo: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the byte ranges, the same for equal bytes wherever they are."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_B, n)[:-1], out=prefix[1:])
    return mix((prefix[end] - prefix[lo]) * _powers(_INVERSE, n)[lo])


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base)
    out[0] = 1
    return np.multiply.accumulate(out)


def run_rows(docs: DataFrame) -> DataFrame:
    """``(g, c, k, j, lo, hi, at)``: each run of each text; ``g`` and ``c`` are its digits, ``k, j`` its text's key. A text that repeats in a task is
    sent once more only, which is all that counting needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: dict[tuple[int, int], int] = {}
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for k, j, text in zip(*(batch.column(x).to_pylist() for x in ("k", "j", "text")), strict=True):
                if (seen := times.get((k, j), 0)) > 1:
                    continue
                if len(times) > 500_000:
                    times.clear()
                times[k, j] = seen + 1
                data = _bytes(text)
                lo, hi, at, g = anchors(data)
                if len(lo):
                    c = mix(range_hashes(data, lo, hi + WINDOW) ^ g * _B ^ (at - lo).astype(np.uint64))
                    out.append((g.view(np.int64), c.view(np.int64), np.full(len(lo), k, np.int64), *(x.astype(np.int32) for x in (np.full(len(lo), j), lo, hi, at))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["g", "c", "k", "j", "lo", "hi", "at"])

    return docs.select("k", "j", "text").mapInArrow(run, "g long, c long, k long, j int, lo int, hi int, at int")


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def run_bytes(docs: DataFrame, need: DataFrame) -> DataFrame:
    """``(g, c, o, bytes)`` for the runs of ``need`` (g, c, k, j, lo, hi, at, rep), read from the texts; ``o`` is the anchor's offset in the run."""
    by_text = need.groupBy(F.col("k").alias("of"), F.col("j").alias("of2"), "rep").agg(F.collect_list(F.struct("g", "c", "lo", "hi", "at")).alias("runs"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, own in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["g"] for r in own], pa.int64()), pa.array([r["c"] for r in own], pa.int64()), pa.array([r["at"] - r["lo"] for r in own], pa.int32()), pa.array([data[r["lo"] : r["hi"] + WINDOW] for r in own], pa.binary())],
                    ["g", "c", "o", "bytes"],
                )

    met = docs.join(by_text, (F.col("k") == F.col("of")) & (F.col("j") == F.col("of2")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("text", "runs")
    return met.mapInArrow(read, "g long, c long, o int, bytes binary")


def radix(first: np.ndarray, digits: np.ndarray, starts: np.ndarray, passes: int) -> np.ndarray:
    """Which of the suffixes at ``starts`` share their first digit and all ``passes`` more digits of eight bytes with another one.

    ``alive`` is kept in order: each pass sorts by the next digit within the groups whose members differ in it. Suffixes alone in their
    group leave before the next pass.
    """
    alive = np.argsort(first, kind="stable")
    fresh = np.diff(first[alive], prepend=first[alive[:1]]) != 0  # where a group begins
    fresh[:1] = True
    for i in range(passes + 1):
        together = ~(fresh & np.append(fresh[1:], True))
        alive, fresh = alive[together], fresh[together]
        if i == passes or not len(alive):
            break
        d = digits[starts[alive] + 8 * i].astype(np.uint64)
        differs = np.append(False, d[1:] != d[:-1]) & ~fresh
        if differs.any():
            group = np.cumsum(fresh) - 1
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[group[differs]] = True
            at = np.flatnonzero(mixed[group])
            order = at[np.lexsort((d[at], group[at]))]
            alive[at], d[at] = alive[order], d[order]
            fresh |= np.append(False, d[1:] != d[:-1])
    return np.sort(alive)


def suffixes(offsets: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For runs laid end to end: each suffix's run, start within it, place in the data, and first digit (group and offset to the anchor)."""
    n = sizes - WINDOW + 1
    run = np.repeat(np.arange(len(sizes)), n)
    rel = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    base = np.cumsum(sizes) - sizes
    return run, rel, base[run] + rel, mix(groups[run].view(np.uint64) ^ mix((offsets[run] - rel).astype(np.uint64)))


def ranges(run: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(run, first, last)`` of the stretches of consecutive starts; both arrays are in order."""
    cut = np.flatnonzero((np.diff(run, prepend=-1) != 0) | (np.diff(rel, prepend=-2) != 1))
    last = np.append(cut[1:], len(rel)) - 1
    return run[cut], rel[cut], rel[last] if len(cut) else rel[:0]


def sort_groups(rows: DataFrame) -> DataFrame:
    """``(g, c, r0, r1)``: the repeated windows of each run, by start, for groups of at most IN_TASK runs. ``rows`` are dealt and sorted by g."""
    kind = pa.schema([("g", pa.int64()), ("c", pa.int64()), ("r0", pa.int32()), ("r1", pa.int32())])

    def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        g, c, o = (t.column(x).to_numpy() for x in ("g", "c", "o"))
        _, one = np.unique(c, return_index=True)  # a run that came twice counts once
        own = t.column("bytes").to_pylist()
        g, c, o, own = g[one], c[one], o[one].astype(np.int64), [own[i] for i in one]
        data = np.frombuffer(b"".join(own), np.uint8)
        run, rel, at, first = suffixes(o, np.fromiter(map(len, own), np.int64, len(own)), g)
        stay = radix(first, eights(data), at, WINDOW // 8)
        run, r0, r1 = ranges(run[stay], rel[stay])
        return pa.RecordBatch.from_arrays([pa.array(g[run]), pa.array(c[run]), pa.array(r0, pa.int32()), pa.array(r1, pa.int32())], schema=kind)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column("g").to_numpy()
            own = batch.column("bytes").nbytes
            if held and size + own > AT_ONCE:
                # up to where the last group of what is held ends
                last = held[-1].column("g")[-1].as_py()
                end = int(np.searchsorted(g, last, side="right"))
                if end:
                    held.append(batch.slice(0, end))
                if end == len(g):
                    size += own
                    continue
                yield done(held)
                batch = batch.slice(end)
                held, size = [], 0
            held.append(batch)
            size += own
        if held:
            yield done(held)

    return rows.mapInArrow(sort, "g long, c long, r0 int, r1 int")


def sort_by_shuffle(rows: DataFrame) -> DataFrame:
    """The same for groups of any size: the suffixes themselves go through the shuffle, as their first digit and a hash of their bytes."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, c, o, own in zip(*(batch.column(x).to_pylist() for x in ("g", "c", "o", "bytes")), strict=True):
                data = np.frombuffer(own, np.uint8)
                run, rel, at, first = suffixes(np.array([o]), np.array([len(own)]), np.array([g]))
                s = mix(first ^ range_hashes(data, at, at + WINDOW)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(np.full(len(s), g)), pa.array(np.full(len(s), c)), pa.array(rel.astype(np.int32))], ["s", "g", "c", "r"])

    every = rows.dropDuplicates(["g", "c"]).mapInArrow(spread, "s long, g long, c long, r int")
    every = durable(every, "suffixes")
    twice = every.groupBy("g", "s").agg(F.count("*").alias("n")).where("n > 1").select("g", "s")
    return every.join(twice, ["g", "s"]).select("g", "c", F.col("r").alias("r0"), F.col("r").alias("r1"))


def with_counts(rows: DataFrame, counts: DataFrame, n: str) -> DataFrame:
    """``rows`` joined to the written table ``counts`` (g, ``n``) by g. Rows of a digit with more than HOT rows meet it by a broadcast: there is at
    most one such digit for every HOT rows, and they are counted before they are sent."""
    hot = durable(counts.where(F.col(n) > HOT), "hot")
    if hot.isEmpty():
        return rows.join(counts, "g")
    cold = rows.join(small(hot.select("g")), "g", "left_anti").join(counts.where(F.col(n) <= HOT), "g")
    return cold.unionByName(rows.join(small(hot), "g"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``(of, of2, spans)``: for each text key the ranges ``(first, last)`` of starts of windows that occur elsewhere. ``docs`` has doc_id, text, k, j."""
    every = durable(run_rows(docs), "runs")
    shared = durable(every.groupBy("g").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    kept = durable(with_counts(every, shared, "n").drop("n"), "shared-runs")
    equal = kept.groupBy("g", "c").agg(F.count("*").alias("n"), *(F.any_value(x).alias(x) for x in ("k", "j", "lo", "hi", "at")))
    equal = durable(equal, "equal-runs")
    groups = durable(equal.groupBy("g").agg(F.count("*").alias("classes")).where("classes > 1"), "groups")
    reps = docs.groupBy("k", "j").agg(F.min("doc_id").alias("rep"))
    need = with_counts(equal.drop("n"), groups, "classes").join(reps, ["k", "j"]).select("g", "c", "k", "j", "lo", "hi", "at", "rep", "classes")
    need = durable(need, "needed-runs")
    parts = [equal.where("n > 1").select("g", "c", F.lit(0).alias("r0"), (F.col("hi") - F.col("lo")).alias("r1"))]
    few, many = need.where(F.col("classes") <= IN_TASK), need.where(F.col("classes") > IN_TASK)
    parts.append(sort_groups(run_bytes(docs, few).repartition("g").sortWithinPartitions("g")))
    if not many.isEmpty():
        parts.append(sort_by_shuffle(run_bytes(docs, many)))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = durable(found, "repeated")
    spans = kept.join(found, ["g", "c"]).select("k", "j", F.struct((F.col("lo") + F.col("r0")).alias("first"), (F.col("lo") + F.col("r1")).alias("last")).alias("span"))
    return spans.groupBy(F.col("k").alias("of"), F.col("j").alias("of2")).agg(F.collect_set("span").alias("spans"))


def covered(n: int, spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by windows with these starts."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["first"], s["last"] + WINDOW) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return [(a, min(b, n)) for a, b in out]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` for every row of ``docs`` (doc_id, text).

    Each byte goes that is covered by a 200-byte string which also starts elsewhere, in any row or the same; strings are judged on the
    input. Null texts are empty; repeated rows are copies of each other, and so lose all from 200 bytes on; ids may be null or repeat.
    ``removed`` has the byte ranges. An empty table gives an empty result.
    """
    rows = docs.select(col(docs, "doc_id", "long").alias("doc_id"), F.coalesce(col(docs, "text", "string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"k": F.xxhash64("text"), "j": F.hash("text")})  # 96 bits that stand for a text
    spans = durable(repeated_windows(rows.where(F.octet_length("text") >= WINDOW)), "removed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                gone = covered(len(data), own)
                digest, at = hashlib.sha256(), 0
                for a, b in gone:
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                out.append((len(data), sum(b - a for a, b in gone), len(gone), digest.hexdigest(), [{"start": a, "end": b} for a, b in gone]))
            c = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(c, kinds, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    met = rows.join(spans, (F.col("k") == F.col("of")) & (F.col("j") == F.col("of2")), "left").select("doc_id", "text", "spans")
    return met.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>")
