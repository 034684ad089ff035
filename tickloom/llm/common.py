"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import durable, remove, scratch_path, small, store, workspace

__all__ = ["durable", "remove", "scratch_path", "small", "store", "workspace"]

#: A word, as the operators here take it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
#: Near-duplicate threshold as a fraction of whole numbers: 75 / 100.
SIMILAR = (75, 100)

_U = np.uint64
_MULT = (np.random.default_rng(20240117).integers(0, 2**63, 64, dtype=np.uint64) << _U(1)) | _U(1)


def shared_store(uri: str):  # noqa: ANN201
    """The store and the path in it of a folder that executors share: file, hdfs or an object store."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file://") else "file://" + uri[5:])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name`` of ``df`` cast to ``kind``; null where the table lacks it."""
    return df[name].cast(kind) if name in df.columns else F.lit(None).cast(kind)


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), inside whole-stage code."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class WordHashes(dict):
    """64-bit hashes of byte words, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 150_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(words: list[bytes], seen: WordHashes) -> np.ndarray:
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values; with fewer values, of the whole sequence as one."""
    k = len(hashes)
    if k == 0:
        return np.empty(0, np.uint64)
    m = min(n, k)
    out = np.zeros(k - m + 1, np.uint64)
    for i in range(m):
        out += hashes[i : i + k - m + 1] * _MULT[i]
    return mix(out + _U(m))


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased: ``bytes`` methods know ASCII letters and white space only, as the definition asks."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None, seen: WordHashes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``n``-word shingles."""
    return np.unique(runs(word_hashes(words_of(text), seen), n))
