"""From raw documents to token records: quality rules, near-duplicates, benchmark decontamination, mixing, encoding.

Each stage reads what the one before kept. All but the last return the columns of ``documents``; the last returns the index of the
records that it wrote, as read back from them. A stage's result is to be written before the next stage begins: its intermediate tables
are deleted then, unless the next stage's ``docs`` still reads them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tickloom import ship
from tickloom.llm import decontam, mixing, neardup, qualityforest, queries, records
from tickloom.llm.common import remove, scratch_path, store, table, workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders with the intermediate tables of stages that have run.
_USED: list[str] = []


def _free(spark: SparkSession, docs: DataFrame) -> None:
    if _USED and not any(folder in file for file in docs.inputFiles() for folder in _USED):
        remove(spark, *_USED)
        _USED.clear()


def _stage(f: Stage) -> Stage:
    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        _free(spark, docs)
        with workspace(scratch_path(spark, f.__name__)) as folder:
            _USED.append(folder)
            return f(spark, docs, sf_dir)

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return qualityforest.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records are the pipeline's product: nothing that this stage writes is deleted later."""
    ship(spark)
    _free(spark, docs)
    return records.encode_table(docs, queries.tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", encode),
]
#: SQL can't express the isolation forest; tests/llm holds the stages against plain Python versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        path = scratch_path(spark, name.split()[0].lower().replace("/", "-"))
        docs = store(stage(spark, docs, sf_dir), path)
        remove(spark, *before)
        before = [path]
    return docs
