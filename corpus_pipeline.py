"""The training-corpus pipeline: quality rules, near-duplicate removal,
benchmark decontamination, source mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet in the shared checkpoint folder and read again as the next
stage's ``docs``.  All but the last return the columns of ``docs``.

As a stage begins only when its predecessor's result has been written, it first
removes the scratch tables that the predecessor's last call has left; other
results that are still lazy keep theirs.

Rows are told apart by their place, not by ``doc_id``: rows without one and rows
that repeat one are judged each by its own text.  An empty table passes through
all stages.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tradelake.llm import decontamination, mixing, near_dedup, quality, sharding
from tradelake.llm.scratch import scope, sweep, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Scratch tables of the last call of the stage before each stage, by its place.
_LEFT: dict[int, list[str]] = {}


def _stage(nth: int) -> Callable[[Stage], Stage]:
    def wrap(work: Stage) -> Stage:
        @wraps(work)
        def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            sweep(spark, _LEFT.pop(nth, []))
            with scope() as made:
                out = work(spark, docs, sf_dir)
            _LEFT[nth + 1] = made
            return out
        return begin
    return wrap


@_stage(0)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior rejects go."""
    return quality.keep_documents(docs)


@_stage(1)
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.unique_documents(docs)


@_stage(2)
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage(3)
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mixed_documents(docs)


@_stage(4)
def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shards),
]

#: SQL expresses neither EM nor components nor windows over words at this size;
#: the tests hold the pipeline against its brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = written(docs, name, keep=True)
    return docs
