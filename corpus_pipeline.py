"""A corpus pipeline: documents through quality rules, two kinds of deduplication, mixing and packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.bin_slack import pack
from tidemill.llm.exact_dedup import drop_copies
from tidemill.llm.line_quality import cleaned
from tidemill.llm.ngram_join import one_of_each
from tidemill.llm.source_mix import mixed_documents
from tidemill.session import pin_settings, remove, scratch_made, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Tables that the stage before needed to work out its rows.
_HELD: list[str] = []


def _writes(stage: Stage) -> Stage:
    """A stage whose rows are written before the next stage is called, which then removes its tables."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _release(spark)
        before = set(scratch_made())
        out = stage(spark, docs, sf_dir)
        _HELD.extend(path for path in scratch_made() if path not in before)
        return out

    return run


def _release(spark: SparkSession) -> None:
    while _HELD:
        remove(spark, _HELD.pop())


@_writes
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their hosts' boilerplate lines."""
    return cleaned(docs)


@_writes
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return drop_copies(docs)


@_writes
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies."""
    return one_of_each(docs)


@_writes
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document taken twice comes twice."""
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of a document in the packed sequences; its tables stay, for whoever reads it."""
    _release(spark)
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: Near copies, the mix's permutations and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a table that the next one reads."""
    docs = pin_settings(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
