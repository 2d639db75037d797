"""A corpus pipeline: quality, near copies, benchmark items, source mix, shards.

Every stage takes (spark, docs, sf_dir) and works on all rows the one before
kept; all but the last return the columns of docs as they were. Empty tables
pass through; null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaystone.llm import decontaminate, jaccard, mix, quality, shard
from quaystone.llm.common import documents, quoted, stage
from quaystone.session import apply_conf


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, documents(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, names=("_quality_score", "_quality_ok"))
    return scored.where("_quality_ok = 1").select(*[quoted(c) for c in docs.columns])


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the least doc_id."""
    return jaccard.drop_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, documents(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target of its source asks for."""
    return mix.mix(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in 24 shuffled shards, with shard and slot."""
    return shard.shard_rows(docs, 24)


def _configured(stage_fn):
    """The stage under the session settings that the operators rely on."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return stage_fn(spark, docs, sf_dir)
    return run_stage


STAGES = [(name, _configured(fn)) for name, fn in [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mix_stage),
    ("sharding", shard_stage),
]]

# The classifier and the shuffle can't be written in SQL; tests/llm/test_pipeline_plain.py has a plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage_fn in STAGES[:-1]:
        docs = stage(stage_fn(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
