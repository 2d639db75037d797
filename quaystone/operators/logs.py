"""Log views: classify each line's level, filter, count, tail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values — recognised level words, most severe first.
LEVELS = ["CRITICAL", "ERROR", "WARNING", "WARN", "INFO", "DEBUG"]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line, level): the level is the most severe level word that stands
    between a space and a space or tab; lines without one are OTHER."""
    raw = spark.read.text(path).withColumn("_mono", F.monotonically_increasing_id())
    found = [F.when(F.col("value").rlike(f" {word}[ \\t]"), F.lit("WARNING" if word == "WARN" else word)) for word in LEVELS]
    level = F.coalesce(*found, F.lit("OTHER"))
    return raw.select(F.col("_mono").alias("line_no"), F.col("value").alias("line"), level.alias("level"))


def filter_levels(log: DataFrame, levels: list[str]) -> DataFrame:
    return log.filter(F.col("level").isin(levels))


def level_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("level").agg(F.count(F.lit(1)).alias("lines"))


def tail(log: DataFrame, n: int) -> DataFrame:
    """The last ``n`` lines (a bounded top-k, never the whole log on one task)."""
    return log.orderBy(F.desc("line_no")).limit(n).orderBy("line_no")


__all__ = ["LEVELS", "filter_levels", "level_counts", "read_log", "tail"]
