"""Claim checks: every reported number must exist in the measured results.

* evidence keys: a claim citing a stat key absent from the stats table is
  rejected (left-anti join);
* metric claims: a claimed (variant, split, metric) value must equal the
  measured one exactly — unknown keys and mismatches are both reported
  (left join);
* dependencies: at least one declared dependency must equal a contract
  assumption verbatim (left-semi join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_evidence(claims: DataFrame, stats: DataFrame, key_col: str = "evidence_stat_key") -> DataFrame:
    """Claims whose evidence key is not in ``stats.stat_key``."""
    keys = stats.select(F.col("stat_key").alias(key_col)).distinct()
    return claims.join(keys, key_col, "left_anti")


def check_metric_claims(claims: DataFrame, experiments: DataFrame) -> DataFrame:
    """claims(variant, split, metric, value) → + measured, status ∈ {ok, mismatch, unknown}."""
    measured = experiments.select("variant", "split", "metric", F.col("value").alias("measured"))
    j = claims.join(measured, ["variant", "split", "metric"], "left")
    status = (F.when(F.col("measured").isNull(), F.lit("unknown"))
              .when(F.col("measured") == F.col("value"), F.lit("ok")).otherwise(F.lit("mismatch")))
    return j.withColumn("status", status)


def supported_dependencies(dependencies: DataFrame, assumptions: DataFrame) -> DataFrame:
    """Declared dependencies that match an assumption verbatim."""
    return dependencies.join(assumptions.select(F.col("assumption").alias("dependency")).distinct(),
                             "dependency", "left_semi")
