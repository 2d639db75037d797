"""Distinct counts from sketches that are stored and merged: the opt-in for tables too large to group.

A sketch per column is made in one scan, partly in every task, and takes some
kilobytes whatever the rows. Sketches of days, files or partitions are stored as
a table and merged later, without reading the rows again. Estimates are within
about 1 % (three standard errors 2 %); counts up to some thousand are all but exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_SCHEMA = "column string, sketch binary, values long"
LOG_SIZE = 14  # 2**14 registers


def _hashed(df: DataFrame, name: str) -> Column:
    """A 64-bit hash of every value; null where it is missing (NaN is)."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        c = F.nanvl(c, F.lit(None).cast(df.schema[name].dataType)) + F.lit(0.0)  # -0.0 is 0.0
    return F.when(c.isNotNull(), F.xxhash64(c))


def sketch_columns(df: DataFrame, columns: list[str] | None = None, log_size: int = LOG_SIZE) -> DataFrame:
    """(column, sketch, values): a sketch of every column's values and how many there are; one scan."""
    columns = df.columns if columns is None else columns
    cells = [F.struct(F.lit(c).alias("column"), F.hll_sketch_agg(_hashed(df, c), log_size).alias("sketch"),
                      F.count(_hashed(df, c)).alias("values")) for c in columns]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def merge_sketches(stored: DataFrame) -> DataFrame:
    """The sketches of the same columns as one: as if made from all rows together."""
    return stored.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("values").alias("values"))


def distinct_estimates(sketched: DataFrame) -> DataFrame:
    """(column, distinct_estimate, values)."""
    return sketched.select("column", F.hll_sketch_estimate("sketch").alias("distinct_estimate"), "values")
