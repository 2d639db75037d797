"""Table identity that does not depend on how a table is split into files.

A Spark dataset is many files whose bytes depend on partitioning, so the
default identity is an order-insensitive row fingerprint computed in one
distributed aggregate: row count, the sum and the xor of a 64-bit hash of
every row (null positions included in the hash), folded with the ordered
column names and dtypes. Any changed cell, dropped/added row, renamed or
reordered column changes it; repartitioning, file layout and row order do
not. ``file_manifest_fingerprint`` hashes file bytes instead, when the exact
files are the contract.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystone.functions.columns import dtype_name

FINGERPRINT_PREFIX = "rows-v1:"


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a whole row; NULL in column i differs from a value."""
    parts = []
    for f in df.schema.fields:
        parts.append(F.col(f.name).isNull())
        parts.append(F.col(f.name))
    return F.xxhash64(*parts)


def fingerprint_aggs(df: DataFrame, prefix: str = "_fp") -> list[Column]:
    """Aggregate expressions to embed in a larger single-scan ``agg``."""
    h = row_hash(df)
    return [
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.sum(h.cast("decimal(38,0)")).alias(f"{prefix}_sum"),
        F.bit_xor(h).alias(f"{prefix}_xor"),
    ]


def fingerprint_from_row(df: DataFrame, row, prefix: str = "_fp") -> str:
    schema_text = ",".join(f"{f.name}:{dtype_name(f.dataType)}" for f in df.schema.fields)
    payload = f"{schema_text}|{row[f'{prefix}_rows']}|{row[f'{prefix}_sum'] or 0}|{row[f'{prefix}_xor'] or 0}"
    return FINGERPRINT_PREFIX + hashlib.sha256(payload.encode("utf-8")).hexdigest()


def table_fingerprint(df: DataFrame) -> str:
    """Order- and layout-insensitive fingerprint of a DataFrame (one scan)."""
    row = df.agg(*fingerprint_aggs(df)).collect()[0]
    return fingerprint_from_row(df, row)


def file_manifest_fingerprint(spark, path: str) -> str:
    """SHA-256 over the sorted (relative file name, per-file SHA-256) list.

    File contents are hashed on the executors; only one short row per file
    reaches the driver.
    """
    files = (spark.read.format("binaryFile").load(path)
             .select(F.element_at(F.split("path", "/"), -1).alias("name"),
                     F.sha2("content", 256).alias("sha"))
             .orderBy("name").collect())
    digest = hashlib.sha256()
    for r in files:
        digest.update(f"{r['name']}:{r['sha']}\n".encode("utf-8"))
    return "files-v1:" + digest.hexdigest()


def md5_buckets(df: DataFrame, chars: int = 1) -> DataFrame:
    """(bucket, rows): rows counted by the first ``chars`` hex digits of the
    md5 of their canonical text ('|'-joined values, NULL as \\N). The same
    expression runs in any SQL engine, so two engines can compare a table's
    identity without moving it."""
    parts = [F.coalesce(F.col(f.name).cast("string"), F.lit("\\N")) for f in df.schema.fields]
    return (df.groupBy(F.substring(F.md5(F.concat_ws("|", *parts)), 1, chars).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows")))
