"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.session import checkpoint_dir

# The characters that separate words.
SPACE_CHARS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"

_HASHABLE = ("map", "variant", "interval")


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor never recomputes what led here) and keeps a
    table that several later jobs read from being computed once per reader.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def payload(df: DataFrame, columns: Iterable[str], taken: Sequence[str]) -> list[Column]:
    """``columns`` of ``df`` by position, renamed with ``_src`` where a result column has their name."""
    out, used = [], {t.lower() for t in taken}
    for name in columns:
        alias = name
        while alias.lower() in used:
            alias += "_src"
        used.add(alias.lower())
        out.append(F.col(quoted(name)).alias(alias))
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_hash(df: DataFrame, seed: int) -> Column:
    """A seeded 64-bit hash over every hashable column of a row."""
    cols = [F.col(quoted(f.name)) for f in df.schema.fields
            if not any(k in f.dataType.simpleString() for k in _HASHABLE)]
    return F.xxhash64(F.lit(seed), *cols)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
