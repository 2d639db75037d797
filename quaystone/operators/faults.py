"""Seeded, pure fault injectors: DataFrame in → DataFrame out, never written
over their source. Position-based faults take an explicit total order; where the
rows end is found on the order's columns alone, the table itself is only filtered
or projected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.functions.ordering import first_rows, order_key, row_at


class FaultInjectionError(ValueError):
    pass


def _need(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise FaultInjectionError(f"column {column!r} not found")


def scale_change(df: DataFrame, column: str, factor: float = 100.0) -> DataFrame:
    """Multiply a column by ``factor``; its dtype stays the same."""
    _need(df, column)
    dt = df.schema[column].dataType
    return df.withColumn(column, (F.col(column) * F.lit(factor)).cast(dt))


def rename_column(df: DataFrame, old_name: str, new_name: str) -> DataFrame:
    _need(df, old_name)
    if new_name in df.columns:
        raise FaultInjectionError(f"column {new_name!r} already exists")
    return df.withColumnRenamed(old_name, new_name)


def drop_column(df: DataFrame, column: str) -> DataFrame:
    _need(df, column)
    return df.drop(column)


drop_required_column = drop_column


def change_dtype(df: DataFrame, column: str, dtype: str) -> DataFrame:
    _need(df, column)
    spark_type = {"int64": "bigint", "float64": "double", "str": "string", "bool": "boolean"}.get(dtype, dtype)
    return df.withColumn(column, F.col(column).cast(spark_type))


def inject_nulls(df: DataFrame, column: str, count: int, order_by) -> DataFrame:
    """NULL the column on the first ``count`` rows of the given order."""
    _need(df, column)
    if count < 0:
        raise FaultInjectionError(f"count={count} must be >= 0")
    if count == 0:
        return df
    last = row_at(df, count - 1, order_by)
    if last is None:
        raise FaultInjectionError(f"count={count} exceeds the table's rows")
    inside = order_key(order_by) <= last
    return df.withColumn(column, F.when(inside, F.lit(None).cast(df.schema[column].dataType)).otherwise(F.col(column)))


def unknown_category(df: DataFrame, column: str, new_value: str, order_by, row_index: int = 0) -> DataFrame:
    """Overwrite one cell (row ``row_index`` of the order) with a text value;
    the column becomes text."""
    _need(df, column)
    if row_index < 0:
        raise FaultInjectionError(f"row_index={row_index} must be >= 0")
    at = row_at(df, row_index, order_by)
    if at is None:
        raise FaultInjectionError(f"row_index={row_index} lies beyond the table's rows")
    return df.withColumn(column, F.when(order_key(order_by) == at, F.lit(new_value)).otherwise(F.col(column).cast("string")))


def flip_target_encoding(df: DataFrame, target: str) -> DataFrame:
    """Swap 0 ↔ 1; refuses anything but a 0/1 column."""
    _need(df, target)
    number = F.col(target).cast("string").try_cast("double")
    bad = df.filter(F.col(target).isNotNull() & ~F.coalesce(number.isin(0.0, 1.0), F.lit(False))).limit(1).count()
    if bad:
        raise FaultInjectionError(f"flip_target_encoding needs a 0/1 target; {target!r} has other values")
    dt = df.schema[target].dataType
    return df.withColumn(target, (F.lit(1) - F.col(target)).cast(dt))


def truncate_dataset(df: DataFrame, keep_rows: int, order_by) -> DataFrame:
    """Keep the first ``keep_rows`` rows of the given order."""
    if keep_rows < 0:
        raise FaultInjectionError(f"keep_rows={keep_rows} must be >= 0")
    return first_rows(df, keep_rows, order_by)


def apply_fault(df: DataFrame, name: str, **kw) -> DataFrame:
    table = {
        "scale_change": scale_change, "rename_column": rename_column,
        "drop_required_column": drop_column, "drop_column": drop_column,
        "change_dtype": change_dtype, "inject_nulls": inject_nulls,
        "unknown_category": unknown_category, "flip_target_encoding": flip_target_encoding,
        "truncate_dataset": truncate_dataset,
    }
    if name not in table:
        raise FaultInjectionError(f"unknown fault {name!r}")
    return table[name](df, **kw)


__all__ = ["FaultInjectionError", "apply_fault", "change_dtype", "drop_column", "drop_required_column",
           "flip_target_encoding", "inject_nulls", "rename_column", "scale_change", "truncate_dataset",
           "unknown_category"]
