"""Cleaning-plan executor: a left fold of lazy DataFrame transforms.

Only statistics that an operation needs (an impute value, the unmapped-value
probe, the int-cast NULL probe) trigger a job; each is a distributed
aggregate returning one small row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.functions.columns import numeric_or_null, truthy, value_text
from quaystone.functions.quantiles import exact_median
from quaystone.operators.stats import EXACT_MEAN_TYPE
from quaystone.plans.cleaning import (
    Cast,
    CleaningPlan,
    Clip,
    DropColumn,
    DropDuplicates,
    Impute,
    Rename,
    StandardizeCategory,
)

# How many unmapped values an error message names (the check itself is exact).
LISTED_UNMAPPED = 20


class CleaningExecutionError(ValueError):
    pass


def _need(df: DataFrame, column: str, op: str) -> None:
    if column not in df.columns:
        raise CleaningExecutionError(f"cannot {op}: the table has no column {column!r}")


def drop_duplicates(df: DataFrame, subset=None, order_by=None) -> DataFrame:
    """Keep one row per duplicate group. Without ``subset`` the rows are
    identical, so any copy will do. With ``subset`` the first row of
    ``order_by`` (default: all other columns) is kept, chosen by ``min_by``,
    which aggregates map-side — a hot key never lands whole in one task."""
    if not subset:
        return df.dropDuplicates()
    subset = list(subset)
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.dropDuplicates(subset)
    order = [order_by] if isinstance(order_by, str) else list(order_by or rest)
    kept = (df.groupBy(*subset)
            .agg(F.min_by(F.struct(*[F.col(c) for c in rest]),
                          F.struct(*[F.col(c) for c in order])).alias("_qs_row")))
    return kept.select(*[F.col(c) if c in subset else F.col(f"_qs_row.{c}").alias(c) for c in df.columns])


def mode_value(df: DataFrame, column: str):
    """Most frequent value that is not missing, smallest on ties (from the value counts, no single-task map of all values)."""
    dt = df.schema[column].dataType
    value = F.nanvl(F.col(column), F.lit(None).cast(dt)) if isinstance(dt, (T.DoubleType, T.FloatType)) else F.col(column)
    counts = df.select(value.alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by("v", F.struct(-F.col("n"), "v"))).first()[0]


def impute(df: DataFrame, column: str, strategy: str, value=None) -> DataFrame:
    _need(df, column, "impute")
    dt = df.schema[column].dataType
    if strategy == "constant":
        fill = value
    elif strategy == "mean":
        # in decimal, so that the sum does not depend on its order, unless a value does not fit
        x = numeric_or_null(column, dt)
        exact = x.try_cast(EXACT_MEAN_TYPE)
        row = df.agg(F.avg(x).alias("v"), F.avg(exact).cast("double").alias("e"), F.count(x) == F.count(exact)).first()
        fill = row["e"] if row[2] else row["v"]
    elif strategy == "median":
        fill = exact_median(df.select(numeric_or_null(column, dt).alias(column)), column)
    elif strategy == "mode":
        fill = mode_value(df, column)
        if fill is None:
            raise CleaningExecutionError(f"cannot fill {column!r} with its most frequent value: it has none")
    else:
        raise CleaningExecutionError(f"no way to fill is called {strategy!r}")
    if fill is None:
        return df
    lit = F.lit(fill)
    if isinstance(dt, T.IntegralType) and strategy in ("mean", "median") and float(fill) != int(float(fill)):
        # a fractional fill widens an integer column, as a float column would
        return df.withColumn(column, F.coalesce(F.col(column).cast("double"), lit.cast("double")))
    held = F.nanvl(F.col(column), F.lit(None).cast(dt)) if isinstance(dt, (T.DoubleType, T.FloatType)) else F.col(column)
    typed = lit.try_cast(dt) if not isinstance(dt, T.StringType) else lit.cast("string")
    probe = df.sparkSession.range(1).select(typed.alias("v")).collect()[0]["v"]
    if probe is None:
        raise CleaningExecutionError(f"{column!r} ({dt.simpleString()}) cannot hold the fill value {fill!r}")
    return df.withColumn(column, F.coalesce(held, typed))


def cast(df: DataFrame, column: str, target_dtype: str) -> DataFrame:
    _need(df, column, "cast")
    dt = df.schema[column].dataType
    if target_dtype == "float64":
        return df.withColumn(column, numeric_or_null(column, dt))
    if target_dtype == "int64":
        if isinstance(dt, T.IntegralType):
            return df.withColumn(column, F.col(column).cast("bigint"))
        x = numeric_or_null(column, dt)
        nulls = df.agg(F.count_if(x.isNull()).alias("n")).collect()[0]["n"]
        if nulls:
            raise CleaningExecutionError(
                f"{column!r} cannot become a whole number: {nulls} row(s) have no number (fill them first)")
        return df.withColumn(column, x.cast("bigint"))
    if target_dtype == "str":
        return df.withColumn(column, value_text(column, dt))
    if target_dtype == "bool":
        return df.withColumn(column, truthy(column, dt))
    raise CleaningExecutionError(f"no cast leads to {target_dtype!r}")


def rename(df: DataFrame, old_name: str, new_name: str) -> DataFrame:
    _need(df, old_name, "rename")
    if new_name in df.columns:
        raise CleaningExecutionError(f"{new_name!r} is taken by another column")
    return df.withColumnRenamed(old_name, new_name)


def drop_column(df: DataFrame, column: str) -> DataFrame:
    _need(df, column, "drop_column")
    return df.drop(column)


def clip(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    """Bound values; NULL stays NULL (greatest/least alone would replace it)."""
    _need(df, column, "clip")
    dt = df.schema[column].dataType
    c = F.col(column)
    x = c
    if lo is not None:
        x = F.greatest(x, F.lit(lo))
    if hi is not None:
        x = F.least(x, F.lit(hi))
    keep_type = isinstance(dt, T.IntegralType) and all(b is None or float(b).is_integer() for b in (lo, hi))
    x = x.cast(dt) if keep_type or not isinstance(dt, T.IntegralType) else x.cast("double")
    return df.withColumn(column, F.when(c.isNull(), F.lit(None).cast(x_type(dt, keep_type))).otherwise(x))


def x_type(dt, keep_type: bool):
    return dt if keep_type or not isinstance(dt, T.IntegralType) else T.DoubleType()


def standardize_category(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Remap text values; fails if any non-null value has no mapping."""
    _need(df, column, "standardize_category")
    dt = df.schema[column].dataType
    text = value_text(column, dt)
    keys = [str(k) for k in mapping]
    unmapped = df.select(text.alias("v")).where(F.col("v").isNotNull() & ~F.col("v").isin(keys)).distinct()
    found = (unmapped.orderBy("v").limit(LISTED_UNMAPPED).agg(F.sort_array(F.collect_list("v")).alias("v"))
             .crossJoin(unmapped.agg(F.count(F.lit(1)).alias("n")))).first()  # one row each
    if found["n"]:
        raise CleaningExecutionError(f"the mapping of {column!r} leaves out {found['n']} value(s), the first being {found['v']}")
    lookup = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(str(k)), F.lit(str(v)))])
    return df.withColumn(column, F.element_at(lookup, text))


def execute_plan(df: DataFrame, plan: CleaningPlan, order_by=None) -> DataFrame:
    """Apply every operation in order; returns the (lazy) clean DataFrame."""
    out = df
    for op in plan.operations:
        if isinstance(op, DropDuplicates):
            out = drop_duplicates(out, op.subset, order_by)
        elif isinstance(op, Impute):
            out = impute(out, op.column, op.strategy, op.value)
        elif isinstance(op, Cast):
            out = cast(out, op.column, op.target_dtype)
        elif isinstance(op, Rename):
            out = rename(out, op.old_name, op.new_name)
        elif isinstance(op, DropColumn):
            out = drop_column(out, op.column)
        elif isinstance(op, Clip):
            out = clip(out, op.column, op.min, op.max)
        elif isinstance(op, StandardizeCategory):
            out = standardize_category(out, op.column, op.mapping)
        else:
            raise CleaningExecutionError(f"not a cleaning operation: {op!r}")
    return out
