"""Table profile: per-column facts, top values, duplicates, target balance.

Blank text is not NULL; booleans are not numeric; top values are listed only
for non-numeric columns with 1–50 distinct values (10 most frequent, ties by
value ascending).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.functions.fingerprint import row_hash
from quaystone.functions.staging import staged
from quaystone.operators.measure import target_class_counts
from quaystone.operators.stats import low_card_value_counts, measure
from quaystone.session import checkpoint_dir

# Fixed values — profile cardinality limits.
MAX_TOP_VALUES_CARDINALITY = 50
TOP_VALUES_SHOWN = 10
PREVIEW_MAX = 50

COLUMNS_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("position", T.IntegerType()),
    T.StructField("dtype", T.StringType()), T.StructField("is_numeric", T.BooleanType()),
    T.StructField("null_count", T.LongType()), T.StructField("non_null_count", T.LongType()),
    T.StructField("unique_count", T.LongType()), T.StructField("blank_string_count", T.LongType()),
    T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType()),
    T.StructField("mean", T.DoubleType()), T.StructField("median", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
])


@dataclass
class Profile:
    columns: DataFrame          # one row per column
    top_values: DataFrame | None
    summary: DataFrame          # row_count, column_count, duplicate_row_count
    target_distribution: DataFrame | None


def profile_columns(df: DataFrame, exact_distinct: bool = True) -> tuple[DataFrame, object]:
    spark = df.sparkSession
    facts = measure(df, quantile_probs=(0.5,), exact_distinct=exact_distinct)
    rows = []
    for pos, c in enumerate(facts.order):
        f = facts.columns[c]
        rows.append((c, pos, f.dtype, f.is_numeric, f.null_count, f.non_null_count, f.unique_count,
                     f.blank_count, f.min, f.max, f.mean, f.quantiles.get(0.5) if f.is_numeric else None,
                     f.std))
    return spark.createDataFrame(rows, COLUMNS_SCHEMA), facts


def top_values(df: DataFrame, facts) -> DataFrame | None:
    """(column, value, count, rank) — the 10 most frequent values of each
    low-cardinality non-numeric column. The window only ever sees ≤ 50 rows
    per column, because high-cardinality columns are dropped before it."""
    vc = low_card_value_counts(df, facts, MAX_TOP_VALUES_CARDINALITY)
    if vc is None:
        return None
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    return (vc.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= TOP_VALUES_SHOWN))


# Repeated row hashes up to this many are broadcast to the exact pass.
BROADCAST_REPEATED_HASHES = 2_000_000


def duplicate_row_count(df: DataFrame) -> int:
    """Rows identical to an earlier row (all columns; NULLs equal each other).

    Full rows are only shuffled when they may be duplicates: 64-bit row
    hashes are counted first (map-side partial aggregation, 8 bytes a row).
    No repeated hash means no duplicate and no second pass. Otherwise the
    rows whose hash repeats are grouped by their full content; the repeated
    hashes are broadcast to that pass when their count (just measured) is
    bounded, else joined by a shuffle.
    """
    hashed = df.select(row_hash(df).alias("_qs_h"), *df.columns)
    # kept: counted first, then joined, in a stage of its own
    checkpoint_dir(df.sparkSession)
    repeated = (hashed.groupBy("_qs_h").agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > 1).select("_qs_h").checkpoint(eager=True))
    n_repeated = repeated.count()
    if n_repeated == 0:
        return 0
    side = F.broadcast(repeated) if n_repeated <= BROADCAST_REPEATED_HASHES else repeated
    exact = (hashed.join(side, "_qs_h", "left_semi")
             .groupBy("_qs_h", *df.columns).agg(F.count(F.lit(1)).alias("n")))
    row = exact.agg(F.sum(F.col("n") - 1).alias("dups")).collect()[0]
    return int(row["dups"] or 0)


def profile(df: DataFrame, target: str | None = None, exact_distinct: bool = True) -> Profile:
    """Columns, top values, duplicate count and target balance. The returned
    DataFrames are computed eagerly (small results), so a small input is kept
    only for the duration of this call."""
    spark: SparkSession = df.sparkSession
    with staged(df) as data:
        return _profile(spark, data, target, exact_distinct)


def _profile(spark: SparkSession, df: DataFrame, target: str | None, exact_distinct: bool) -> Profile:
    columns_df, facts = profile_columns(df, exact_distinct)
    summary = spark.createDataFrame(
        [(facts.row_count, len(df.columns), duplicate_row_count(df))],
        "row_count bigint, column_count int, duplicate_row_count bigint")
    target_df = None
    if target and target in df.columns:
        tf = facts.columns[target]
        if tf.value_counts is not None:
            # the distinct pass already counted every value of this
            # low-cardinality target; NULLs come from the scan's null count
            counts: dict[str, int] = dict(tf.value_counts)
            if tf.null_count:
                counts["null"] = counts.get("null", 0) + tf.null_count
            target_df = spark.createDataFrame(sorted(counts.items()), "value string, count bigint")
        else:
            # a row a value, however many: kept on the executors
            checkpoint_dir(spark)
            target_df = target_class_counts(df, target).checkpoint(eager=True)
    top = top_values(df, facts)
    # materialise the small results before the input is released
    top = spark.createDataFrame(top.collect(), top.schema) if top is not None else None
    return Profile(columns=columns_df, top_values=top, summary=summary, target_distribution=target_df)


def preview(df: DataFrame, order_by, n: int = 20) -> DataFrame:
    """The first ``n`` rows (1 ≤ n ≤ 50) of an explicit order."""
    if not 1 <= n <= PREVIEW_MAX:
        raise ValueError(f"n must be within 1..{PREVIEW_MAX}")
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*order).limit(n)


# ---------------------------------------------------------------------------
# column choices over a profile
# ---------------------------------------------------------------------------

def low_cardinality_columns(columns_df: DataFrame, target: str | None = None, k: int = 3,
                            lo: int = 2, hi: int = 10) -> DataFrame:
    """The first ``k`` non-numeric, non-target columns with lo..hi distinct values."""
    sel = columns_df.filter(~F.col("is_numeric") & F.col("unique_count").between(lo, hi))
    if target:
        sel = sel.filter(F.col("column") != target)
    return sel.orderBy("position").limit(k).select("column", "position", "unique_count")


def widest_spread_column(columns_df: DataFrame, target: str | None = None) -> DataFrame:
    """The numeric, non-target column with the largest standard deviation."""
    sel = columns_df.filter(F.col("is_numeric") & F.col("std").isNotNull())
    if target:
        sel = sel.filter(F.col("column") != target)
    return sel.agg(F.max_by("column", F.struct("std", -F.col("position"))).alias("column"),
                   F.max("std").alias("std"))
