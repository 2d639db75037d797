"""Descriptive statistics as a long table keyed ``<column>.<stat>[.<category>]``,
plus correlations, histograms and category target-rate series.

All of it is a few jobs regardless of width: the per-column scan of
``operators.stats``, one ``unpivot`` + ``groupBy(column, value)`` for the
target rate of every categorical column at once, and one accumulator of
co-moments for all correlation pairs of a block of columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.functions import comoments
from quaystone.functions.columns import is_numeric_type, numeric_or_null
from quaystone.functions.staging import staged
from quaystone.operators.stats import measure, unpivot_text

# Fixed value — target rates are broken down only for columns with at most
# this many categories.
MAX_CATEGORIES_FOR_TARGET_RATE = 20
HISTOGRAM_BINS = 30

STATS_SCHEMA = T.StructType([
    T.StructField("stat_key", T.StringType()), T.StructField("column", T.StringType()),
    T.StructField("stat", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def _binary_target(df: DataFrame, target: str | None) -> bool:
    if not target or target not in df.columns or not is_numeric_type(df.schema[target].dataType):
        return False
    t = F.col(target)
    bad = df.filter(t.isNotNull() & ~t.cast("double").isin(0.0, 1.0)).limit(1).count()
    return bad == 0


def eda_stats(df: DataFrame, target: str | None = None) -> DataFrame:
    """Long stats table (stat_key, column, stat, category, value), computed
    eagerly (one small row per statistic)."""
    with staged(df) as data:
        out = _eda_stats(data, target)
        return df.sparkSession.createDataFrame(out.collect(), STATS_SCHEMA)


def _eda_stats(df: DataFrame, target: str | None) -> DataFrame:
    spark = df.sparkSession
    types = {f.name: f.dataType for f in df.schema.fields}
    binary = _binary_target(df, target)
    others = [c for c in df.columns if c != target]
    extra = {}
    if binary:
        t = F.col(target).cast("double")
        extra = {"_t_mean": F.avg(t), "_t_sum": F.sum(t), "_t_rows": F.count(F.lit(1))}
    facts = measure(df, others, quantile_probs=(0.5,), extra_aggs=extra)

    rows = [("dataset.row_count", "dataset", "row_count", None, float(facts.row_count)),
            ("dataset.column_count", "dataset", "column_count", None, float(len(df.columns)))]
    if binary:
        s = facts.extra["_t_sum"] or 0.0
        rows += [(f"{target}.positive_rate", target, "positive_rate", None,
                  float(facts.extra["_t_mean"]) if facts.extra["_t_mean"] is not None else None),
                 (f"{target}.positive_count", target, "positive_count", None, float(s)),
                 (f"{target}.negative_count", target, "negative_count", None,
                  float(facts.extra["_t_rows"] - s))]
    rate_cols = []
    for c in others:
        f = facts.columns[c]
        if f.is_numeric:
            if f.non_null_count == 0:
                continue
            std = f.std if f.non_null_count > 1 else 0.0
            for stat, v in (("count", float(f.non_null_count)), ("mean", f.mean),
                            ("median", f.quantiles.get(0.5)), ("std", std), ("min", f.min), ("max", f.max)):
                rows.append((f"{c}.{stat}", c, stat, None, float(v) if v is not None else None))
        else:
            rows.append((f"{c}.unique_count", c, "unique_count", None, float(f.unique_count)))
            if binary and 0 < f.unique_count <= MAX_CATEGORIES_FOR_TARGET_RATE:
                rate_cols.append(c)
    base = spark.createDataFrame(rows, STATS_SCHEMA)
    if not rate_cols:
        return base
    rates = target_rates(df, rate_cols, target)
    return base.unionByName(rates.select(
        F.concat_ws(".", "column", F.lit("target_rate_by_category"), "category").alias("stat_key"),
        "column", F.lit("target_rate_by_category").alias("stat"), "category", "value"))


def target_rates(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(column, category, value = mean target) for every category of every
    listed column, in one shuffle. NULL categories are dropped; the mean
    skips NULL targets."""
    long = unpivot_text(df, columns, keep=[target])
    return (long.groupBy("column", F.col("value").alias("category"))
            .agg(F.avg(F.col(target).cast("double")).alias("value")))


def target_rate_series(df: DataFrame, column: str, target: str) -> DataFrame:
    """Ordered (category, rate) series for one column."""
    return target_rates(df, [column], target).select("category", F.col("value").alias("rate")).orderBy("category")


def correlations(df: DataFrame, columns: list[str] | None = None, block: int = comoments.BLOCK) -> DataFrame:
    """Pearson correlation of every numeric pair a < b (names sorted),
    pairwise-complete; NaN is missing, undefined pairs (a constant side, an
    infinite value) are dropped. See ``comoments`` for how wide tables are
    accumulated."""
    spark = df.sparkSession
    numeric = sorted(f.name for f in df.schema.fields if is_numeric_type(f.dataType))
    if columns is not None:
        numeric = [c for c in numeric if c in set(columns)]
    empty = spark.createDataFrame([], "pair string, col_a string, col_b string, value double")
    if len(numeric) < 2:
        return empty
    found = comoments.pair_correlations(df, numeric, block)
    return empty.unionByName(found.select(F.concat("col_a", F.lit("__vs__"), "col_b").alias("pair"), "col_a", "col_b", "value"))


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed); every bin is
    present, empty ones with count 0. A constant column uses [v-0.5, v+0.5].
    NaN and infinite values are in no bin and set no edge."""
    spark = df.sparkSession
    raw = numeric_or_null(column, df.schema[column].dataType)
    x = F.when(F.abs(raw) < F.lit(float("inf")), raw)
    row = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).collect()[0]
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, count bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)).cast("int") + F.lit(1), F.lit(bins))
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(F.broadcast(counts), "bin", "left")  # ≤ bins rows
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))
