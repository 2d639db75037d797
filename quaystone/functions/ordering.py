"""Position-based operators ("first n rows", "row i", running sums) without a
single-partition window.

``with_row_index`` gives every row its 0-based position in a total order
(optionally within groups): range-partition + sort within partitions, then
a per-partition offset from a table with one row per (partition, group).
Equal to ``row_number() over (partition by … order by …) - 1`` when the order
is total; callers must pass a unique order (add a tie-breaker).

``prefix_sums`` does the same for running sums of numeric columns. NULL group
keys are a group of their own in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystone.session import checkpoint_dir


def _cols(order_by) -> list[Column]:
    if order_by is None:
        return []
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


# An offsets table (one row per partition and group) is broadcast when it is
# known to hold at most this many rows; otherwise it is joined by a shuffle.
OFFSETS_BROADCAST_ROWS = 1_000_000


def _offsets_side(offsets: DataFrame, df: DataFrame, groups: list[str], group_count: int | None,
                  partitions: int | None) -> DataFrame:
    """Broadcast the offsets when their row count is bounded: always without
    groups (one row per partition), with groups only when the caller knows
    how many there are (e.g. the classes it just counted)."""
    if not groups:
        return F.broadcast(offsets)
    if group_count is None:
        return offsets
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.broadcast(offsets) if group_count * parts <= OFFSETS_BROADCAST_ROWS else offsets


def _names(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def with_row_index(df: DataFrame, order_by, name: str = "row_index",
                   partition_by=None, partitions: int | None = None,
                   group_count: int | None = None) -> DataFrame:
    groups = _names(partition_by)
    order = [F.col(g) for g in groups] + _cols(order_by)
    ranged = (df.repartitionByRange(partitions, *order) if partitions
              else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    tagged = (ranged.withColumn("_qs_pid", F.spark_partition_id())
              .withColumn("_qs_mono", F.monotonically_increasing_id()))
    # The offsets and the rows both derive from this range-partitioned table.
    # Spark does not reuse the range exchange across the two branches, so the
    # table is written once to the shared checkpoint folder: one range shuffle
    # instead of two, fixed partition ids, and a lineage cut.
    checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    keys = ["_qs_pid", *groups]
    per_part = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_qs_n"),
                                        F.min("_qs_mono").alias("_qs_base"))
    w = Window.orderBy("_qs_pid") if not groups else Window.partitionBy(*groups).orderBy("_qs_pid")
    offsets = per_part.select(
        *keys, "_qs_base",
        F.coalesce(F.sum("_qs_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_qs_off"))
    # one row per partition (and group): broadcast when that is provably small
    side = _offsets_side(offsets, df, groups, group_count, partitions)
    return (null_safe_join(tagged, side, keys)
            .withColumn(name, F.col("_qs_off") + F.col("_qs_mono") - F.col("_qs_base"))
            .drop("_qs_pid", "_qs_mono", "_qs_base", "_qs_off"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL keys meet; the keys are those of the left side."""
    other = right.select(*[F.col(c).alias(f"_qs_r_{c}" if c in keys else c) for c in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_qs_r_{k}"))
    return left.join(other, on).drop(*[f"_qs_r_{k}" for k in keys])


def row_at(df: DataFrame, position: int, order_by):
    """The order key of the row at ``position`` (0-based) as a struct column, or None beyond the end.

    Only the key columns are shuffled and sorted.
    """
    keys = [c.alias(f"k{i}") for i, c in enumerate(_cols(order_by))]
    place = with_row_index(df.select(*keys), [f"k{i}" for i in range(len(keys))], "_qs_pos")
    rows = place.where(F.col("_qs_pos") == F.lit(position)).drop("_qs_pos").limit(1).collect()
    if not rows:
        return None
    types = [f.dataType for f in place.schema.fields][:len(keys)]
    return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(rows[0], types, strict=True))])


def order_key(order_by) -> Column:
    """The key of a row, comparable with ``row_at``'s (NULL first, as in an ascending sort)."""
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_cols(order_by))])


def first_rows(df: DataFrame, n: int, order_by) -> DataFrame:
    """The first ``n`` rows in the given total order: a filter against the last one's key."""
    last = row_at(df, n - 1, order_by) if n > 0 else None
    if last is None:
        return df if n > 0 else df.limit(0)
    return df.where(order_key(order_by) <= last)


def prefix_sums(df: DataFrame, order_col: str, value_cols: list[str], *, descending: bool = False,
                partition_by=None, prefix: str = "cum_", group_count: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order_col`` order (within
    ``partition_by`` groups). ``order_col`` must be unique within a group."""
    groups = _names(partition_by)
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    order = [F.col(g) for g in groups] + [o]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_qs_pid", F.spark_partition_id())
    # read by both the running-sum pass and the partition totals: written once
    # (one range shuffle, fixed partition ids), as in ``with_row_index``
    checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    keys = ["_qs_pid", *groups]
    upto = Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in value_cols}
    local = ranged.select("*", *[F.sum(v).over(upto).alias(f"{prefix}{c}") for c, v in value.items()])
    totals = ranged.groupBy(*keys).agg(*[F.sum(v).alias(f"_qs_t_{c}") for c, v in value.items()])
    w = (Window.orderBy("_qs_pid") if not groups else Window.partitionBy(*groups).orderBy("_qs_pid")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[F.coalesce(F.sum(f"_qs_t_{c}").over(w), F.lit(0.0)).alias(f"_qs_o_{c}")
                                     for c in value_cols])
    joined = null_safe_join(local, _offsets_side(offsets, df, groups, group_count, None), keys)
    return joined.select(*df.columns, *[(F.col(f"{prefix}{c}") + F.col(f"_qs_o_{c}")).alias(f"{prefix}{c}")
                                        for c in value_cols])
