"""Deterministic stratified splits that move keys, never rows.

Rows are ordered by ``md5(seed | key)`` within their class: exact, the same under
any partitioning and reproducible in any SQL engine. The hold-out is cut at an
order statistic of every class. It is found by counting: rows per class and
digest prefix first (partly aggregated before the shuffle), then only inside the
prefix that holds the cut, four thousand times narrower each round, until the few
rows left can be sorted. What decides a row's side is then its class's border, a
table of one row per class, so the rows themselves are only filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystone.functions.ordering import with_row_index
from quaystone.session import checkpoint_dir

SEED = 42
TEST_FRACTION = 0.2
DIGITS = 3  # hex digits by which a round narrows: 4,096 counts a class at most
DIGEST = 32
SORTED_ROWS = 20_000  # a class's border is sorted out among so many rows at most
BROADCAST_CLASSES = 200_000  # class tables up to this counted size are broadcast
BROADCAST_FOLDS = 1_000_000  # and fold tables up to this one


def split_order(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def _small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def _kept(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder: small tables that several jobs read."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def class_borders(df: DataFrame, label: str, key: str, fraction: float = TEST_FRACTION, seed: int = SEED,
                  sorted_rows: int = SORTED_ROWS) -> tuple[DataFrame, int]:
    """((_b_class, _b_order, _b_key), number of classes): per class the last of its first floor(fraction · n + 0.5) rows.

    Classes of which no row is cut off have no border. Reads label and key only.
    Rows alike in label and key stand at the same place, so the border may have
    several; NULL keys come first.
    """
    narrow = df.select(F.col(label).alias("_b_class"), split_order(key, seed).alias("_b_order"), F.col(key).alias("_b_key"))
    sizes = _kept(narrow.groupBy("_b_class").agg(F.count(F.lit(1)).alias("_b_n")))
    quota = F.floor(F.col("_b_n") * F.lit(float(fraction)) + F.lit(0.5)).cast("long")
    state = sizes.select("_b_class", F.lit("").alias("_b_prefix"), quota.alias("_b_rest"), "_b_n").where("_b_rest > 0")
    n_classes = sizes.count()

    def inside(width: int) -> DataFrame:
        """Rows whose digest begins with their class's prefix of ``width`` digits."""
        s = _small(state.withColumnRenamed("_b_class", "_s_class").drop("_b_n"), n_classes, BROADCAST_CLASSES)
        begin = F.substring(F.coalesce("_b_order", F.lit("")), 1, width)
        return narrow.join(s, F.col("_b_class").eqNullSafe(F.col("_s_class")) & (begin == F.col("_b_prefix"))).drop("_s_class")

    width = 0
    while width < DIGEST and (state.agg(F.max("_b_n")).first()[0] or 0) > sorted_rows:
        longer = F.substring(F.coalesce("_b_order", F.lit("")), 1, width + DIGITS)
        counts = (inside(width).groupBy("_b_class", "_b_rest", longer.alias("_b_prefix")).agg(F.count(F.lit(1)).alias("_b_n")))
        # at most 16**DIGITS rows a class
        upto = F.sum("_b_n").over(Window.partitionBy("_b_class").orderBy("_b_prefix")
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        state = _kept(counts.withColumn("_b_upto", upto).withColumn("_b_before", F.col("_b_upto") - F.col("_b_n"))
                      .where("_b_upto >= _b_rest and _b_before < _b_rest")
                      .select("_b_class", "_b_prefix", (F.col("_b_rest") - F.col("_b_before")).alias("_b_rest"), "_b_n"))
        width += DIGITS
    # rows alike count as one row here, so copies of one key are never sorted
    places = inside(width).groupBy("_b_class", "_b_rest", "_b_order", "_b_key").agg(F.count(F.lit(1)).alias("_b_n"))
    last = F.sum("_b_n").over(Window.partitionBy("_b_class").orderBy("_b_order", "_b_key")
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    border = (places.withColumn("_b_upto", last).where("_b_upto >= _b_rest and _b_upto - _b_n < _b_rest")
              .select("_b_class", "_b_order", "_b_key"))
    return _kept(border), n_classes


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = TEST_FRACTION, seed: int = SEED,
                     sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """Adds ``split`` ∈ {train, test}: per class, the first floor(test_fraction · n_class + 0.5) rows in md5 order are test.

    ``key`` should be unique; rows alike in label and key are all on one side. Rows
    without a label are a class of their own. Up to ``BROADCAST_CLASSES`` classes
    no row is shuffled or written; with more, rows join the borders by class.
    """
    borders, n_classes = class_borders(df, label, key, test_fraction, seed, sorted_rows)
    here = F.struct(split_order(key, seed).alias("o"), F.col(key).alias("k"))
    border = F.struct(F.col("_b_order").alias("o"), F.col("_b_key").alias("k"))
    side = _small(borders.withColumn("_b_cut", border).withColumnRenamed("_b_class", "_b_of").select("_b_of", "_b_cut"),
                  n_classes, BROADCAST_CLASSES)
    return (df.join(side, F.col(label).eqNullSafe(F.col("_b_of")), "left")
            .withColumn("split", F.when(here <= F.col("_b_cut"), F.lit("test")).otherwise(F.lit("train")))
            .drop("_b_of", "_b_cut"))


def fold_table(train: DataFrame, label: str, key: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """(_f_label, _f_key, fold): per class, a key's position in md5 order modulo ``k``. Only labels and keys are sorted."""
    keys = train.select(F.col(label).alias("_f_label"), F.col(key).alias("_f_key")).distinct()
    n_classes = keys.select("_f_label").distinct().count()
    placed = with_row_index(keys.withColumn("_f_o", split_order("_f_key", seed + 1)), ["_f_o", "_f_key"], "_f_i",
                            partition_by="_f_label", group_count=n_classes)
    return placed.select("_f_label", "_f_key", F.pmod(F.col("_f_i"), F.lit(k)).cast("int").alias("fold"))


def stratified_folds(train: DataFrame, label: str, key: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """Adds ``fold`` ∈ [0, k) from ``fold_table``; rows alike in label and key share it.

    Up to ``BROADCAST_FOLDS`` keys the table is broadcast and no row is shuffled;
    beyond, rows are shuffled once, by their key.
    """
    folds = _kept(fold_table(train, label, key, k, seed))
    side = _small(folds, folds.count(), BROADCAST_FOLDS)
    same = F.col(key).eqNullSafe(F.col("_f_key")) & F.col(label).eqNullSafe(F.col("_f_label"))
    return train.join(side, same).drop("_f_label", "_f_key")
