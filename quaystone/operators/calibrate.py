"""Resampling calibration of drift tolerances.

For every batch size and iteration, a batch is drawn from the population,
its median (and the mean of a 0/1 rate column) is taken, and the deviation
from the population value is recorded; the p50/p95/p99/max of the deviations
per batch size is the sampling-noise floor a tolerance must clear.

Draws are generated, not scanned: Spark spreads the (size, iteration) pairs
over tasks, a keyed permutation per pair (plain integer arithmetic in column
expressions) gives the row positions, and the positions are equi-joined to the
population's row index — work grows with iterations × batch size plus one
pass over the population, never with iterations × population. Batches
smaller than the population are drawn without replacement, others with
replacement. Groups are bounded by the batch size and by the iteration
count, so exact per-group medians and percentiles are safe.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.functions.ordering import with_row_index
from quaystone.functions.quantiles import exact_median
from quaystone.session import checkpoint_dir

# Fixed values — batch sizes, iterations, seed and incident factors of the
# calibration study.
BATCH_SIZES = (100, 300, 700, 1500, 3500, 7043)
N_ITER = 3000
SEED = 42
INCIDENT_FACTORS = (2, 3, 10, 100)


# Populations up to this many rows are broadcast to the draw join (about
# 24 bytes a row); larger ones are joined by a shuffle on the position.
BROADCAST_POPULATION_ROWS = 2_000_000


# Fixed values of the draws: 32-bit multipliers and steps of the mixing, and how often positions are swapped.
ROUNDS = 20
WORD = 1 << 32
STEP_KEY, STEP_BIT = 2654435, 40503


def mixed(x: F.Column) -> F.Column:
    """A 32-bit number spread over 32 bits; all products stay below 2**63, so any SQL engine can repeat it."""
    a = (x * F.lit(1103515245) + F.lit(12345)) % F.lit(WORD)
    b = (a.bitwiseXOR(F.shiftright(a, 15)) * F.lit(1664525) + F.lit(1013904223)) % F.lit(WORD)
    return b.bitwiseXOR(F.shiftright(b, 13))


def _below(x: F.Column, n: int) -> F.Column:
    """A number below ``n`` made from a 32-bit number."""
    if n <= 1 << 31:
        return mixed(x) % F.lit(n)
    return (mixed(x) * F.lit(1 << 30) + mixed((x + F.lit(1)) % F.lit(WORD)) % F.lit(1 << 30)) % F.lit(n)


def permuted(rows: DataFrame, n: int, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (with x in [0, n) and a key s below 2**32) with x moved by the permutation of [0, n) that s stands for.

    Every round pairs each position with its mirror image around a key and swaps
    the pair or not, by a bit that both have in common. Each round is a
    permutation of exactly the n positions, whatever n, so all draws of one key
    are distinct and nothing is looked up or drawn again. Keep the result
    (``checkpoint``) before a join.
    """
    others = [c for c in rows.columns if c != "x"]
    for r in range(rounds):
        key = _below((F.col("s") + F.lit(r * STEP_KEY)) % F.lit(WORD), n)
        mirror = key - F.col("x")
        rows = rows.select(*others, "x", F.when(mirror >= 0, mirror).otherwise(mirror + F.lit(n)).alias("_y"))
        bit = mixed((F.greatest("x", "_y") + F.col("s") + F.lit(r * STEP_BIT)) % F.lit(WORD)) >= F.lit(WORD // 2)
        rows = rows.select(*others, F.when(bit, F.col("_y")).otherwise(F.col("x")).alias("x"))
    return rows


def draw_positions(spark, n: int, sizes=BATCH_SIZES, n_iter: int = N_ITER, seed: int = SEED,
                   partitions: int | None = None) -> DataFrame:
    """(size, iter, pos): the row positions of every batch — without
    replacement (the first ``size`` positions of a keyed permutation) when the
    batch is smaller than the population, else by plain mixing."""
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = spark.createDataFrame([(int(s),) for s in sizes], "size int")
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "size", "iter")), 1, 8), 16, 10).cast("long")
    rows = (base.select("size", F.explode(F.sequence(F.lit(0), F.lit(n_iter - 1))).alias("iter"))
            .repartition(parts, "size", "iter").withColumn("s", key)
            .select("size", "iter", "s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size").cast("long") - 1)).alias("x")))
    few, many = [s for s in sizes if s < n], [s for s in sizes if s >= n]
    out = []
    if few:
        out.append(permuted(rows.where(F.col("size").isin(few)), n).select("size", "iter", F.col("x").alias("pos")))
    if many:
        out.append(rows.where(F.col("size").isin(many)).select(
            "size", "iter", _below((F.col("s") + F.col("x") * F.lit(2)) % F.lit(WORD), n).alias("pos")))
    return reduce(DataFrame.unionByName, out)


def md5_positions(spark, n: int, sizes, n_iter: int, seed: int = SEED) -> DataFrame:
    """(size, iter, pos) by MD5 of seed, size, iteration and draw, with replacement: no generator, the same in any engine."""
    base = spark.createDataFrame([(int(s),) for s in sizes], "size int")
    rows = base.select("size", F.explode(F.sequence(F.lit(0), F.lit(n_iter - 1))).alias("iter"))
    rows = rows.select("size", "iter", F.explode(F.expr("sequence(0, size - 1)")).alias("k"))
    key = F.concat_ws("|", F.lit(str(seed)), "size", "iter", "k")
    return rows.select("size", "iter", (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") % F.lit(n)).alias("pos"))


def _median_of_sorted(arr: F.Column) -> F.Column:
    k = F.size(arr)
    h = (k - 1).cast("double") * 0.5
    lo = F.floor(h).cast("int")
    hi = F.ceil(h).cast("int")
    a, b = F.element_at(arr, lo + 1), F.element_at(arr, hi + 1)
    return a + (h - lo) * (b - a)


def calibrate(df: DataFrame, value_col: str, order_by, *, rate_expr: F.Column | None = None,
              sizes=BATCH_SIZES, n_iter: int = N_ITER, seed: int = SEED, draws=draw_positions) -> DataFrame:
    """(statistic, batch_n, p50, p95, p99, max) for the median deviation (%)
    and, given ``rate_expr`` (0/1), the rate deviation (percentage points)."""
    spark = df.sparkSession
    cols = [F.col(value_col).cast("double").alias("v")]
    cols.append((rate_expr if rate_expr is not None else F.lit(None)).cast("double").alias("r"))
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    pop = with_row_index(df.select(*keys, *cols), keys, "pos").select("pos", "v", "r")
    stats = pop.agg(F.count(F.lit(1)).alias("n"), F.avg("r").alias("rate")).collect()[0]
    n, pop_rate = int(stats["n"]), stats["rate"]
    pop_median = exact_median(pop, "v")

    checkpoint_dir(spark)
    # kept before the join: a join derives constraints from the draws' rounds, whose number doubles with each
    positions = draws(spark, n, sizes, n_iter, seed).checkpoint(eager=True)
    side = F.broadcast(pop) if n <= BROADCAST_POPULATION_ROWS else pop
    # one row per (size, iteration) — checkpointed to the shared folder, so
    # the draw + join work runs once and the lineage is cut. Each group holds
    # exactly ``size`` values, so sorting it in place is bounded.
    batches = (positions.join(side, "pos")
               .groupBy("size", "iter")
               .agg(F.sort_array(F.collect_list("v")).alias("vs"), F.avg("r").alias("rate"))
               .select("size", "iter", _median_of_sorted(F.col("vs")).alias("med"), "rate")
               .checkpoint(eager=True))

    devs = batches.select(
        "size",
        (F.abs(F.col("med") - F.lit(pop_median)) / F.lit(pop_median) * 100).alias("median_dev_pct"),
        (F.abs(F.col("rate") - F.lit(pop_rate)) * 100).alias("rate_dev_pp") if pop_rate is not None
        else F.lit(None).cast("double").alias("rate_dev_pp"))
    long = devs.select("size", F.explode(F.array(
        F.struct(F.lit("median_dev_pct").alias("statistic"), F.col("median_dev_pct").alias("d")),
        F.struct(F.lit("rate_dev_pp").alias("statistic"), F.col("rate_dev_pp").alias("d")))).alias("e"))
    long = long.select("size", "e.statistic", "e.d").filter(F.col("d").isNotNull())
    return (long.groupBy("statistic", F.col("size").alias("batch_n"))
            .agg(F.percentile("d", 0.5).alias("p50"), F.percentile("d", 0.95).alias("p95"),
                 F.percentile("d", 0.99).alias("p99"), F.max("d").alias("max")))


def incident_deviations(df: DataFrame, value_col: str, factors=INCIDENT_FACTORS) -> DataFrame:
    """Median deviation (%) a deliberate ×factor corruption produces."""
    spark = df.sparkSession
    med = exact_median(df.select(F.col(value_col).cast("double").alias("v")), "v")
    fac = spark.createDataFrame([(int(f),) for f in factors], "factor int")
    return fac.select("factor", (F.abs(F.lit(med) * F.col("factor") - F.lit(med)) / F.lit(med) * 100)
                      .alias("median_dev_pct"))
