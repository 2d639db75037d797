"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

Rows are dealt into blocks by hash. How many rows of each block go to each shard
is drawn from the multivariate hypergeometric law, so the matrix has the exact
block sizes as row sums and the exact shard sizes as column sums. Inside its
block every row gets a random place, which says its shard; rows are exchanged;
inside its shard every row gets a random place again, its slot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import payload, quoted, row_hash, stage

ROWS_PER_BLOCK = 200_000  # rows that one task permutes at most
LEAST_BLOCKS = 96


def _log_factorial(n: np.ndarray) -> np.ndarray:
    """log(n!) by Stirling's series, exact products below 20."""
    n = np.asarray(n, dtype=np.float64)
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1.0, 21.0)))])
    x = np.maximum(n, 20.0) + 1.0
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n <= 20, small[np.minimum(n, 20).astype(int)], series)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows taken without replacement are good ones; any population size.

    Inverts the distribution on its support, cut at 40 standard deviations.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mean = draws * good / total
    spread = 40 * np.sqrt(mean * (bad / total) * max(1.0, (total - draws) / max(1, total - 1))) + 40
    k = np.arange(max(low, int(mean - spread)), min(high, int(mean + spread)) + 1)
    log_p = -(_log_factorial(k) + _log_factorial(good - k) + _log_factorial(draws - k) + _log_factorial(bad - draws + k))
    p = np.exp(log_p - log_p.max())
    cdf = np.cumsum(p)
    return int(k[min(np.searchsorted(cdf, rng.random() * cdf[-1], side="right"), k.size - 1)])


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """counts[block][shard] with both margins exact."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = list(shard_sizes)
    matrix = []
    for size in block_sizes:
        row, rest, pool = [], size, sum(left)
        for j, have in enumerate(left):
            pool -= have
            take = hypergeometric(rng, have, pool, rest)
            row.append(take)
            rest -= take
        left = [a - b for a, b in zip(left, row, strict=True)]
        matrix.append(row)
    return matrix


def _running(counts: list[int]) -> list[int]:
    out, total = [], 0
    for c in counts:
        total += c
        out.append(total)
    return out


def shard_rows(df: DataFrame, n_shards: int = 24, *, seed: int = 17,
               rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """All columns of ``df`` plus shard (0 to n_shards - 1) and slot (gapless from 0 in each shard).

    Shard sizes differ by one at most. A row's place depends on the seed and on
    the values of all its columns (nulls included), not on the partitioning;
    rows alike in every column are interchangeable and may land in different
    shards. Input columns named shard or slot come back as shard_src, slot_src.
    Rows with the same key (alike, or different in map columns only) that are too many for a
    block are spread over all blocks. Empty tables give no rows. The driver holds counts only: one per block and
    shard, and blocks have ``rows_per_block`` rows.
    """
    spark = df.sparkSession
    own = df.select(F.struct(*payload(df, df.columns, ("shard", "slot"))).alias("row"),
                    row_hash(df, seed).alias("key"))
    n = df.count()
    n_blocks = max(LEAST_BLOCKS, -(-n // rows_per_block))
    n_parts = max(LEAST_BLOCKS // n_shards, -(-n // (n_shards * rows_per_block)), 1)
    blocked = own.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(n_blocks)))
    sizes = {r["block"]: r["count"] for r in blocked.groupBy("block").count().collect()}
    # only blocks far above the others can hold a key with too many rows
    full = [b for b, c in sizes.items() if c > max(rows_per_block, 1.5 * n / n_blocks)]
    if full:
        many = stage(blocked.where(F.col("block").isin(full)).groupBy("key").count().where(F.col("count") > rows_per_block // 2).select("key"))
        # such rows get keys of their own, written once so that both passes below see the same ones
        spread = stage(own.join(F.broadcast(many), "key", "left_semi").select("row", F.xxhash64(
            F.lit(seed + 5), "key", F.monotonically_increasing_id()).alias("key")))
        own = own.join(F.broadcast(many), "key", "left_anti").select("row", "key").unionByName(spread)
        blocked = own.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(n_blocks)))
        sizes = {r["block"]: r["count"] for r in blocked.groupBy("block").count().collect()}
    shard_sizes = [n // n_shards + (i < n % n_shards) for i in range(n_shards)]
    matrix = communication_matrix([sizes.get(b, 0) for b in range(n_blocks)], shard_sizes, seed)
    # Arrow tables: from lists, Spark starts Python workers that stay with the executors
    ends = spark.createDataFrame(pa.table({"block": pa.array(range(n_blocks), pa.int64()),
                                           "ends": pa.array([_running(row) for row in matrix], pa.list_(pa.int64()))}))

    def sent(rows: DataFrame) -> DataFrame:
        """Each row's shard: its random place in its block, against the block's row of the matrix."""
        place = F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 2), "key"), "key"))
        return (rows.withColumn("place", place).join(F.broadcast(ends), "block")
                .withColumn("shard", F.expr("size(filter(ends, e -> e < place))"))
                .withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 3), "key"), F.lit(n_parts)))
                .drop("place", "ends", "block"))

    # rows of each part of a shard: where its slots begin (keys only travel for this)
    counts = {(r["shard"], r["part"]): r["count"]
              for r in sent(blocked.select("key", "block")).groupBy("shard", "part").count().collect()}
    begins = []
    for s in range(n_shards):
        at = 0
        for p in range(n_parts):
            begins.append((s, p, at))
            at += counts.get((s, p), 0)
    begin = spark.createDataFrame(pa.table({name: pa.array([b[i] for b in begins], kind) for i, (name, kind) in enumerate(
        [("shard", pa.int32()), ("part", pa.int64()), ("begin", pa.int64())])}))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy(F.xxhash64(F.lit(seed + 4), "key"), "key"))
    out = (sent(blocked).withColumn("inside", inside).join(F.broadcast(begin), ["shard", "part"])
           .withColumn("slot", F.col("begin") + F.col("inside") - 1))
    names = own.schema["row"].dataType.names
    return out.select(*[F.col(f"row.{quoted(c)}") for c in names], "shard", "slot")
