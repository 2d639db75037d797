"""Co-moments of all column pairs of a wide table, pairwise-complete.

One accumulator holds, for a block of columns against another, the counts, sums,
squares and products over the rows where both sides have a value. A task makes
it by matrix products over Arrow batches; accumulators are merged by summing, as
all are taken around the same per-column centres and in units of the same
spreads, which a first scan measures. Sums around a centre lose no digits to a
large mean, but they can't tell a pair whose values (where both sides have one)
hardly vary from one that is constant there. Such pairs, if any, are measured
again, each around its own mean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.session import checkpoint_dir

BLOCK = 256  # columns on a side of an accumulator: 256 x 256 x 6 numbers a task
# A side whose variance is below this share of its mean square (around the common
# centre) has lost its digits: about 1e-16 of the square is rounding.
DOUBTFUL = 1e-9
PAIRS_A_SCAN = 100
CELLS = "a int, b int, n double, odd double, sa double, sb double, qa double, qb double, p double"


def _valid(name: str):
    d = F.col(name).cast("double")
    return F.nanvl(d, F.lit(None).cast("double"))


def _centres(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """(centre, spread) of the finite values of every column that isn't constant or empty."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.when(F.abs(_valid(c)) < F.lit(float("inf")), _valid(c))
        # the power of two below the range: division by it is exact
        aggs += [F.avg(x).alias(f"m{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is not None and lo < hi:
            spread = hi / 2 - lo / 2  # of huge values the plain difference is infinite
            out[c] = (row[f"m{i}"] if abs(row[f"m{i}"]) < float("inf") else lo / 2 + hi / 2, spread if spread > 0 else hi - lo)
    return out


def accumulate(df: DataFrame, left: list[str], right: list[str], centres: dict[str, tuple[float, float]]) -> DataFrame:
    """One row per pair (numbered within ``left`` and ``right``): n, odd (rows where a side is infinite), the sums and squares
    of both sides and the sum of products, over the rows where both have a value."""
    names = [*left, *right]
    shift = np.array([centres[c][0] for c in names])
    scale = np.array([centres[c][1] for c in names])
    k = len(left)

    def run(batches):
        total = np.zeros((7, k, len(names) - k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64, copy=False)
            here = ~np.isnan(x)
            odd = np.isinf(x)
            with np.errstate(invalid="ignore", over="ignore"):
                z = np.where(here & ~odd, (x - shift) / scale, 0.0)
            m, o = (here & ~odd).astype(np.float64), odd.astype(np.float64)
            (za, zb), (ma, mb), (oa, ob) = [(y[:, :k], y[:, k:]) for y in (z, m, o)]
            total[0] += ma.T @ mb
            total[1] += oa.T @ (mb + ob) + ma.T @ ob
            total[2] += za.T @ mb
            total[3] += ma.T @ zb
            total[4] += (za * za).T @ mb
            total[5] += ma.T @ (zb * zb)
            total[6] += za.T @ zb
        i, j = np.indices(total.shape[1:], np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), *[pa.array(t.ravel()) for t in total]],
                                         names=[c.split()[0] for c in CELLS.split(", ")])
    sums = [F.sum(c).alias(c) for c in ("n", "odd", "sa", "sb", "qa", "qb", "p")]
    # a row a pair and task comes out of the tasks, whatever the rows
    rows = df.select(*[_valid(c).alias(f"c{i}") for i, c in enumerate(names)])
    return rows.mapInArrow(run, CELLS).groupBy("a", "b").agg(*sums)


def pair_correlations(df: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """(col_a, col_b, value) of every pair of ``columns`` (in their order) whose correlation is defined."""
    centres = _centres(df, columns)
    usable = [c for c in columns if c in centres]
    blocks = [usable[i:i + block] for i in range(0, len(usable), block)]
    measured, doubtful = None, []
    for i, left in enumerate(blocks):
        for right in blocks[i:]:
            cells = accumulate(df, left, right, centres)
            name = [F.element_at(F.array(*[F.lit(c) for c in side]), F.col(x) + 1) for side, x in ((left, "a"), (right, "b"))]
            if left is right:
                cells = cells.where("a < b")
            va, vb = F.col("qa") - F.col("sa") * F.col("sa") / F.col("n"), F.col("qb") - F.col("sb") * F.col("sb") / F.col("n")
            cov = F.col("p") - F.col("sa") * F.col("sb") / F.col("n")
            part = cells.where("n > 1 and odd = 0").select(
                name[0].alias("col_a"), name[1].alias("col_b"),
                ((va <= F.lit(DOUBTFUL) * F.col("qa")) | (vb <= F.lit(DOUBTFUL) * F.col("qb"))).alias("doubtful"),
                F.try_divide(cov, F.sqrt(F.greatest(va, F.lit(0.0))) * F.sqrt(F.greatest(vb, F.lit(0.0)))).alias("value"))
            checkpoint_dir(df.sparkSession)
            part = part.checkpoint(eager=True)
            measured = part if measured is None else measured.unionByName(part)
    if measured is None:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, value double")
    doubtful = [tuple(r) for r in measured.where("doubtful").select("col_a", "col_b").collect()]  # names of columns
    out = measured.where("not doubtful").select("col_a", "col_b", "value")
    for i in range(0, len(doubtful), PAIRS_A_SCAN):
        out = out.unionByName(_each_alone(df, doubtful[i:i + PAIRS_A_SCAN]))
    return (out.where("value is not null and not isnan(value)")
            .withColumn("value", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("value")))))


def _each_alone(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """The correlation of single pairs, every pair around its own means."""
    aggs = []
    for k, (a, b) in enumerate(pairs):
        both = _valid(a).isNotNull() & _valid(b).isNotNull()
        x, y = F.when(both, _valid(a)), F.when(both, _valid(b))
        aggs.append(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(f"r{k}"))
    row = df.agg(*aggs).first()
    return df.sparkSession.createDataFrame([(a, b, row[f"r{k}"]) for k, (a, b) in enumerate(pairs)],
                                           "col_a string, col_b string, value double")
