"""Exact dedup: a two-pass Bloom filter decides which rows have to be compared at all.

Pass 1 hashes every normalised text and counts, per filter cell, how many rows
hit it; the cells hit twice or more are packed into 64-bit words. Pass 2 probes
that filter in a map-side join. A row with a cell that only it hit is unique and
passes straight through; only the others are shuffled and grouped by SHA-256.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, payload, quoted, stage

MAX_FILTER_BITS = 1 << 27  # 2M 64-bit words: what is broadcast never grows beyond this
BITS_PER_ROW = 16


def normalised(text: Column) -> Column:
    """The text without its white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for ch in SPACE_CHARS:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def filter_bits(n_rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_FILTER_BITS) -> int:
    """Power of two with ``bits_per_row`` bits a row, between 2**16 and ``max_bits``."""
    bits = 1 << 16
    while bits < n_rows * bits_per_row and bits < max_bits:
        bits <<= 1
    return bits


def repeated_cells(hashes: DataFrame, cells: Sequence[str]) -> DataFrame:
    """Filter words (word, mask) with a bit for every cell that two or more rows hit.

    At most ``filter bits / 64`` rows, whatever the input.
    """
    hits = hashes.select(F.explode(F.array(*cells)).alias("cell")).groupBy("cell").count()
    return (hits.where("count >= 2")
            .groupBy(F.shiftright("cell", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("mask")))


def exact_dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = (),
                bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, n_code_points and the ``keep`` columns.

    Texts are equal when identical without white space (null is empty). The row
    with most code points, then smallest id (null last) stays; among rows alike
    in both, exactly one stays. ``keep_id`` is null only where that row has no id.
    ``keep`` columns whose name a result column has get the suffix ``_src``. An
    empty table gives an empty result. A filter at ``max_bits`` only lets more
    rows be shuffled; results do not depend on its size.
    """
    names = ("keep_id", "group_size", "kept", "text_sha256", "n_code_points", id_col)
    text = F.col(quoted(text_col))
    rows = stage(df.select(
        F.struct(F.col(quoted(id_col)).alias("id")).alias("own"),
        F.struct(*payload(df, keep, names), F.lit(0).alias("_")).alias("extra"),
        F.sha2(F.encode(normalised(text), "UTF-8"), 256).alias("sha"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("len"),
        F.monotonically_increasing_id().alias("rid")))
    half = filter_bits(rows.count(), bits_per_row, max_bits) // 2
    # two independent cells, one in each half of the filter
    rows = rows.select("*", F.pmod(F.xxhash64(F.lit(1), "sha"), F.lit(half)).alias("cell_a"),
                       (F.pmod(F.xxhash64(F.lit(2), "sha"), F.lit(half)) + half).alias("cell_b"))
    words = stage(repeated_cells(rows, ("cell_a", "cell_b")))
    probed = rows
    for side in ("a", "b"):
        mask = F.broadcast(words.select(F.col("word").alias(f"word_{side}"), F.col("mask").alias(f"mask_{side}")))
        probed = probed.join(mask, F.shiftright(f"cell_{side}", 6) == F.col(f"word_{side}"), "left")
    bit = [F.coalesce(F.expr(f"getbit(mask_{s}, cast(cell_{s} & 63 as int))"), F.lit(0)) == 1 for s in "ab"]
    probed = probed.select("own", "extra", "sha", "len", "rid", (bit[0] & bit[1]).alias("maybe"))

    unique = probed.where(~F.col("maybe")).select(
        "own", "extra", "sha", "len", F.col("own.id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    maybe = probed.where("maybe")
    best = F.min(F.struct((-F.col("len")).alias("l"), F.col("own.id").isNull().alias("n"),
                          F.col("own.id").alias("id"), F.col("rid").alias("rid")))
    # written first, so that the join has shuffles of its own, which a hot group is split in
    groups = stage(maybe.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")))
    compared = maybe.join(groups, "sha").select(
        "own", "extra", "sha", "len", F.col("best.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"))
    return unique.unionByName(compared).select(
        F.col("own.id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"),
        F.col("len").alias("n_code_points"),
        *[F.col(f"extra.{quoted(c)}") for c in rows.schema["extra"].dataType.names if c != "_"])
