"""Mixing sources to target weights: floor(rate) copies of each document plus one hash-seeded Bernoulli copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystone.functions.ordering import with_row_index

from .common import WORD_PATTERN, quoted, stage

BROADCAST_SOURCES = 100_000  # up to so many sources (counted) the rates are broadcast; beyond, the join shuffles


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) from the MD5 of seed and keys: 52 bits, the same in every run and engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_targets(sizes: DataFrame, *, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """(src, source_size) -> (src, source_size, target).

    Sources in code-point order (null last) weigh ``weights`` in turn. Their
    targets share ``share`` of all tokens by weight; a target stops at ``cap``
    times its source, the excess is reshared by weight until none is above.
    """
    named = sizes.withColumn("last", F.col("src").isNull())
    # with one row a source; hex of UTF-8 sorts as code points do
    ranked = with_row_index(named.withColumn("code", F.hex(F.encode(F.coalesce("src", F.lit("")), "UTF-8"))),
                            ["last", "code"], "place")
    per = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                       (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    weighted = stage(ranked.select("src", "source_size", per.alias("weight"),
                                   (F.lit(float(cap)) * F.col("source_size")).alias("most")))
    all_tokens = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget, level = share * all_tokens, 0.0
    while True:  # the level only rises; it rises while it puts another source at its cap
        open_w, capped = weighted.agg(
            F.coalesce(F.sum(F.when(F.col("most") > level * F.col("weight"), F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(F.col("most") <= level * F.col("weight"), F.col("most"))), F.lit(0.0))).first()
        if not open_w:
            break
        raised = (budget - capped) / open_w
        if raised <= level:
            break
        level = raised
    target = F.least("most", F.lit(level) * F.col("weight"))
    return weighted.select("src", "source_size", target.alias("target"))


def plan_mix(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 23) -> DataFrame:
    """``df`` as struct ``row`` with size, source_size, target and copies (0 or more) of each row.

    Words count as tokens; a null text has none. A null source is a source of
    its own. Rows alike in id get the same draw; a null id draws as the text
    ``null``. A source without words gets target 0 and no copies.
    """
    rows = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
                     F.col(quoted(id_col)).alias("id"), F.col(quoted(source_col)).alias("src"),
                     word_count(F.col(quoted(text_col))).alias("size"))
    targets = stage(source_targets(rows.groupBy("src").agg(F.sum("size").alias("source_size")),
                                   weights=weights, share=share, cap=cap))
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = (uniform(seed, F.col("id")) < F.col("rate") - F.floor("rate")).cast("long")
    return (rows.join(targets.withColumnRenamed("src", "t_src"), F.col("src").eqNullSafe(F.col("t_src")))
            .withColumn("rate", rate).withColumn("copies", F.floor("rate") + draw)
            .select("row", "id", "size", "source_size", "target", "copies"))


def mix(df: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``df``, its columns as they are, as often as the plan says."""
    plan = plan_mix(df, **options).where("copies > 0")
    return (plan.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
            .select(*[F.col(f"row.{quoted(c)}").alias(c) for c in df.columns]))
