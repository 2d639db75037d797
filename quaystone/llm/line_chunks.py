"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of ``window`` neighbouring lines says where a
chunk ends, so an inserted line moves the boundaries near it only. Chunks of two
or more lines that occur again anywhere are removed but for their first place,
after their bytes were compared. On demand every pair of neighbouring lines is
a key instead, so that a repeated passage is found wherever the boundaries lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import payload, quoted, stage

# Fixed values of the rolling hash; line hashes have 32 bits, so no product overflows 63 bits.
FACTOR = 31
WINDOW = 2
DIVISOR = 4  # a boundary after one line in four on average


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunk_ends(hashes: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """Places (0-based) of the last line of every chunk; the last line always ends one."""
    def ends(_, i):
        rolled = F.lit(0).cast("long")
        for k in range(window - 1, -1, -1):
            rolled = rolled * F.lit(FACTOR) + F.get(hashes, i - F.lit(k))
        return (i >= window - 1) & (F.pmod(rolled, F.lit(divisor)) == 0) | (i == F.size(hashes) - 1)
    return F.filter(F.transform(hashes, lambda _, i: F.when(ends(_, i), i)), lambda e: e.isNotNull())


def with_chunks(df: DataFrame, text_col: str, window: int, divisor: int) -> DataFrame:
    """Adds lines, ends and chunks: struct(first, n_lines, body) in document order."""
    return (df.withColumn("lines", F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1))
            # a column of its own: inside a lambda it would be computed again for every element
            .withColumn("hashes", F.transform("lines", line_hash))
            .withColumn("ends", chunk_ends(F.col("hashes"), window, divisor))
            .withColumn("chunks", F.transform("ends", lambda e, i: F.struct(
                F.when(i == 0, F.lit(0)).otherwise(F.get("ends", i - 1) + 1).alias("first"),
                (e - F.when(i == 0, F.lit(-1)).otherwise(F.get("ends", i - 1))).alias("n_lines"))))
            .withColumn("chunks", F.transform("chunks", lambda c: F.struct(
                c["first"].alias("first"), c["n_lines"].alias("n_lines"),
                F.array_join(F.slice("lines", c["first"] + 1, c["n_lines"]), "\n").alias("body")))))


def line_chunk_dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     window: int = WINDOW, divisor: int = DIVISOR, keep: tuple[str, ...] = (), pairs: bool = False) -> DataFrame:
    """One row per document: id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, kept_text, ``keep`` columns.

    Of every chunk of two or more lines that occurs twice or more in the table,
    the first place (smallest id, nulls last, then smallest line) stays and the
    others are removed; chunks of one line are left alone. Null texts count as
    empty: one empty line, never removed. Rows alike in id and text are one
    document and come back alike. ``keep`` columns whose name a result column
    has get the suffix ``_src``; an empty table gives an empty result.

    Chunks that a passage's edges share with foreign lines are missed, so short
    repeated passages mostly stay. With ``pairs``, all lines are removed that lie
    in two neighbouring lines that occur at an earlier place too: every repeated
    passage of two or more lines goes, whatever its neighbours, and the first place
    of a line always stays. n_removed_chunks then counts the runs of removed lines.
    """
    names = ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines", "kept_text", id_col)
    docs = df.select(F.struct(F.col(quoted(id_col)).alias("id")).alias("own"),
                     F.struct(*payload(df, keep, names), F.lit(0).alias("_")).alias("extra"),
                     F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("body"))
    docs = docs.withColumn("place", F.struct(
        F.col("own.id").isNull().alias("no_id"), F.col("own.id").alias("id"), F.xxhash64("body").alias("text_hash")))
    chunked = with_chunks(docs, "body", window, divisor)
    # outer: a plain explode makes Catalyst test size(chunks) > 0 below, with every expression written out again
    bodies = F.col("chunks")
    if pairs:
        bodies = F.transform(F.slice("lines", 1, F.greatest(F.size("lines") - 1, F.lit(0))), lambda line, i: F.struct(
            i.alias("first"), F.lit(2).alias("n_lines"), F.concat_ws("\n", line, F.get("lines", i + 1)).alias("body")))
    spots = (chunked.select("place", F.explode_outer(bodies).alias("c")).where("c.n_lines >= 2")
             .select(F.xxhash64("c.body").alias("h"), F.struct("place", "c.first").alias("at"), "c.n_lines", "c.body"))
    # hashes that occur twice (nothing but hashes travels), then the bytes of those chunks only
    twice = stage(spots.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("a"), F.max("at").alias("b"))
                  .where("n >= 2 and a <> b").select("h"))
    again = stage(spots.join(twice, "h"))
    # written first, so that the join has shuffles of its own, which a hot chunk is split in
    first = stage(again.groupBy("h", "body").agg(F.min("at").alias("stays")))
    gone = (again.join(first, ["h", "body"]).where("at <> stays")
            .groupBy("at.place").agg(F.collect_set("at.first").alias("gone"),
                                     F.size(F.collect_set("at.first")).alias("n_gone")))
    # ids are compared null-safely through the struct's text
    key = F.struct("place.no_id", F.coalesce(F.col("place.id").cast("string"), F.lit("")).alias("t"), "place.text_hash")
    gone = gone.select(key.alias("doc"), "gone")
    none = F.array().cast("array<int>")
    out = (docs.withColumn("doc", key).join(gone, "doc", "left").transform(
        lambda d: with_chunks(d, "body", window, divisor))
        .withColumn("gone", F.coalesce("gone", none))
        .withColumn("left", F.filter("chunks", lambda c: ~F.array_contains("gone", c["first"]))))
    names = [F.col(f"extra.{quoted(c)}") for c in docs.schema["extra"].dataType.names if c != "_"]
    if pairs:
        out = (out.withColumn("gone", F.array_distinct(F.concat("gone", F.transform("gone", lambda i: i + 1))))
               .withColumn("left", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")))
        return out.select(
            F.col("own.id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
            F.size("chunks").cast("long").alias("n_chunks"),
            F.size(F.array_except("gone", F.transform("gone", lambda i: i + 1))).cast("long").alias("n_removed_chunks"),
            F.size("gone").cast("long").alias("n_removed_lines"),
            F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n").alias("kept_text"), *names)
    lines_left = F.aggregate("left", F.lit(0), lambda n, c: n + c["n_lines"])
    return out.select(
        F.col("own.id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
        F.size("chunks").cast("long").alias("n_chunks"),
        (F.size("chunks") - F.size("left")).cast("long").alias("n_removed_chunks"),
        (F.size("lines") - lines_left).cast("long").alias("n_removed_lines"),
        F.array_join(F.transform("left", lambda c: c["body"]), "\n").alias("kept_text"), *names)
