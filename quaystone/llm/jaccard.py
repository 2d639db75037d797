"""Exact n-gram Jaccard self-join by prefix filter with set-relation skipping.

Sets of word shingles are ordered by one global order, rarest first; linked sets
share a shingle among their first ones (the prefix), so an index of prefixes
finds every link. Two relations between sets spare most of the work:

* Every index list has a leader, the set with the shingle foremost. All sets of a
  list are compared with its leader first; what that says of similar sets
  (the same component already, or too far from the leader by the triangle
  inequality of the Jaccard distance) is not compared again.
* The rest of a list is kept in blocks by set size and position. A block
  whose sizes, positions or components exclude a link is skipped as a whole.

Sets alike are one class throughout, so copies are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, payload, quoted, stage
from .components import components
from .textarrays import SMALL_PIECE, U64, mix64, pieces, shingle_sets

SHINGLE = 5
CHUNK = 1 << 21  # shingles that a task sorts at a time when counting
HOT_FROM = 16  # shingles in at least so many documents are ordered last, by the power of two of their count
MAX_HOT = 1 << 20  # the least power is raised until at most so many are hot; order only, results do not depend on it
LEVEL_BITS = 24  # the order's table: one byte for each value of a shingle's first bits, 16 MB at any scale
BROADCAST_KEYS = 2_000_000  # (counted) keys of texts to fetch that are broadcast; beyond, the join shuffles


def _class_of(h: np.ndarray) -> int:
    """64-bit hash of a set, as a signed number; with the set's size it names its class."""
    parts = np.array([mix64(h).sum(dtype=U64), np.bitwise_xor.reduce(mix64(h ^ U64(0x5851F42D4C957F2D))), h.size], U64)
    return int(mix64(mix64(parts[:1]) ^ mix64(parts[1:2] + parts[2:]))[0].astype(np.int64))


def _sized_sets(batches: Iterator[pa.RecordBatch], k: int, column: str = "body"):
    for batch in batches:
        at = batch.schema.get_field_index(column)
        for i, _, buf, offs in pieces(batch.column(at), SMALL_PIECE):
            for j, h in enumerate(shingle_sets(buf, offs, k)):
                yield batch, i + j, h


def _summaries(docs: DataFrame, k: int) -> DataFrame:
    """(id, rk, n, c): every row with its set's size and class hash (n = 0: no set)."""
    def run(batches):
        for batch in batches:
            n, c = [], []
            for _, _, h in _sized_sets([batch], k):
                n.append(h.size)
                c.append(_class_of(h) if h.size else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(c, pa.int64())],
                names=["own", "rk", "n", "c"])
    kind = docs.schema["own"].dataType.simpleString()
    return docs.select("own", "rk", "body").mapInArrow(run, f"own {kind}, rk long, n long, c long")


def _level_table(docs: DataFrame, k: int) -> np.ndarray:
    """For each value of a shingle's first bits the greatest power of two (0: not hot) of a shingle count there.

    Counted over all documents. A task sorts its shingles (32 bits of each) and
    sends them as packed differences, one row for each value range.
    """
    ranges = 1 << max(4, int(np.ceil(np.log2(2 * partitions(docs.sparkSession)))))
    width = (1 << 32) // ranges

    def sent(batches):
        held, size = [], 0

        def flush():
            cells = np.sort(np.concatenate(held))
            cuts = np.searchsorted(cells, np.arange(ranges + 1, dtype=np.uint64) * width)
            rows = [(r, np.diff(cells[a:b], prepend=np.uint32(r * width)).view(np.uint8).reshape(-1, 4).T.tobytes())
                    for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()),
                                               pa.array([b for _, b in rows], pa.binary())], names=["r", "packed"])
        for _, _, h in _sized_sets(batches, k):
            held.append((h >> U64(32)).astype(np.uint32))
            size += h.size
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def counted(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        cells = np.sort(np.concatenate([
            np.cumsum(np.frombuffer(b.as_buffer(), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel(), dtype=np.uint32)
            + np.uint32(r * width) for b in table.column("packed")]))
        at = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        count = np.diff(np.append(at, cells.size))
        hot = count >= HOT_FROM
        return pa.table({"cell": cells[at[hot]].astype(np.int64) >> (32 - LEVEL_BITS),
                         "level": np.log2(count[hot]).astype(np.int32)})

    hot = stage(docs.select("body").mapInArrow(sent, "r int, packed binary").groupBy("r")
                .applyInArrow(counted, "cell long, level int"))
    per_level = dict(hot.groupBy("level").count().collect())
    total, least = 0, 64
    for level in sorted(per_level, reverse=True):
        total += per_level[level]
        if total > MAX_HOT:
            break
        least = level
    table = np.zeros(1 << LEVEL_BITS, np.uint8)
    for row in hot.where(F.col("level") >= least).groupBy("cell").agg(F.max("level").alias("level")).toLocalIterator():
        table[row["cell"]] = row["level"]
    return table


def _postings(docs: DataFrame, k: int, levels) -> DataFrame:
    """(token, c, n, pos): the prefix of every set in the global order; sets alike are posted once a task."""
    def run(batches):
        table, seen = levels.value, set()
        for batch in batches:
            rows = []
            for _, _, h in _sized_sets([batch], k):
                if not h.size or (key := (_class_of(h), h.size)) in seen:
                    continue
                seen.add(key)
                size = h.size - (4 * h.size + 4) // 5 + 1
                level = table[h >> U64(64 - LEVEL_BITS)]
                first = h[np.argsort(level, kind="stable")[:size]] if level.any() else h[:size]
                rows.append((first, key[0], key[1]))
            if rows:
                sizes = np.array([r[0].size for r in rows])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([r[0] for r in rows]).astype(np.int64)),
                    pa.array(np.repeat(np.array([r[1] for r in rows], np.int64), sizes)),
                    pa.array(np.repeat(np.array([r[2] for r in rows], np.int32), sizes)),
                    pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes]))],
                    names=["token", "c", "n", "pos"])
    return docs.select("body").mapInArrow(run, "token long, c long, n int, pos int")


def _can_link(n1: Column, pos1: Column, n2: Column, pos2: Column) -> Column:
    """Sizes within 4:5, and enough shingles left. Linked sets pass at the first shingle they share, if not at all."""
    return ((5 * F.least(n1, n2) >= 4 * F.greatest(n1, n2))
            & (9 * F.least(n1 - pos1, n2 - pos2) >= 4 * (n1 + n2)))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(a, b) of classes -> (a, b, shared): shingles in common, counted on the texts themselves."""
    pairs = stage(pairs)
    wanted = stage(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
                   .join(classes, "node").select("node", "rk"))
    keys = wanted
    if wanted.count() <= BROADCAST_KEYS:
        keys = F.broadcast(wanted)
    texts = stage(docs.select("rk", "body").join(keys, "rk").groupBy("node").agg(F.first("body").alias("body")))

    def run(batches):
        last = (None, None)
        for batch in batches:
            shared = np.zeros(batch.num_rows, np.int64)
            a_col, ta, tb = batch.column(0), batch.column(2), batch.column(3)
            for i, end, buf, offs in pieces(tb, SMALL_PIECE):
                for j, hb in enumerate(shingle_sets(buf, offs, k), start=i):
                    node = a_col[j].as_py()
                    if last[0] != node:
                        one = pa.array([ta[j].as_py()], pa.string())
                        last = (node, shingle_sets(*next(pieces(one))[2:], k)[0])
                    shared[j] = np.intersect1d(last[1], hb, assume_unique=True).size
            yield pa.RecordBatch.from_arrays([a_col, batch.column(1), pa.array(shared)], names=["a", "b", "shared"])

    kind = pairs.schema["a"].dataType.simpleString()
    b_side = pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("body_b")), "b")
    both = b_side.join(texts.select(F.col("node").alias("a"), F.col("body").alias("body_a")), "a")
    return stage(both.select("a", "b", "body_a", "body_b").mapInArrow(run, f"a {kind}, b {kind}, shared long"))


def _linked(verified: DataFrame) -> DataFrame:
    return verified.where("100 * shared >= 80 * (a.n + b.n - shared)").select("a", "b")


def _placed(docs: DataFrame, k: int) -> DataFrame:
    """(own, rk, body) -> (own, rk, n, root): every row with the least class that links reach (null without a set)."""
    spark = docs.sparkSession
    rows = stage(_summaries(docs, k))
    node = F.struct(F.col("n").cast("int").alias("n"), F.col("c").alias("c"))
    classes = stage(rows.where("n > 0").groupBy(node.alias("node")).agg(F.min("rk").alias("rk")))

    levels = spark.sparkContext.broadcast(_level_table(docs, k))
    posted = stage(_postings(docs, k, levels))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m >= 2").select("token")
    lists = stage(posted.join(shared, "token").distinct())

    foremost = lists.groupBy("token").agg(F.min(F.struct("pos", "n", "c")).alias("lead"))
    led = lists.join(foremost, "token").withColumn("node", node).withColumn("leader", F.struct("lead.n", "lead.c"))
    first = (led.where("node <> leader")
             .where(_can_link(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos"))))
    known = _verified(first.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), docs, classes, k)
    links = _linked(known)
    comp = components(links)

    rest = _unsettled(lists, foremost, comp, known)
    rest = rest.join(known.select("a", "b"), ["a", "b"], "left_anti").join(
        known.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
    later = _linked(_verified(rest, docs, classes, k))
    if not later.isEmpty():
        comp = components(links.union(later))
    return (rows.withColumn("node", node).join(comp, "node", "left")
            .withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "node"))))


def _documents(df: DataFrame, id_col: str, text_col: str, keep) -> DataFrame:
    """(own, rk, body); rows alike in id and text have the same key rk."""
    body = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    return df.select(F.struct(F.col(quoted(id_col)).alias("id"), *keep).alias("own"),
                     F.xxhash64(F.col(quoted(id_col)), body).alias("rk"), body.alias("body"))


def jaccard_classes(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id and the ``keep`` columns.

    Sets with a Jaccard similarity of 0.8 or more are linked; component_id is the
    least id that links reach (null ids are passed over; null where no row of
    the component has an id). Null, empty and blank texts have no
    shingles, are linked with nothing and keep their own id. Rows alike are
    linked like any copies. ``keep`` columns whose name a result column has get
    the suffix ``_src``. Empty tables give empty results.
    """
    names = (id_col, "n_shingles", "component_id")
    docs = _documents(df, id_col, text_col, payload(df, keep, names))
    placed = stage(_placed(docs, k))
    least = placed.where("root is not null").groupBy("root").agg(F.min("own.id").alias("component_id"))
    out = placed.join(stage(least), "root", "left")
    return out.select(
        F.col("own.id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("own.id")).alias("component_id"),
        *[F.col(f"own.{quoted(c)}") for c in docs.schema["own"].dataType.names[1:]])


def drop_near_copies(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """``df`` with one row of every component: the one with the least id (null last).

    Of rows alike in id and text one stays; rows without shingles all stay.
    """
    docs = _documents(df, id_col, text_col, ())
    placed = stage(_placed(docs, k).where("root is not null").select("root", F.struct(
        F.col("own.id").isNull().alias("no_id"), F.col("own.id").alias("id"), "rk").alias("place")))
    best = stage(placed.groupBy("root").agg(F.min("place").alias("best")))
    judged = placed.join(best, "root").select("place.rk", (F.col("place.rk") == F.col("best.rk")).alias("stays"))
    dropped = stage(judged.where("not stays").select("rk").distinct())
    repeated = stage(judged.where("stays").groupBy("rk").count().where("count > 1").select("rk"))
    out = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
                    F.xxhash64(F.col(quoted(id_col)), F.coalesce(F.col(quoted(text_col)), F.lit(""))).alias("rk"))
    out = out.join(F.broadcast(dropped) if dropped.count() <= BROADCAST_KEYS else dropped, "rk", "left_anti")
    if not repeated.isEmpty():
        out = out.join(repeated, "rk", "left_anti").unionByName(out.join(repeated, "rk", "left_semi").dropDuplicates(["rk"]))
    return out.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in df.columns])


def _unsettled(lists: DataFrame, foremost: DataFrame, comp: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes in different components that still may be linked, each once.

    Members of lists with several components probe the blocks of their list.
    """
    node = F.struct("n", "c")
    members = (lists.withColumn("node", node).join(comp, "node", "left")
               .withColumn("root", F.coalesce("root", "node")).join(foremost, "token")
               .withColumn("leader", F.struct("lead.n", "lead.c")))
    mixed = members.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    similar = known.select(F.col("a").alias("leader"), F.col("b").alias("node"),
                           (F.col("shared") / (F.col("a.n") + F.col("b.n") - F.col("shared"))).alias("j"))
    # blocks: a factor of 1.25 in size, then quarters of the prefix by position
    band = F.floor(F.log("n") / F.log(F.lit(1.25))).cast("int")
    quarter = F.floor(F.lit(4) * F.col("pos") / (F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1)).cast("int")
    members = stage(members.join(mixed.select("token"), "token").join(similar, ["leader", "node"], "left")
                    .select("token", "node", "n", "pos", "root", band.alias("band"), quarter.alias("quarter"),
                            F.when(F.col("node") == F.col("leader"), F.lit(1.0)).otherwise(F.col("j")).alias("j")))
    blocks = members.groupBy("token", "band", "quarter").agg(
        F.min("n").alias("least_n"), F.max("n").alias("most_n"),
        F.max(F.col("n") - F.col("pos")).alias("most_left"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    probe = members.select("token", F.col("node").alias("a"), F.col("n").alias("n1"), F.col("pos").alias("pos1"),
                           F.col("root").alias("root1"), F.col("j").alias("j1"))
    left = F.col("n1") - F.col("pos1")
    met = (probe.join(blocks, "token")
           .where("not (lo = hi and lo = root1) and most_n >= n1 and 4 * least_n <= 5 * n1")
           .where(9 * F.least(left, F.col("most_left")) >= 4 * (F.col("n1") + F.greatest("least_n", "n1")))
           .select("token", "band", "quarter", "a", "n1", "pos1", "root1", "j1"))
    pairs = (met.join(members.withColumnRenamed("node", "b"), ["token", "band", "quarter"])
             .where("a < b and root1 <> root")
             .where(_can_link(F.col("n1"), F.col("pos1"), F.col("n"), F.col("pos")))
             .where("j is null or j1 is null or abs(j - j1) <= 0.2000001"))
    return pairs.select("a", "b").distinct()
