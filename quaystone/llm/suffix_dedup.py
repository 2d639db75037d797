"""Substring dedup: bytes covered by a string of ``length`` bytes that starts anywhere else too.

A suffix array of the whole table is never built. Every window of ``length``
bytes holds a minimizer (the least hash of its 64-byte strings), the same in
equal windows, so the windows are dealt by minimizer: a run of windows with one
minimizer is a strand, and equal windows lie in strands of one minimizer.
Strands whose minimizer occurs once are settled; so are equal strands (all
windows repeat). The distinct strands of the other minimizers go to shards, each
sorted by external induced suffix sorting; windows whose suffixes share
``length`` bytes with a neighbour repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, stage
from .induced import sorted_blocks
from .textarrays import U64, mix64, pieces, powers

LENGTH = 200
GRAM = 64
SHARD_BYTES = 6 << 20
QUEUE_BYTES = 24 << 20   # queue and output tuples that a task holds; beyond, they go to disk
HOT_STRANDS = 1024       # minimizers with more distinct strands are split into chunks of about so many
BROADCAST_KEYS = 2_000_000


def _prefix(buf: np.ndarray) -> np.ndarray:
    out = np.zeros(buf.size + 1, U64)
    np.cumsum((buf.astype(U64) + U64(1)) * powers(buf.size + 1)[0][:buf.size], out=out[1:])
    return out


def _hash_windows(prefix: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from every place on."""
    m = max(0, prefix.size - n)
    return mix64((prefix[n:n + m] - prefix[:m]) * powers(prefix.size)[1][:m])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` neighbours from every place on, by doubling."""
    now, have = x, 1
    while have * 2 <= width:
        now = np.minimum(now[:-have], now[have:])
        have *= 2
    rest = width - have
    return np.minimum(now[:now.size - rest], now[rest:]) if rest else now


def strands(buf: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """(text, first window, windows, minimizer hash, strand hash) arrays."""
    none = np.zeros(0, np.int64)
    starts = buf.size - length + 1
    if starts <= 0:
        return none, none, none, none.view(U64), none.view(U64)
    prefix = _prefix(buf)
    h = _hash_windows(prefix, gram)
    place = np.arange(h.size, dtype=U64)
    least = _sliding_min((h & U64(0xFFFFFFFF00000000)) | place, length - gram + 1)[:starts]
    spot = (least & U64(0xFFFFFFFF)).astype(np.int64)
    text = np.searchsorted(offs, np.arange(starts), side="right") - 1
    inside = np.arange(starts) + length <= offs[text + 1]
    new = np.ones(starts, bool)
    new[1:] = (spot[1:] != spot[:-1]) | (text[1:] != text[:-1])
    a = np.flatnonzero(new)
    per = np.add.reduceat(inside.astype(np.int64), a)  # windows that cross a text's end come last in it
    a, per = a[per > 0], per[per > 0]
    end = a + per - 1 + length
    whole = mix64((prefix[end] - prefix[a]) * powers(prefix.size)[1][a] + (end - a).astype(U64))
    return text[a], a - offs[text[a]], per, mix64(h[spot[a]]), whole


def _repeats(blocks: list[bytes], length: int, memory: int) -> list[tuple[list[int], list[int]]]:
    """For every strand the runs (begin, end) of window starts whose window occurs in another place of the shard."""
    text = np.frombuffer(b"\0".join(blocks), np.uint8).astype(np.uint16) + np.uint16(2)
    size = np.array([len(b) for b in blocks])
    begin = np.cumsum(size + 1) - size - 1
    text[begin[1:] - 1] = 1  # between strands: less than any byte
    hit = np.zeros(text.size + 1, bool)
    last = 0
    for places, common in sorted_blocks(text, length, memory):
        again = common >= length
        hit[places[again]] = True
        hit[np.concatenate(([last], places[:-1]))[again]] = True
        last = int(places[-1])
    room = np.zeros(text.size + 1, bool)  # a separator may lie within the bytes in common of two places
    for b, n in zip(begin.tolist(), size.tolist(), strict=True):
        room[b:b + max(0, n - length + 1)] = True
    hit &= room
    edge = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
    ups, downs = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    own = np.searchsorted(begin, ups, side="right") - 1
    out: list[tuple[list[int], list[int]]] = [([], []) for _ in blocks]
    for k, u, d in zip(own.tolist(), (ups - begin[own]).tolist(), (downs - begin[own]).tolist(), strict=True):
        out[k][0].append(u)
        out[k][1].append(d)
    return out


def _found_strands(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i, _, buf, offs in pieces(batch.column(1)):
                text, first, per, mini, whole = strands(buf, offs, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text + i)), pa.array(first.astype(np.int32)), pa.array(per.astype(np.int32)),
                     pa.array(mini.view(np.int64)), pa.array(whole.view(np.int64))], names=["rk", "a", "n", "mini", "whole"])
    return docs.select("rk", "body").mapInArrow(run, "rk long, a int, n int, mini long, whole long")


def _strand_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(mini, whole, chunks, rk, a, body) of the wanted strands, cut from their texts."""
    per_text = stage(wanted.groupBy("rk").agg(F.collect_list(F.struct("mini", "whole", "chunks", "a", "n")).alias("s")))
    texts = docs.select("rk", F.encode("body", "UTF-8").alias("body"))
    if per_text.count() <= BROADCAST_KEYS:  # keys only; then no other texts are shuffled
        texts = texts.join(F.broadcast(per_text.select("rk")), "rk", "left_semi")
    # one row of rows alike in id and text is enough, and none is lost if both come
    flat = texts.join(per_text.hint("merge"), "rk").select("rk", "body", F.explode("s").alias("s"))
    return flat.select("s.mini", "s.whole", "s.chunks", "rk", "s.a",
                       F.expr(f"substring(body, s.a + 1, s.n + {length - 1})").alias("body"))


def _sorted_spans(rows: DataFrame, length: int, shard_bytes: int, memory: int) -> DataFrame:
    """(rk, begin, end) of repeated bytes: shards of whole minimizers, one induced sort each."""
    def run(batches):
        held, size, last = [], 0, None

        def flush():
            distinct = {(m, w): (rk, a, b) for m, w, rk, a, b in held}  # rows alike bring a strand twice
            keys = list(distinct.values())
            out = [(rk, a + u, a + d - 1 + length) for (rk, a, _), (us, ds) in
                   zip(keys, _repeats([k[2] for k in keys], length, memory), strict=True) for u, d in zip(us, ds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                                               pa.array([o[2] for o in out], pa.int32())], names=["rk", "begin", "end"])
        for batch in batches:
            for m, w, rk, a, b in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if m != last and size >= shard_bytes:
                    yield flush()
                    held, size = [], 0
                last = m
                held.append((m, w, rk, a, b))
                size += len(b) + 1
        if held:
            yield flush()
    dealt = rows.select("mini", "whole", "rk", "a", "body").repartition("mini").sortWithinPartitions("mini", "whole")
    return dealt.mapInArrow(run, "rk long, begin int, end int")


def _chunked_spans(rows: DataFrame, length: int) -> DataFrame:
    """The same for minimizers with very many distinct strands.

    Their strands are dealt into chunks. Windows that repeat inside a chunk are
    settled there; each chunk then sends every distinct window once, and those
    that another chunk has too repeat as well.
    """
    def run(batches):
        def flush(key, strand):
            """strand: whole -> (rk, first window, bytes) of one minimizer's chunk."""
            first = [(rk, a) for rk, a, _ in strand.values()]
            hashes = [_hash_windows(_prefix(np.frombuffer(b, np.uint8)), length) for _, _, b in strand.values()]
            sizes = np.array([h.size for h in hashes])
            own = np.repeat(np.arange(sizes.size), sizes)
            place = np.arange(own.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            distinct, at, which, n = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True, return_counts=True)
            again = n[which] > 1
            edge = np.ones(own.size, bool)
            edge[1:] = (again[1:] != again[:-1]) | (own[1:] != own[:-1])
            begin = np.flatnonzero(edge)
            end = np.append(begin[1:], own.size)
            spans = [(first[own[i]][0], first[own[i]][1] + int(place[i]), first[own[i]][1] + int(place[j - 1]) + length)
                     for i, j in zip(begin, end, strict=True) if again[i]]
            alone = n == 1
            rk, start = np.array(first, np.int64).T[:, own[at]]
            start = start + place[at]
            m, k = len(spans), distinct.size
            spans = np.array(spans, np.int64).reshape(m, 3)
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((spans[:, 0], rk))),
                pa.array(np.concatenate((spans[:, 1], start)).astype(np.int32)),
                pa.array(np.concatenate((spans[:, 2], start + length)).astype(np.int32)),
                pa.array(np.concatenate((np.ones(m, bool), ~alone))),
                pa.array(np.full(m + k, key[0])), pa.array(np.full(m + k, key[1], np.int32)),
                pa.array(np.concatenate((np.zeros(m, np.int64), distinct.view(np.int64))), mask=np.arange(m + k) < m)],
                names=["rk", "begin", "end", "settled", "mini", "chunk", "h"])
        key, held = None, {}
        for batch in batches:
            for mini, chunk, w, rk, a, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (mini, chunk) != key and held:
                    yield flush(key, held)
                    held = {}
                key = (mini, chunk)
                held[w] = (rk, a, body)
        if held:
            yield flush(key, held)
    chunk = F.pmod(F.xxhash64("whole"), F.col("chunks").cast("long")).cast("int")
    dealt = (rows.select("mini", chunk.alias("chunk"), "whole", "rk", "a", "body")
             .repartition("mini", "chunk").sortWithinPartitions("mini", "chunk"))
    found = stage(dealt.mapInArrow(run, "rk long, begin int, end int, settled boolean, mini long, chunk int, h long"))
    windows = found.where("h is not null")
    shared = stage(windows.groupBy("mini", "h").agg(F.min("chunk").alias("x"), F.max("chunk").alias("y"))
                   .where("x <> y").select("mini", "h"))
    across = windows.where("not settled").join(shared, ["mini", "h"])
    return found.where("h is null").select("rk", "begin", "end").union(across.select("rk", "begin", "end"))


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, queue_bytes: int = QUEUE_BYTES, hot_strands: int = HOT_STRANDS) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary: the other bytes).

    Texts are UTF-8 bytes; null is empty. A byte is removed if it lies in a
    string of ``length`` bytes that also starts anywhere else, same document
    included; matches never cross documents. All occurrences go, also the
    first. Rows alike in id and text are documents that repeat each other.
    Shorter texts stay whole; an empty table gives an empty result; other
    columns are not read.
    """
    body = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    docs = df.select(F.struct(F.col(quoted(id_col)).alias("id")).alias("own"),
                     F.xxhash64(F.col(quoted(id_col)), body).alias("rk"), body.alias("body"))
    found = stage(_found_strands(docs, length, gram))
    # written first, so that the join has shuffles of its own, which a hot minimizer is split in
    shared = stage(found.groupBy("mini").agg(F.count(F.lit(1)).alias("m")).where("m >= 2").select("mini"))
    found = stage(found.join(shared, "mini"))
    kinds = stage(found.groupBy("mini", "whole").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("rk", "a", "n")).alias("one")))
    per_mini = kinds.groupBy("mini").agg(F.count(F.lit(1)).alias("kinds")).where("kinds >= 2")
    wanted = kinds.join(per_mini, "mini").select(
        "mini", "whole", F.ceil(F.col("kinds") / F.lit(hot_strands)).cast("int").alias("chunks"), F.col("one.rk").alias("rk"), "one.a", "one.n")
    cut = stage(_strand_bytes(docs, wanted, length))
    spans = _sorted_spans(cut.where("chunks = 1"), length, shard_bytes, queue_bytes)
    hot = cut.where("chunks > 1")
    if not hot.isEmpty():
        spans = spans.union(_chunked_spans(hot, length))
    # a strand that occurs twice repeats as a whole, wherever it occurs
    alike = found.join(kinds.where("m >= 2").select("mini", "whole"), ["mini", "whole"]).select(
        "rk", F.col("a").alias("begin"), (F.col("a") + F.col("n") - 1 + length).alias("end"))
    per_text = spans.union(alike).groupBy("rk").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))

    def run(batches):
        for batch in batches:
            n_bytes, removed, runs, kept = [], [], [], []
            for text, found_spans in zip(batch.column(1), batch.column(2), strict=True):
                b = text.as_buffer().to_pybytes()
                joined: list[list[int]] = []
                for s in sorted((x["begin"], x["end"]) for x in found_spans.as_py() or []):
                    if joined and s[0] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], s[1])
                    else:
                        joined.append(list(s))
                at, left = 0, []
                for begin, end in joined:
                    left.append(b[at:begin])
                    at = end
                left.append(b[at:])
                rest = b"".join(left)
                n_bytes.append(len(b))
                removed.append(len(b) - len(rest))
                runs.append(len(joined))
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary())], names=["own", "n_bytes", "n_removed", "n_spans", "kept"])
    kind = docs.schema["own"].dataType.simpleString()
    out = docs.join(per_text, "rk", "left").select("own", "body", "spans").mapInArrow(
        run, f"own {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.col("own.id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
