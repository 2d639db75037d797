"""Phrase collocations: every frequent n-gram by mergeable Misra-Gries summaries, then exact counts.

The first pass cuts the space of n-grams into hash partitions. Every task sends
each partition summaries of its own n-grams; a partition merges them into one
summary with more counters than its mass divided by the least count, so no n-gram
that reaches the least count can drop out. Longer n-grams are only looked at where
all their word pairs survived. The second pass counts what survived exactly, by
its text; scores, the phrases that longer ones cover and the ranks are joins,
groupings and windows over the counted phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, quoted, stage
from .textarrays import LOWER, U64, mix64, prefix_hashes, span_hashes, utf8, words

COUNTERS = 1 << 20  # counters that one partition's summary aims at (16 bytes each)
MAX_PARTITIONS = 1 << 20  # the driver holds one mass a partition
FILTER_BITS = 1 << 29  # bits of a filter that a task holds; more survivors are counted in more rounds
BITS_PER_KEY = 16
HELD = 1 << 21  # n-grams that a task gathers before it sends a summary
ROW_KEYS = 1 << 12  # keys of one row of a summary: small enough for a JVM to move without a place of its own
BLOCK_BYTES = 1 << 20  # texts are worked on in blocks of about so many bytes, longer ones cut between words
HELD_BYTES = 4 << 20  # text that the second pass gathers before it sends counts
CHUNK_BITS = 1 << 19  # bits of a filter that one group builds

BREAK = np.zeros(256, bool)  # ends a piece
BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
GAP = BREAK.copy()  # stands between words
GAP[[0x20, 0x09]] = True


def _beyond(buf: np.ndarray, at: int, n_words: int) -> int:
    """The end of the ``n_words``-th word that begins at ``at`` or later (or the end)."""
    size = 1 << 12
    while True:
        inside = ~GAP[buf[at:at + size]]
        stops = np.flatnonzero(inside[:-1] & ~inside[1:])
        if stops.size >= n_words:
            return at + int(stops[n_words - 1]) + 1
        if at + size >= buf.size:
            return buf.size
        size *= 4


def blocks(column: pa.Array, size: int, n_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, own end): texts together up to ``size`` bytes, longer ones in several blocks.

    A long text is cut after a break, or else between words, and then the block
    goes on for ``n_words`` words that belong to the next. N-grams that begin before
    ``own end`` belong to the block, so every one is found once. Only a word longer
    than ``size`` makes a longer block.
    """
    buf, offs = utf8(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, side="right")) - 1)
        text = buf[offs[i]:offs[j]]
        if text.size <= size:
            yield i, text, offs[i:j + 1] - offs[i], text.size
        at = 0 if text.size > size else text.size
        while at < text.size:
            end = stop = min(at + size, text.size)
            if end < text.size:
                ends = np.flatnonzero(BREAK[text[at:end]])
                gaps = ends if ends.size else np.flatnonzero(GAP[text[at:end]])
                end = at + int(gaps[-1]) + 1 if gaps.size else _beyond(text, at, 1)
                stop = end if ends.size else _beyond(text, end, n_words)
            yield i, text[at:stop], np.array([0, stop - at]), end - at
            at = end
        i = j


@dataclass(frozen=True)
class Filter:
    """A set of 64-bit keys as bits at their low ends: says yes to every key of the set, and to some others."""

    bits: np.ndarray

    def hits(self, keys: np.ndarray) -> np.ndarray:
        cell = keys & U64(self.bits.size * 8 - 1)
        return (self.bits[(cell >> U64(3)).astype(np.int64)] >> (cell & U64(7)).astype(np.uint8)) & np.uint8(1) == 1


def build_filter(keys: DataFrame, n_keys: int, max_bits: int) -> Filter:
    """The filter of the column key; at most ``max_bits`` bits reach the driver, in chunks that groups build."""
    size = 1 << 16
    while size < n_keys * BITS_PER_KEY and size < max_bits:
        size <<= 1
    chunk = min(size, CHUNK_BITS)
    cells = keys.select(F.col("key").bitwiseAND(size - 1).alias("cell"))

    def run(table):
        at = table.column("cell").to_numpy()
        marks = np.zeros(chunk, np.uint8)
        marks[at % chunk] = 1
        return pa.table({"chunk": pa.array([int(at[0]) // chunk], pa.int64()),
                         "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})
    # cells are distinct, so a group has as many rows as its chunk has bits at most
    grouped = cells.distinct().groupBy(F.floor(F.col("cell") / chunk).alias("c")).applyInArrow(run, "chunk long, bits binary")
    bits = np.zeros(size // 8, np.uint8)
    for at, part in grouped.collect():
        bits[at * (chunk // 8):(at + 1) * (chunk // 8)] = np.frombuffer(part, np.uint8)
    return Filter(bits)


_FACTOR = [U64(pow(0xD1342543DE82EF95, k + 1, 1 << 64)) for k in range(16)]
_FACTOR_2 = [U64(pow(0xAF251AF3B0F025B5, k + 1, 1 << 64)) for k in range(16)]


class Grams:
    """The n-grams of one block: word positions and 64-bit keys, for one n after the other."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, own: int, salts: np.ndarray):
        self.starts, self.ends, first = words(buf, offs, GAP)
        self.row = np.repeat(np.arange(offs.size - 1), np.diff(first))
        # equal for words of one piece of one text
        self.piece = np.cumsum(BREAK[buf])[self.starts] + self.row if buf.size else self.row
        self.hash = span_hashes(prefix_hashes(buf), self.starts, self.ends)
        self.own = self.starts < own
        self.salt = salts[self.row]
        self.kept = None  # words that begin a word pair which may be frequent

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the first words, and keys."""
        m = max(0, self.hash.size - n + 1)
        fits = self.own[:m] & (self.piece[:m] == self.piece[n - 1:n - 1 + m])
        if self.kept is not None and n > 2:
            for k in range(n - 1):
                fits &= self.kept[k:k + m]
        at = np.flatnonzero(fits)
        return at, self._keys(at, n, _FACTOR)

    def _keys(self, at: np.ndarray, n: int, factors: list) -> np.ndarray:
        total = self.salt[at] + U64(n)
        for k in range(n):
            total += self.hash[at + k] * factors[k]
        return mix64(total)

    def check(self, at: np.ndarray, n: int) -> np.ndarray:
        """Other keys of the same n-grams."""
        return self._keys(at, n, _FACTOR_2)

    def keep_pairs(self, pairs: Filter) -> None:
        everything, self.own = self.own, np.ones(self.own.size, bool)
        at, keys = self.of(2)
        self.own = everything
        self.kept = np.zeros(self.hash.size, bool)
        self.kept[at] = pairs.hits(keys)


def _sums(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts (without counts: how often they occur)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if keys.size else np.zeros(0, np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, keys.size))
    return keys[first], np.add.reduceat(counts, first) if keys.size else counts


SUMMARY = "p int, grp string, mass long, keys binary, counts binary"


def _summary_rows(keys: np.ndarray, n_parts: int) -> pa.RecordBatch:
    """A task's n-grams as rows of (partition, mass, keys, counts)."""
    keys, counts = _sums(keys)
    part = (((keys >> U64(40)) * U64(n_parts)) >> U64(24)).astype(np.int64)  # rises with the key
    ends = np.searchsorted(part, np.arange(n_parts), side="right")
    cuts = np.unique(np.concatenate(([0], ends, np.arange(0, keys.size, ROW_KEYS), [keys.size])))
    rows = [(int(part[a]), None, int(counts[a:b].sum()), keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes())
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                      names=["p", "grp", "mass", "keys", "counts"])


def summaries(rows: DataFrame, sizes: tuple[int, ...], n_parts: int, pairs: Filter | None, *, held: int = HELD,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Pass 1, in the tasks: summaries of the n-grams of (body, grp, salt) by partition; p = -1: a group's words."""
    shared = rows.sparkSession.sparkContext.broadcast(pairs)

    def run(batches):
        pairs, gathered, size, n_words = shared.value, [], 0, {}
        for batch in batches:
            salts = batch.column(2).to_numpy().view(U64)
            names = batch.column(1).to_pylist()
            for i, buf, offs, own in blocks(batch.column(0), block_bytes, max(sizes) - 1):
                grams = Grams(buf, offs, own, salts[i:i + offs.size - 1])
                if pairs is not None:
                    grams.keep_pairs(pairs)
                for n in sizes:
                    at, keys = grams.of(n)
                    gathered.append(keys)
                    size += keys.size
                    if n == 1:
                        for k, c in enumerate(np.bincount(grams.row[at], minlength=offs.size - 1).tolist()):
                            n_words[names[i + k]] = n_words.get(names[i + k], 0) + c
                if size >= held:
                    yield _summary_rows(np.concatenate(gathered), n_parts)
                    gathered, size = [], 0
        if size:
            yield _summary_rows(np.concatenate(gathered), n_parts)
        if n_words:
            yield _batch([(-1, g, c, None, None) for g, c in n_words.items()])
    return rows.select("body", "grp", "salt").mapInArrow(run, SUMMARY)


class MisraGries:
    """A mergeable Misra-Gries summary: at most ``capacity`` keys with counters.

    A counter is too low by ``taken`` at most, and ``taken`` stays below the mass
    divided by the capacity plus one, however summaries are merged.
    """

    def __init__(self, capacity: int):
        self.capacity, self.taken = max(1, capacity), 0
        self.keys, self.counts = np.zeros(0, U64), np.zeros(0, np.int64)
        self._new, self._n_new = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merges a summary that never had to give up a counter."""
        self._new.append((keys, counts))
        self._n_new += keys.size
        if self._n_new >= max(self.keys.size, 1 << 12):
            self.settle()

    def settle(self) -> None:
        parts = [(self.keys, self.counts), *self._new]
        self._new, self._n_new = [], 0
        self.keys, self.counts = _sums(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        over = self.keys.size - self.capacity
        if over > 0:
            cut = int(np.partition(self.counts, over - 1)[over - 1])  # the largest counter that finds no place
            stays = self.counts > cut
            self.keys, self.counts, self.taken = self.keys[stays], self.counts[stays] - cut, self.taken + cut

    def may_reach(self, least: int) -> np.ndarray:
        """Every key whose count may be ``least`` or more."""
        self.settle()
        return self.keys[self.counts + self.taken >= least]


def survivors(found: DataFrame, least: int, n_parts: int) -> DataFrame:
    """Pass 1, in the partitions: (key) of every n-gram that may occur ``least`` times, each partition by its merged summary."""
    masses = np.zeros(n_parts, np.int64)
    for p, mass in found.where("p >= 0").groupBy("p").agg(F.sum("mass")).collect():  # one row a partition
        masses[p] = mass
    shared = found.sparkSession.sparkContext.broadcast(masses)

    def run(batches):
        now, state = None, None
        for batch in batches:
            for p, keys, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if p != now:
                    if state is not None:
                        yield result(state)
                    # more counters than the mass divided by the least count
                    now, state = p, MisraGries(int(shared.value[p]) // least + 1)
                state.add(np.frombuffer(keys, U64), np.frombuffer(counts, np.uint32).astype(np.int64))
        if state is not None:
            yield result(state)

    def result(state):
        return pa.RecordBatch.from_arrays([pa.array(state.may_reach(least).view(np.int64))], names=["key"])
    rows = found.where("p >= 0").select("p", "keys", "counts").repartition(n_parts, "p").sortWithinPartitions("p")
    return rows.mapInArrow(run, "key long")


def _phrases(chosen: list[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Summed counts of a task's chosen n-grams: (grp, n_words, phrase, c)."""
    key = np.concatenate([c[0] for c in chosen])
    again = np.concatenate([c[1] for c in chosen])
    if not key.size:
        return
    order = np.lexsort((again, key))
    key, again = key[order], again[order]
    new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (again[1:] != again[:-1]))))
    counts = np.diff(np.append(new, key.size))
    pick = np.sort(order[new])  # block by block
    counts = counts[np.argsort(order[new])]
    at, done = 0, 0
    for _, _, first, last, clean, n, row, low in chosen:
        end = int(np.searchsorted(pick, at + first.size))
        mine = pick[done:end] - at
        for plain in (True, False):
            some = mine[clean[mine] == plain]
            if some.size:
                texts = _spans(low, first[some], last[some]) if plain else pa.array(
                    [b" ".join(low[a:b].tobytes().split()) for a, b in zip(first[some].tolist(), last[some].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()).take(pa.array(row[some])), pa.array(np.full(some.size, n, np.int32)), texts,
                     pa.array(counts[done:end][clean[mine] == plain])], names=["grp", "n_words", "phrase", "c"])
        at, done = at + first.size, end


def _spans(buf: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The bytes of every span, without a Python object for each."""
    offs = np.zeros(first.size + 1, np.int32)
    np.cumsum(last - first, out=offs[1:])
    at = np.arange(offs[-1], dtype=np.int32) + np.repeat(first - offs[:-1], last - first)
    return pa.Array.from_buffers(pa.binary(), first.size, [None, pa.py_buffer(offs), pa.py_buffer(buf[at])])


def counted(rows: DataFrame, max_words: int, least: int, pairs: Filter | None, kept: Filter, part: int, parts: int, *,
            block_bytes: int = BLOCK_BYTES, held_bytes: int = HELD_BYTES) -> DataFrame:
    """Pass 2: (grp, n_words, phrase, a) of the n-grams in the ``part``-th of ``parts`` hash ranges that occur ``least`` times.

    Within a task n-grams are told apart by 128 bits, between tasks by their text.
    """
    shared = rows.sparkSession.sparkContext.broadcast((pairs, kept))

    def run(batches):
        pairs, kept = shared.value
        chosen, size, names, number = [], 0, [], {}
        for batch in batches:
            salts = batch.column(2).to_numpy().view(U64)
            for g in batch.column(1).unique().to_pylist():
                if g not in number:
                    number[g] = len(names)
                    names.append(g)
            groups = np.array([number[g] for g in batch.column(1).to_pylist()], np.int64)
            for i, buf, offs, own in blocks(batch.column(0), block_bytes, max_words - 1):
                grams = Grams(buf, offs, own, salts[i:i + offs.size - 1])
                if pairs is not None:
                    grams.keep_pairs(pairs)
                joined = np.append((grams.starts[1:] - grams.ends[:-1] == 1) & (buf[grams.ends[:-1]] == 0x20), False)
                low = LOWER[buf]
                for n in range(1, max_words + 1):
                    at, keys = grams.of(n)
                    mine = kept.hits(keys)
                    if parts > 1:
                        mine &= ((keys >> U64(32)) * U64(parts)) >> U64(32) == U64(part)
                    at, keys = at[mine], keys[mine]
                    clean = np.ones(at.size, bool)
                    for k in range(n - 1):
                        clean &= joined[at + k]
                    chosen.append((keys, grams.check(at, n), grams.starts[at].astype(np.int32),
                                   grams.ends[at + n - 1].astype(np.int32), clean, n,
                                   groups[i + grams.row[at]].astype(np.int32), low))
                size += buf.size
                if size >= held_bytes:
                    yield from _phrases(chosen, names)
                    chosen, size = [], 0
        if chosen:
            yield from _phrases(chosen, names)
    found = rows.select("body", "grp", "salt").mapInArrow(run, "grp string, n_words int, phrase binary, c long")
    return (found.groupBy("grp", "n_words", "phrase").agg(F.sum("c").alias("a")).where(F.col("a") >= least)
            .withColumn("phrase", F.col("phrase").cast("string")))


def frequent_phrases(df: DataFrame, *, text_col: str = "text", group_col: str = "lang", no_group: str = "und", least: int = 30,
                     max_words: int = 4, counters: int = COUNTERS, filter_bits: int = FILTER_BITS, held: int = HELD,
                     block_bytes: int = BLOCK_BYTES, held_bytes: int = HELD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(counts, totals): (grp, n_words, phrase, a) of all n-grams of 1 to ``max_words`` words with a >= ``least``, and (grp, n).

    Texts are A-Z lower-cased, cut into pieces at ``.,;:!?`` and line ends and
    into words at spaces and tabs. n counts all words of a group. The numbers in
    the last line of the signature only set how much a task holds at a time.
    """
    if least < 1 or max_words < 2 or max_words > len(_FACTOR):
        raise ValueError(f"least must be 1 or more and max_words 2 to {len(_FACTOR)}")
    spark = df.sparkSession
    group = F.coalesce(F.col(quoted(group_col)).cast("string"), F.lit(no_group))
    rows = df.select(F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("body"), group.alias("grp"),
                     F.xxhash64(group).alias("salt"))
    n_bytes = rows.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    held_by = {"held": held, "block_bytes": block_bytes}

    def parts(n_sizes: int) -> int:  # a word has a byte and a gap at least
        return _parts(spark, n_sizes * (n_bytes // 2 + 1), least, counters)

    low = stage(summaries(rows, (1, 2), parts(2), None, **held_by))
    keys = stage(survivors(low, least, parts(2)))
    n_keys, pairs = keys.count(), None
    if max_words > 2:
        pairs = build_filter(keys, n_keys, filter_bits)
        high = stage(summaries(rows, tuple(range(3, max_words + 1)), parts(max_words - 2), pairs, **held_by))
        longer = stage(survivors(high, least, parts(max_words - 2)))
        keys, n_keys = keys.union(longer), n_keys + longer.count()
    rounds = max(1, -(-n_keys * BITS_PER_KEY // filter_bits))
    tables = []
    for r in range(rounds):
        mine = keys.where(F.expr(f"shiftrightunsigned(shiftrightunsigned(key, 32) * {rounds}L, 32) = {r}"))
        kept = build_filter(mine, -(-n_keys // rounds), filter_bits)
        tables.append(stage(counted(rows, max_words, least, pairs, kept, r, rounds, block_bytes=block_bytes, held_bytes=held_bytes)))
    totals = low.where("p < 0").groupBy("grp").agg(F.sum("mass").alias("n"))
    return reduce(DataFrame.union, tables), totals


def _parts(spark: SparkSession, mass: int, least: int, counters: int) -> int:
    """Hash partitions, each with about ``counters`` counters at most."""
    return int(min(MAX_PARTITIONS, max(partitions(spark), -(-mass // (least * counters)))))


def scored(counts: DataFrame) -> DataFrame:
    """(grp, phrase, n_words, a, l, r, score) of all phrases of two words or more, by their lowest-scoring cut."""
    cut = F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    cuts = counts.where("n_words > 1").select("grp", "phrase", "n_words", "a", cut)
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', k)").alias("left"),
                       F.expr("substring_index(phrase, ' ', k - n_words)").alias("right"))
    for side in ("left", "right"):
        # a part is at least as frequent as the phrase, so it was counted; a hot word is split by the join
        part = counts.select("grp", F.col("phrase").alias(side), F.col("a").alias(f"of_{side}"))
        cuts = cuts.join(part.hint("merge"), ["grp", side])
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000BD) div (cast(of_left as decimal(20, 0)) + of_right)")
    best = F.min(F.struct(score.alias("score"), "k", F.col("of_left").alias("l"), F.col("of_right").alias("r")))
    return (cuts.groupBy("grp", "phrase", "n_words", "a").agg(best.alias("best"))
            .select("grp", "phrase", "n_words", "a", "best.l", "best.r", "best.score"))


def covered(counts: DataFrame) -> DataFrame:
    """(grp, phrase, most): every phrase inside a longer one, with the longest's highest count."""
    word = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n_words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("n_words") - m + 1), lambda i: F.array_join(F.slice(word, i, m), " "))))
    longer = counts.where("n_words > 2").select("grp", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
    return longer.groupBy("grp", "phrase").agg(F.max("a").alias("most"))


def collocations(df: DataFrame, *, top: int | None = 2000, percent: int = 80, **options) -> DataFrame:
    """(grp, rank, phrase, a, l, r, n, score): every group's best phrases, by score, then count, then text.

    Phrases of 2 to ``max_words`` words with a >= ``least`` (see frequent_phrases).
    Cut after its first k words, a phrase has l and r, the counts of its parts, and
    the score floor(2000000 * a / (l + r)); the lowest-scoring cut counts, then the
    smallest k. Phrases inside a longer one with ``percent`` of their count are
    left out. ``top=None`` gives all of a group's phrases, with rank null. A null
    group is ``no_group``; null and empty texts have no words; repeated rows count
    each; other columns are not read; an empty table gives an empty result.
    """
    counts, totals = frequent_phrases(df, **options)
    best, inside = stage(scored(counts)), stage(covered(counts))
    kept = best.join(inside.hint("merge"), ["grp", "phrase"], "left").where(
        F.expr(f"most is null or 100BD * cast(most as decimal(20, 0)) < {int(percent)}BD * cast(a as decimal(20, 0))"))
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    if top is None:
        ranked = kept.withColumn("rank", F.lit(None).cast("long"))
    else:
        # first the best of every bucket, so that no task sorts a whole group
        bucket = F.pmod(F.xxhash64("phrase"), F.lit(4 * partitions(df.sparkSession)))
        first = (kept.withColumn("bucket", bucket)
                 .withColumn("k", F.row_number().over(Window.partitionBy("grp", "bucket").orderBy(*order))).where(F.col("k") <= top))
        ranked = (first.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order)).cast("long"))
                  .where(F.col("rank") <= top))
    return ranked.join(F.broadcast(totals) if totals.count() <= 100_000 else totals, "grp").select(
        "grp", "rank", "phrase", "a", "l", "r", "n", "score")
