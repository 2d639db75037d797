"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, text by text and over the whole corpus.

All texts of a batch are merged in lockstep: one state vector holds every text's
position in its A tokens and its B tokens, every step links the two tokens there,
cuts where both end, advances the one that ends first (or both) and leaves out
the texts that are done. Long texts enter as several lanes, split where both
tokenizers have an end, so the number of steps follows the length of a lane.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import payload, quoted, stage
from .textarrays import utf8

LANE = 256  # A tokens that a lane has about
BATCH_BYTES = 1 << 20  # text that is encoded and merged at a time (a longer text alone)
BROADCAST_PAIRS = 1_000_000  # the counts of so many most frequent pairs at most are broadcast; the others are joined


# Fixed value: how byte-level vocabularies of this kind cut texts before they merge.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
QUICK_BELOW = 0x3000  # the quick encoder of A gets texts of characters below this
_LONG = re.compile(r"\S{1000}|\s{1000}")


def quick(text: str) -> bool:
    """Texts for the quick encoder: known characters, and no run so long that its merging would take long."""
    return (text.isascii() or max(text) < chr(QUICK_BELOW)) and _LONG.search(text) is None


@dataclass(frozen=True)
class Tokenizers:
    """Two vocabulary files: a byte-level BPE of the tokenizers library (A) and a sentencepiece model (B)."""

    path_a: str
    path_b: str

    @cached_property
    def a(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path_a)
        found.encode_special_tokens = True  # their strings in a text are ordinary text
        return found

    @cached_property
    def b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.path_b)

    @cached_property
    def bytes_a(self) -> list[bytes]:
        """Every A token's bytes."""
        with open(self.path_a, encoding="utf-8") as f:
            model = json.load(f)
        # byte-level entries write a printable byte as itself and the others, in order, from U+0100 on
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        back = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
        entries = dict(model["model"]["vocab"])
        out = [b""] * (max([*entries.values(), *(t["id"] for t in model["added_tokens"])]) + 1)
        for entry, k in entries.items():
            out[k] = bytes(back[c] for c in entry)
        return out

    @cached_property
    def bytes_b(self) -> list[bytes]:
        """Every B token's bytes; of control pieces none."""
        out = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            if self.b.is_byte(k):
                out.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(k) or self.b.is_unknown(k) or self.b.is_unused(k):
                out.append(b"")
            else:
                out.append(piece.replace("▁", " ").encode())
        return out

    @cached_property
    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))

    @cached_property
    def written(self) -> tuple[np.ndarray, np.ndarray]:
        """Every id in decimal, followed by each of the signs of a group text, as rows of bytes, and how many bytes count."""
        n = max(len(self.bytes_a), len(self.bytes_b))
        texts = [str(k).encode() + sign for sign in (b",", b"|", b";") for k in range(n)]
        sizes = np.array([len(t) for t in texts], np.int8)
        return np.array([list(t.ljust(int(sizes.max()))) for t in texts], np.uint8), sizes

    @cached_property
    def quick_a(self):
        """An encoder with the merge order of A's file as ranks; None unless it is shown to give A's ids.

        Merging the lowest-ranked pair whose bytes are an entry is merging by A's
        list when ids rise along that list and every entry, encoded alone, is
        itself: where two tokens make up an entry, they stand as in that entry's
        own encoding, so they are the pair of the list. How the two libraries class
        characters is compared for all characters that ``quick`` lets through.
        """
        import tiktoken

        with open(self.path_a, encoding="utf-8") as f:
            file = json.load(f)
        model, cut = file["model"], file["pre_tokenizer"] or {}
        ids = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
        plain = (model["type"] == "BPE" and not model.get("dropout") and file["normalizer"] is None and cut.get("type") == "ByteLevel"
                 and not cut["add_prefix_space"] and cut["use_regex"] and None not in ids and ids == sorted(ids)
                 and len(model["vocab"]) == len(ids) + 256)
        if not plain or any([t.id for t in self.a.model.tokenize(entry)] != [k] for entry, k in model["vocab"].items()):
            return None
        quick = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_WORDS, special_tokens={},
                                  mergeable_ranks={self.bytes_a[k]: k for k in model["vocab"].values()})
        chars = "".join(f"a{c}1{c}!{c} {c}\n{c}{c}'{c}" for c in map(chr, range(QUICK_BELOW)))
        same = quick.encode_ordinary(chars) == self.a.encode(chars, add_special_tokens=False).ids
        return quick if same else None

    def encode(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Both sides' ids of every text; of a text that either side doesn't give back byte for byte, none."""
        whole = [t or "" for t in texts]
        spaced = [" " + t for t in whole]
        slow = [k for k, t in enumerate(spaced) if self.quick_a is None or not quick(t)]
        side_a = [None] * len(spaced)
        for k, e in zip(slow, self.a.encode_batch_fast([spaced[k] for k in slow], add_special_tokens=False), strict=True):
            side_a[k] = e.ids
        side_a = [self.quick_a.encode_ordinary(t) if ids is None else ids for t, ids in zip(spaced, side_a, strict=True)]
        side_b = self.b.encode(whole, num_threads=1)
        for k, text in enumerate(whole):
            goal = b" " + text.encode()
            if (not text or b"".join([self.bytes_a[i] for i in side_a[k]]) != goal
                    or b"".join([self.bytes_b[i] for i in side_b[k]]) != goal):
                side_a[k], side_b[k] = [], []
        return side_a, side_b


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """Loaded once a worker process."""
    return Tokenizers(path_a, path_b)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and the first of every text and the end."""
    offs = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(x) for x in ids], out=offs[1:])
    return np.fromiter(chain.from_iterable(ids), np.int64, int(offs[-1])), offs


def lanes(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray, lane: int) -> tuple[np.ndarray, ...]:
    """Starts and ends, in A and in B tokens, of stretches that both sides begin and end together.

    ``ends``: every token's end, counted over all texts. A text is split after the
    first A token at or behind every ``lane``-th one that ends where a B token does.
    """
    per_text = np.diff(first_a)
    text = np.repeat(np.arange(per_text.size), np.maximum(0, (per_text - 1) // lane))
    number = np.arange(text.size) - np.searchsorted(text, text) + 1
    at = first_a[text] + number * lane - 1
    last = np.minimum(first_a[text] + (number + 1) * lane - 1, first_a[text + 1] - 1)  # exclusive: the next target, or the text's end
    other = np.zeros(at.size, np.int64)
    found, open_ = np.zeros(at.size, bool), np.arange(at.size)
    while open_.size:
        open_ = open_[at[open_] < last[open_]]
        k = np.searchsorted(ends_b, ends_a[at[open_]])
        same = ends_b[np.minimum(k, ends_b.size - 1)] == ends_a[at[open_]]
        found[open_[same]], other[open_[same]] = True, k[same]
        open_ = open_[~same]
        at[open_] += 1
    whole = per_text > 0
    starts_a = np.sort(np.concatenate((first_a[:-1][whole], at[found] + 1)))
    starts_b = np.sort(np.concatenate((first_b[:-1][whole], other[found] + 1)))
    return starts_a, np.append(starts_a[1:], first_a[-1]), starts_b, np.append(starts_b[1:], first_b[-1])


def merge(ends_a: np.ndarray, ends_b: np.ndarray, stretches: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and cuts (last A token, last B token of a group), all lanes merged in lockstep."""
    i, i_end, j, j_end = (x.copy() for x in stretches)
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while i.size:
        links_a.append(i)
        links_b.append(j)
        a, b = ends_a[i], ends_b[j]
        both = a == b
        cuts_a.append(i[both])
        cuts_b.append(j[both])
        i, j = i + (a <= b), j + (b <= a)
        going = i < i_end  # both sides of a lane end together
        if not going.all():
            i, i_end, j, j_end = i[going], i_end[going], j[going], j_end[going]
    empty = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or empty) for x in (links_a, links_b, cuts_a, cuts_b))


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, first_a: np.ndarray,
                first_b: np.ndarray, written: tuple[np.ndarray, np.ndarray]) -> Iterator[bytes]:
    """Every text's groups as a1,a2|b1;a3|b2,b3; cuts in order, ``written`` as Tokenizers.written."""
    # a token stands behind those of its own side before it and the other side's of the groups before (B: and of its group)
    group_a, group_b = np.zeros(ids_a.size + 1, np.int64), np.zeros(ids_b.size + 1, np.int64)
    group_a[cuts_a + 1] = group_b[cuts_b + 1] = 1
    group_a, group_b = np.cumsum(group_a)[:-1], np.cumsum(group_b)[:-1]
    at_a = np.arange(ids_a.size) + np.concatenate(([0], cuts_b + 1))[group_a]
    at_b = np.arange(ids_b.size) + cuts_a[group_b] + 1
    code = np.zeros(ids_a.size + ids_b.size, np.int64)
    code[at_a], code[at_b] = ids_a, ids_b
    table, sizes = written
    code[at_a[cuts_a]] += sizes.size // 3
    code[at_b[cuts_b]] += sizes.size // 3 * 2
    size = sizes[code]
    flat = table[code][np.arange(table.shape[1]) < size[:, None]].tobytes()
    first = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))[first_a + first_b].tolist()
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield flat[a:max(a, b - 1)]


ALIGNED = [T.StructField(name, kind) for name, kind in [
    ("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
    ("groups_sha256", T.StringType()), ("pairs", T.ArrayType(T.LongType())), ("times", T.ArrayType(T.IntegerType()))]]
_B_BITS, _TEXT_AT = 20, 40  # an id has fewer than 20 bits, and a batch of BATCH_BYTES fewer than 2**23 texts


def _aligned(tok: Tokenizers, texts: list[str | None], lane: int) -> list[list]:
    """The columns of ALIGNED for a few texts."""
    side_a, side_b = tok.encode(texts)
    (ids_a, first_a), (ids_b, first_b) = _flat(side_a), _flat(side_b)
    ends_a, ends_b = np.cumsum(tok.lengths[0][ids_a]), np.cumsum(tok.lengths[1][ids_b])
    links_a, links_b, cuts_a, cuts_b = merge(ends_a, ends_b, lanes(ends_a, first_a, ends_b, first_b, lane))
    cuts_a, cuts_b = np.sort(cuts_a), np.sort(cuts_b)
    text = np.searchsorted(first_a, links_a, side="right") - 1
    n_links = np.bincount(text, minlength=len(texts))
    code = np.sort((text << _TEXT_AT) | (ids_a[links_a] << _B_BITS) | ids_b[links_b])
    new = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if code.size else np.zeros(0, np.int64)
    times = np.diff(np.append(new, code.size)).astype(np.int32)
    code = code[new]
    offs = pa.array(np.searchsorted(code >> _TEXT_AT, np.arange(len(texts) + 1)), pa.int32())
    pair = ((code >> _B_BITS) & ((1 << _TEXT_AT - _B_BITS) - 1)) << 32 | code & ((1 << _B_BITS) - 1)
    digests = ["" if b == a else hashlib.sha256(s).hexdigest() for s, a, b in zip(
        group_texts(ids_a, ids_b, cuts_a, cuts_b, first_a, first_b, tok.written), first_a[:-1].tolist(), first_a[1:].tolist(), strict=True)]
    return [pa.array(np.diff(first_a)), pa.array(np.diff(first_b)), pa.array(np.diff(np.searchsorted(cuts_a, first_a))),
            pa.array(n_links), pa.array(digests, pa.string()), pa.ListArray.from_arrays(offs, pa.array(pair)), pa.ListArray.from_arrays(offs, pa.array(times))]


def aligned_texts(df: DataFrame, *, path_a: str, path_b: str, text_col: str = "text", keep: tuple[str, ...] = (), lane: int = LANE,
                  batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per row: n_a, n_b, n_groups, n_links, groups_sha256, its distinct linked pairs (A id * 2**32 + B id) and how often each.

    The ``keep`` columns follow in ``extra``. Texts that are null, empty, no UTF-8
    or not given back by both tokenizers have no tokens.
    """
    own = df.select(F.struct(*payload(df, keep, ()), F.lit(0).alias("_")).alias("extra"), F.col(quoted(text_col)).alias("body"))
    schema = T.StructType([own.schema["extra"], *ALIGNED])

    def decoded(raw: bytes) -> str:
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return ""

    def run(batches):
        tok = tokenizers(path_a, path_b)
        for batch in batches:
            buf, offs = utf8(batch.column(1))
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(offs, offs[i] + batch_bytes, side="right")) - 1)
                texts = [decoded(buf[a:b].tobytes()) for a, b in zip(offs[i:j].tolist(), offs[i + 1:j + 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *_aligned(tok, texts, lane)], names=schema.names)
                i = j
    return own.mapInArrow(run, schema)


def _frequent(counts: DataFrame, limit: int) -> int:
    """The least count such that at most ``limit`` pairs reach it (counts are compared by powers of two)."""
    sizes = counts.groupBy((F.length(F.bin("total")) - 1).alias("p")).count().collect()  # a row a power of two
    n, least = 0, 1 << 62
    for power, size in sorted(sizes, reverse=True):
        if n + size > limit:
            break
        n, least = n + size, 1 << power
    return least


def alignment(df: DataFrame, *, path_a: str, path_b: str, text_col: str = "text", keep: tuple[str, ...] = (), lane: int = LANE,
              batch_bytes: int = BATCH_BYTES, broadcast_pairs: int = BROADCAST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(texts, pairs): one row per row of ``df``, and (a, b, total, best) of every linked pair of ids.

    texts: n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair has the
    highest total of its B id, ties included), count_sum (of the links' totals),
    groups_sha256 and the ``keep`` columns (named like a result: with ``_src``).
    total: how many links of the whole corpus join the two ids. Rows alike stay as
    many rows and count each. Texts that are null, empty or not given back byte for
    byte have zeros and an empty string. An empty table gives empty results.
    """
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    renamed = payload(df, keep, names)
    found = aligned_texts(df.select(F.col(quoted(text_col)).alias("body"), F.struct(*renamed, F.lit(0).alias("_")).alias("own")),
                          path_a=path_a, path_b=path_b, text_col="body", keep=("own",), lane=lane, batch_bytes=batch_bytes)
    rows = stage(found.select(F.monotonically_increasing_id().alias("rid"), "*"))
    links = rows.select("rid", F.inline(F.arrays_zip("pairs", "times"))).select("rid", F.col("pairs").alias("pair"), "times")
    counts = stage(links.groupBy("pair").agg(F.sum(F.col("times").cast("long")).alias("total")))
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    highest = stage(counts.groupBy(b.alias("b")).agg(F.max("total").alias("most")))  # a row a B id: bounded by the vocabulary
    pairs = stage(counts.withColumn("b", b).join(F.broadcast(highest), "b").select(
        "pair", F.shiftrightunsigned("pair", 32).cast("int").alias("a"), F.col("b").cast("int").alias("b"), "total",
        (F.col("total") == F.col("most")).alias("best")))
    least = _frequent(pairs, broadcast_pairs)
    hot = F.broadcast(pairs.where(F.col("total") >= least).select("pair", "total", "best"))
    looked = links.join(hot, "pair", "left")
    sums = (F.sum(F.when(F.col("best"), F.col("times").cast("long"))).alias("n_best"),
            F.sum(F.col("times") * F.col("total")).alias("count_sum"))
    if least > 1:
        # pairs too rare to be broadcast
        cold = pairs.where(F.col("total") < least).select("pair", "total", "best")
        rest = looked.where("total is null").select("rid", "pair", "times").join(cold.hint("merge"), "pair")
        looked = looked.where("total is not null").select("rid", "pair", "times", "total", "best").unionByName(rest)
    per_row = stage(looked.groupBy("rid").agg(*sums))
    out = rows.join(per_row.hint("merge"), "rid", "left")
    none = F.lit(0).cast("long")
    result = out.select(F.col("extra.own").alias("own"), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
                        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
    kept = [f for f in result.schema["own"].dataType.names if f != "_"]
    return result.select(*names, *[F.col(f"own.{quoted(f)}") for f in kept]), pairs.select("a", "b", "total", "best")
