"""Quality classifier on supervised subword embeddings.

A text's words, word pairs and character n-grams are hashed to learned vectors,
whose mean goes through a softmax layer; trained by stochastic gradient descent
in NumPy. As the layer is linear, scoring needs one number a hash only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import payload, quoted, stage
from .textarrays import SMALL_PIECE, U64, mix64, pieces, prefix_hashes, span_hashes, words

BITS = 18  # 2**18 hashed vectors
DIM = 12
CHAR_NGRAMS = (3, 4)
TRAIN_ROWS = 2500  # the fit reads so many labelled rows at most, those with the least MD5 of their id
TRAIN_BYTES = 256 << 20  # and so many bytes of their features
EPOCHS = 6
RATE = 8.0
SEED = 5
SCORE_PLACES = 9  # scores are rounded to so many decimal places


@dataclass
class Model:
    weight: np.ndarray  # of each hash: its vector times the difference of the two output rows
    bias: float


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Kinds of features: hashes, and for every text where its own begin (and the end).

    A word that repeats the one before makes the pair "again", whatever the word.
    """
    prefix = prefix_hashes(buf)
    starts, ends, first = words(buf, offs)
    w = span_hashes(prefix, starts, ends)
    shift = U64(64 - BITS)
    out, at = [w >> shift], [first]
    after = w[1:]
    pair = np.where(after == w[:-1], U64(1), mix64(w[:-1] * U64(0xD6E8FEB86659FD93) + after) >> shift)
    joins = np.zeros(w.size + 1, np.int64)  # no pair from one text to the next
    inside = np.ones(max(0, w.size - 1), bool)
    cut = first[(first > 0) & (first < w.size)] - 1
    inside[cut] = False
    np.cumsum(inside, out=joins[1:w.size] if w.size else joins[:0])
    joins[w.size:] = joins[max(0, w.size - 1)]
    out.append(pair[inside])
    at.append(joins[first])
    chars = np.flatnonzero((buf & 0xC0) != 0x80)
    char_at = np.searchsorted(chars, offs)
    stops = np.append(chars, buf.size)
    for n in CHAR_NGRAMS:
        m = max(0, chars.size - n + 1)
        h = mix64(span_hashes(prefix, chars[:m], stops[n:n + m]) + U64(n)) >> shift
        own = np.zeros(m + 1, np.int64)
        whole = np.ones(m, bool)
        for back in range(1, n):
            edge = char_at - back
            whole[edge[(edge >= 0) & (edge < m) & (char_at < chars.size)]] = False
        np.cumsum(whole, out=own[1:])
        out.append(h[whole])
        at.append(own[np.minimum(char_at, m)])
    return out, at


def train(bags: list[tuple[np.ndarray, np.ndarray, int]], *, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = SEED) -> Model:
    """bags: of every text its distinct hashes, their shares of its features, and the label (0 or 1)."""
    rng = np.random.Generator(np.random.PCG64(seed))
    vectors = (rng.random((1 << BITS, dim), dtype=np.float32) * 2 - 1) / np.float32(dim)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    layer[1] = rng.uniform(-1, 1, dim)
    layer[0] = -layer[1]
    steps, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            ids, share, label = bags[k]
            step = np.float32(rate * (1 - done / steps))
            done += 1
            x = vectors[ids]
            mean = share @ x
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer.T @ p
            layer -= np.float32(0.02) * step * np.outer(p, mean)
            bias -= np.float32(0.02) * step * p
            vectors[ids] = x - step * share[:, None] * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0]))


def packed(ids: np.ndarray, n: np.ndarray) -> bytes:
    """Rising hashes and how often each occurs, in about a quarter of 8 bytes each."""
    return zlib.compress(np.concatenate((np.diff(ids, prepend=0), n)).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes, and their shares of all features of the text."""
    steps, n = np.frombuffer(zlib.decompress(bag), np.uint8).reshape(4, -1).T.copy().view("<i4").reshape(2, -1)
    return np.cumsum(steps, dtype=np.int32), (n / max(1, n.sum(dtype=np.int64))).astype(np.float32)


def held_out(id_col, folds: int = 5):
    return F.pmod(F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")), F.lit(folds)) == 0


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES, **options) -> Model:
    """Learns from at most ``max_rows`` labelled documents that are not held out.

    Of rows with the same id the one with the least text hash counts. The driver
    holds 8 bytes for every distinct feature of a text, ``max_bytes`` in all: ids are
    taken in the order of their MD5, those that no longer fit are passed over.
    They come packed, one partition at a time.
    Rows without a label or id are left out. Without a row, or with one label
    only, the model gives that label's share to every text.
    """
    ident = F.col(quoted(id_col))
    known = labels.where(F.col(quoted(label_col)).isin(0, 1) & ident.isNotNull() & ~held_out(ident))
    known = known.groupBy(ident.alias("key")).agg(F.max(quoted(label_col)).cast("int").alias("label"))
    sample = known.orderBy(F.md5(F.col("key").cast("string")), "key").limit(max_rows)
    rows = docs.select(ident.alias("key"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("body"))
    chosen = (rows.join(F.broadcast(sample), "key")  # bounded by max_rows
              .groupBy("key", "label").agg(F.min(F.struct(F.xxhash64("body").alias("h"), "body"))["body"].alias("body")))

    def run(batches):
        for batch in batches:
            bags = []
            for i, _, buf, offs in pieces(batch.column(2), SMALL_PIECE):
                kinds, at = features(buf, offs)
                for j in range(offs.size - 1):
                    ids, n = np.unique(np.concatenate([k[a[j]:a[j + 1]] for k, a in zip(kinds, at, strict=True)]), return_counts=True)
                    bags.append((8 * ids.size, packed(ids, n)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(1),
                 pa.array([b[0] for b in bags], pa.int64()), pa.array([b[1] for b in bags], pa.binary())],
                names=["key", "label", "n", "bag"])
    found = stage(chosen.select("key", "label", "body").mapInArrow(run, "key string, label int, n long, bag binary"))
    sizes = found.select("key", "n").orderBy(F.md5("key"), "key").collect()
    fit_in, total = [], 0
    for key, n in sizes:
        if total + n <= max_bytes:
            total += n
            fit_in.append(key)
    # collect() would hold all of them several times over in the driver's JVM
    bags = (found if len(fit_in) == len(sizes) else found.where(F.col("key").isin(fit_in))).toLocalIterator()
    named = sorted(((r["key"], *unpacked(r["bag"]), r["label"]) for r in bags), key=lambda r: (len(r[0]), r[0]))  # a row a key
    ready = [r[1:] for r in named]
    if len({r[2] for r in ready}) < 2:
        share = min(max(np.mean([r[2] for r in ready]) if ready else 0.5, 1e-3), 1 - 1e-3)
        return Model(np.zeros(1 << BITS), float(np.log(share / (1 - share))))
    return train(ready, **options)


def score(docs: DataFrame, model: Model, *, text_col: str = "text", names: tuple[str, str] = ("score", "predicted"),
          threshold: float = 0.3) -> DataFrame:
    """All columns of ``docs`` plus score (0 to 1) and predicted (1 if score >= threshold).

    Whole texts are scored; null and empty ones by the bias alone. Input columns
    named like the two new ones get the suffix ``_src``.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    # only texts go to Python and only numbers come back; the other columns wait in the JVM
    @F.arrow_udf("double")
    def probability(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight, bias = held.value.weight, held.value.bias
        for body in bodies:
            out = np.zeros(len(body))
            for i, end, buf, offs in pieces(body, SMALL_PIECE):
                kinds, at = features(buf, offs)
                total, n = np.zeros(end - i), np.zeros(end - i)
                for k, a in zip(kinds, at, strict=True):
                    running = np.concatenate(([0.0], np.cumsum(weight[k])))
                    total += running[a[1:]] - running[a[:-1]]
                    n += np.diff(a)
                out[i:end] = total / np.maximum(n, 1)
            yield pa.array(1 / (1 + np.exp(-(out + bias))))
    body = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    scored = docs.select(*payload(docs, docs.columns, (*names, "_quality_p")), probability(body).alias("_quality_p"))
    # rounded before it is judged, so that the score shown and the judgement agree
    scored = scored.withColumn("_quality_p", F.round("_quality_p", SCORE_PLACES))
    return scored.withColumn(names[0], F.col("_quality_p")).withColumn(names[1], (F.col("_quality_p") >= threshold).cast("int")).drop("_quality_p")
