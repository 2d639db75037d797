"""Language-model scores: marginal probability of a text over all segmentations into vocabulary pieces.

The pieces' existing scores are the model's prior; one pass of expected counts
over all words of the training documents adapts them. Beside it stands a plain
word model with additive smoothing, whose counts are those of all training tokens.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, stage
from .lattice import Vocabulary, load, word_log_probs
from .quality import held_out
from .textarrays import LOWER, U64, pieces, prefix_hashes, span_hashes, words

FOLDS = 10
SMOOTHING = 0.1
MAX_FREQUENT = 1 << 20  # the counts of so many most frequent words at most are broadcast; the others are joined
PRIOR_WEIGHT = 10_000.0  # expected counts that the vocabulary's own scores are worth
ROUNDS = 1


def _distinct_words(batch_column):
    """Pieces of a batch with (rows, first word of each text, word -> distinct, distinct hashes, their spelling)."""
    for i, end, buf, offs in pieces(batch_column):
        starts, ends, first = words(buf, offs)
        h = span_hashes(prefix_hashes(buf), starts, ends)
        distinct, at, which = np.unique(h, return_index=True, return_inverse=True)
        low = LOWER[buf].tobytes()

        def spelling(k, low=low, begin=starts[at], stop=ends[at]):
            """Bytes of the distinct words numbered ``k``."""
            return [low[a:b] for a, b in zip(begin[k].tolist(), stop[k].tolist(), strict=True)]
        yield i, end, first, which, distinct, spelling


def word_counts(train: DataFrame) -> DataFrame:
    """(h, word, c): how often each lower-cased word occurs in the column body; partly summed before the shuffle."""
    def run(batches):
        for batch in batches:
            hashes, counts, texts = [np.zeros(0, U64)], [np.zeros(0)], []
            for _, _, _, which, distinct, spelling in _distinct_words(batch.column(0)):
                hashes.append(distinct)
                counts.append(np.bincount(which, minlength=distinct.size))
                texts += spelling(np.arange(distinct.size))
            distinct, at, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            total = np.bincount(which, np.concatenate(counts), minlength=distinct.size).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array([texts[k] for k in at], pa.binary()),
                                              pa.array(total)], names=["h", "word", "c"])
    partial = train.select("body").mapInArrow(run, "h long, word binary, c long")
    return partial.groupBy("h").agg(F.min("word").alias("word"), F.sum("c").alias("c"))


def adapt(vocab: Vocabulary, counts: DataFrame, n_texts: int, prior_weight: float = PRIOR_WEIGHT) -> Vocabulary:
    """One expectation step over all distinct words with their counts; what comes back has a row a piece."""
    held = counts.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        total = np.zeros(held.value.log_p.size)
        for batch in batches:
            total += word_log_probs(held.value, batch.column(0).to_pylist(), batch.column(1).to_numpy())[1]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "n"])
    rows = counts.select("word", F.col("c").cast("double")).mapInArrow(run, "piece int, n double")
    expected = np.zeros(vocab.log_p.size)
    for piece, n in rows.groupBy("piece").agg(F.round(F.sum("n"), 6)).collect():
        expected[piece] = n
    expected[-1] = n_texts
    return vocab.adapted(expected, prior_weight)


def _spelled(counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(h, c, log_p): the words' log probabilities under the lattice."""
    held = counts.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        for batch in batches:
            log_p = word_log_probs(held.value, batch.column(2).to_pylist())[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(log_p)], names=["h", "c", "log_p"])
    return counts.select("h", "c", "word").mapInArrow(run, "h long, c long, log_p double")


def lattice_scores(df: DataFrame, *, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                   folds: int = FOLDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    Rows with crc32(id as text) mod ``folds`` not 0 are learned from (a null id
    counts as the empty text, which is held out); all are scored. Null and empty
    texts are the end token alone. Rows alike in id and text get the same
    scores. With no training rows every token is unknown. Other columns are not read.
    """
    spark = df.sparkSession
    body = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    docs = df.select(F.struct(F.col(quoted(id_col)).alias("id")).alias("own"), held_out(F.col(quoted(id_col)), folds).alias("held_out"),
                     F.xxhash64(F.col(quoted(id_col)), body).alias("rk"), body.alias("body"))
    train = docs.where("not held_out")
    counts = stage(word_counts(train))
    n_train = train.count()
    n_words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_all, n_distinct = n_words + n_train, distinct + (n_train > 0)
    below = n_all + SMOOTHING * (n_distinct + 1)
    end_known, end_base = int(n_train > 0), math.log10((n_train + SMOOTHING) / below)

    vocab = load(vocab_path)
    for _ in range(rounds):
        vocab = adapt(vocab, counts, n_train)

    total, least = 0, 64
    for power, n in sorted(counts.groupBy(F.floor(F.log2("c")).cast("int")).count().collect(), reverse=True):
        total += n
        if total > MAX_FREQUENT:
            break
        least = power
    # the frequent words' counts and log probabilities, sorted by hash: at most MAX_FREQUENT rows
    frequent = _spelled(counts.where(F.col("c") >= F.lit(2 ** min(least, 62))), vocab).toPandas()
    frequent = frequent.assign(h=frequent["h"].to_numpy(np.int64).view(U64)).sort_values("h")
    held = spark.sparkContext.broadcast((vocab, frequent["h"].to_numpy(), frequent["c"].to_numpy(np.int64),
                                         frequent["log_p"].to_numpy()))

    def run(batches):
        model, known_h, known_c, known_p = held.value
        for batch in batches:
            n_tokens, n_known = np.ones(batch.num_rows, np.int64), np.full(batch.num_rows, end_known)
            base, score = np.full(batch.num_rows, end_base), np.full(batch.num_rows, model.log_p[-1])
            tails = []
            for i, end, first, which, distinct, spelling in _distinct_words(batch.column(2)):
                place = np.minimum(np.searchsorted(known_h, distinct), max(0, known_h.size - 1))
                there = known_h[place] == distinct if known_h.size else np.zeros(distinct.size, bool)
                c = np.where(there, known_c[place], 0) if known_h.size else np.zeros(distinct.size)
                log_p = np.zeros(distinct.size)
                log_p[there] = known_p[place[there]] if known_h.size else 0.0
                rare = np.flatnonzero(~there)
                log_p[rare] = word_log_probs(model, spelling(rare))[0]
                log_c = np.where(there, np.log10((c + SMOOTHING) / below), 0.0)
                n_tokens[i:end] += np.diff(first)
                for j, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True), start=i):
                    w = which[a:b]
                    in_table = there[w]
                    score[j] += log_p[w].sum()
                    base[j] += log_c[w].sum()
                    n_known[j] += int(in_table.sum())
                    tails.append(distinct[w[~in_table]].view(np.int64))
            sizes = np.concatenate(([0], np.cumsum([t.size for t in tails])))
            flat = np.concatenate(tails) if tails else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(n_tokens), pa.array(n_known), pa.array(base),
                 pa.array(score / math.log(10)), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat))],
                names=["own", "held_out", "rk", "n_tokens", "known", "base", "score", "tail"])
    kind = docs.schema["own"].dataType.simpleString()
    rows = stage(docs.select("own", "held_out", "body", "rk").mapInArrow(
        run, f"own {kind}, held_out boolean, rk long, n_tokens long, known long, base double, score double, tail array<long>"))
    # the rarer words, with their counts from the whole table
    tail = (rows.where("size(tail) > 0").groupBy("rk").agg(F.first("tail").alias("tail"))
            .select("rk", F.explode("tail").alias("h")))
    seen = tail.join(counts.select("h", "c"), "h", "left").groupBy("rk").agg(
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + F.lit(SMOOTHING)) / F.lit(float(below)))).alias("rare_base"),
        F.count("c").alias("rare_known"))
    out = rows.join(seen, "rk", "left")
    return out.select(
        F.col("own.id").alias(id_col), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score")
