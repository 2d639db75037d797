"""Benchmark decontamination: every passage of the corpus queries a BM25 index of the test items.

The index keeps, for every term, the BM25 impacts on the items, each divided by
the item's score against itself (1.0: the whole item). Retrieval is block-max
WAND with blocks of consecutive items, the same for all terms: a passage whose
terms' greatest impacts don't reach the threshold is skipped at once; a block of
items is skipped if the terms' greatest impacts in the block don't; only items
of the other blocks are scored. All items at or above the threshold are then
verified: shares of the shingles of their question and of their answer in the passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, stage
from .textarrays import NOT_WORD, SMALL_PIECE, pieces, rolled_shingles, whole_sequence, word_hashes

K1, B = 1.2, 0.75  # the usual BM25 constants
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
ITEM_BLOCK = 16
INDEX_WORDS = 2_000_000  # words of items in one index; more items are searched index by index
LEAST_STRIDE = 32


@dataclass
class Index:
    """Items with their terms; what one pass over the corpus is searched for."""
    items: list
    terms: np.ndarray       # sorted hashes
    most: np.ndarray        # greatest impact of each term
    block_at: np.ndarray    # term -> its blocks in block_id, block_most
    block_id: np.ndarray
    block_most: np.ndarray
    post_at: np.ndarray     # entry of block_id -> its postings
    post_item: np.ndarray
    post_impact: np.ndarray
    parts: list             # for each item the shingles of question and answer
    stride: int
    threshold: float

    def search(self, found: np.ndarray) -> list[tuple[int, float]]:
        """(item, score) at or above the threshold; found: the passage's distinct terms that the index has."""
        if self.most[found].sum() < self.threshold:
            return []
        at = _runs(self.block_at[found], self.block_at[found + 1])
        bound = np.bincount(self.block_id[at], self.block_most[at])
        hot = at[bound[self.block_id[at]] >= self.threshold - 1e-9]
        if not hot.size:
            return []
        post = _runs(self.post_at[hot], self.post_at[hot + 1])
        score = np.bincount(self.post_item[post], self.post_impact[post])
        return [(int(i), float(score[i])) for i in np.flatnonzero(score >= self.threshold - 1e-9)]


def _runs(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """begin[0] .. end[0] - 1, begin[1] .. end[1] - 1, ..."""
    size = end - begin
    skip = np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size)
    return skip + np.arange(size.sum())


def split_item(text: str) -> tuple[str, str]:
    """(question, answer) of an item with one text: the answer is its last sentence, else its last quarter of words."""
    body = text.rstrip().rstrip(".!?")
    cut = max(body.rfind(c) for c in ".!?")
    if cut >= 0 and cut + 1 < len(body):
        return text[:cut + 1], text[cut + 1:]
    w = text.split()
    n = max(1, len(w) // 4)
    return " ".join(w[:-n]), " ".join(w[-n:])


def _hashes(text: str) -> np.ndarray:
    return word_hashes(*next(pieces(pa.array([text], pa.large_string())))[2:], NOT_WORD)[0]


def _shingles(w: np.ndarray) -> np.ndarray:
    return np.unique(rolled_shingles(w, SHINGLE)) if w.size >= SHINGLE else whole_sequence(w) if w.size else w


def _parts(row) -> tuple[np.ndarray, np.ndarray]:
    q, a = (row["text"], row["answer"]) if row["answer"] is not None else split_item(row["text"])
    return _hashes(q), _hashes(a)


def build_indexes(items: DataFrame, *, item_col: str = "item_id", text_col: str = "text",
                  answer_col: str | None = None, threshold: float = THRESHOLD, index_words: int = INDEX_WORDS):
    """Yields an index for every ``index_words`` words of items; document frequencies are those of all items."""
    rows = stage(items.select(F.col(quoted(item_col)).alias("item"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"),
                              (F.col(quoted(answer_col)) if answer_col else F.lit(None).cast("string")).alias("answer")))

    def counted(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                w = np.concatenate(_parts(row))
                out += [(int(t), w.size) for t in np.unique(w).astype(np.int64)] + [(0, w.size)] * (not w.size)
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.int64()),
                                              pa.array([n for _, n in out], pa.int64())], names=["t", "n"])
    terms = stage(rows.mapInArrow(counted, "t long, n long"))
    df_of = stage(terms.groupBy("t").agg(F.count(F.lit(1)).alias("df")))
    n_items, stride = rows.count(), max(LEAST_STRIDE, terms.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])

    held, size = [], 0
    for row in rows.orderBy("item", "text").toLocalIterator():
        q, a = _parts(row)
        if not q.size + a.size:
            continue
        held.append((row["item"], q, a))
        size += q.size + a.size
        if size >= index_words:
            yield _index(held, df_of, n_items, stride, threshold)
            held, size = [], 0
    if held:
        yield _index(held, df_of, n_items, stride, threshold)


def _index(held: list, df_of: DataFrame, n_items: int, stride: int, threshold: float) -> Index:
    words = [np.concatenate((q, a)) for _, q, a in held]
    own = np.unique(np.concatenate(words))
    wanted = df_of.sparkSession.createDataFrame(pa.table({"t": own.astype(np.int64)}))  # a list would start Python workers of its own
    df = np.zeros(own.size)
    for t, n in df_of.join(wanted, "t").collect():  # no more rows than words in the index
        df[np.searchsorted(own, np.int64(t).astype(np.uint64))] = n
    idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
    mean = sum(w.size for w in words) / len(words)
    term, item, impact = [], [], []
    for i, w in enumerate(words):
        t, tf = np.unique(w, return_counts=True)
        t = np.searchsorted(own, t)
        s = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * w.size / mean))
        term.append(t)
        item.append(np.full(t.size, i))
        impact.append(s / s.sum())
    term, item, impact = map(np.concatenate, (term, item, impact))
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], impact[order]
    block = item // ITEM_BLOCK
    at = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1]))))
    return Index([h[0] for h in held], own, np.maximum.reduceat(impact, np.searchsorted(term, np.arange(own.size))),
                 np.searchsorted(term[at], np.arange(own.size + 1)), block[at], np.maximum.reduceat(impact, at),
                 np.append(at, term.size), item, impact,
                 [(_shingles(q), _shingles(a)) for _, q, a in held], stride, threshold)


def _hits(index: Index, buf: np.ndarray, offs: np.ndarray):
    """(text, item, score, question share, answer share) of every verified passage."""
    w, first = word_hashes(buf, offs, NOT_WORD)
    if not w.size:
        return
    place = np.minimum(np.searchsorted(index.terms, w), index.terms.size - 1)
    known = index.terms[place] == w
    total = np.concatenate(([0.0], np.cumsum(np.where(known, index.most[place], 0.0))))
    rolled = rolled_shingles(w, SHINGLE)
    sizes = np.diff(first)
    per = np.maximum(1, -(-sizes // index.stride) - 1) * (sizes > 0)
    text = np.repeat(np.arange(sizes.size), per)
    begin = first[text] + index.stride * (np.arange(text.size) - np.repeat(np.cumsum(per) - per, per))
    end = np.minimum(begin + 2 * index.stride, first[text + 1])
    for p in np.flatnonzero(total[end] - total[begin] >= index.threshold - 1e-9):  # bounds: repeated terms count again
        a, b = begin[p], end[p]
        found = np.unique(place[a:b][known[a:b]])
        hits = index.search(found)
        if hits:
            here = rolled[a:max(a, b - SHINGLE + 1)]
            here = here if b - a >= SHINGLE else whole_sequence(w[a:b])
            for i, score in hits:
                q, s = (_share(part, here, w[a:b]) for part in index.parts[i])
                if q >= OVERLAP and s >= OVERLAP:
                    yield int(text[p]), i, score, q, s


def _share(part: np.ndarray, shingles: np.ndarray, w: np.ndarray) -> float:
    """Share of a part's shingles in the passage; a part of few words is looked for as a whole; an empty one is there."""
    if not part.size:
        return 1.0
    share = float(np.isin(part, shingles).mean())
    if share == 0.0 and part.size == 1:
        for n in range(1, min(SHINGLE, w.size + 1)):
            if any(whole_sequence(w[i:i + n])[0] == part[0] for i in range(w.size - n + 1)):
                return 1.0
    return share


def contaminations(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, item_id, n_passages, bm25, question_overlap, answer_overlap): documents with the items found in them.

    Passages are windows of words, twice as long as the longest item and half
    overlapping, over whole texts. Null and empty texts and items without words
    match nothing; without items the result is empty. Rows alike in id are
    reported as one. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema[options.get("item_col", "item_id")].dataType
    schema = f"id {kind}, item {item_kind.simpleString()}, bm25 double, q double, a double"
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("body"))
    out = docs.sparkSession.createDataFrame([], schema)
    for index in build_indexes(items, **options):
        held = docs.sparkSession.sparkContext.broadcast(index)  # bounded by INDEX_WORDS

        def run(batches, held=held):
            for batch in batches:
                found = [(i + t, *rest) for i, _, buf, offs in pieces(batch.column(1), SMALL_PIECE) for t, *rest in _hits(held.value, buf, offs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                     pa.array([held.value.items[f[1]] for f in found], batch_type),
                     *[pa.array([f[c] for f in found], pa.float64()) for c in (2, 3, 4)]], names=["id", "item", "bm25", "q", "a"])
        batch_type = pa.int64() if item_kind.simpleString() == "bigint" else pa.string() if item_kind.simpleString() == "string" else pa.int32()
        out = out.union(rows.mapInArrow(run, schema))
    return out.groupBy(F.col("id").alias(id_col), F.col("item").alias("item_id")).agg(
        F.count(F.lit(1)).alias("n_passages"), F.max("bm25").alias("bm25"),
        F.max("q").alias("question_overlap"), F.max("a").alias("answer_overlap"))


def decontaminate(docs: DataFrame, items: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold an item; no row is shuffled, all columns stay as they are."""
    out = docs
    for index in build_indexes(items, **options):
        held = docs.sparkSession.sparkContext.broadcast(index)
        out = out.where(~_holds_item(held)(F.coalesce(F.col(quoted(text_col)), F.lit(""))))
    return out


def _holds_item(held):
    """Whether a text holds an item of the index; only texts go to Python, the other columns wait in the JVM."""
    @F.arrow_udf("boolean")
    def holds_item(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for body in bodies:
            dirty = np.zeros(len(body), bool)
            for i, _, buf, offs in pieces(body, SMALL_PIECE):
                for hit in _hits(held.value, buf, offs):
                    dirty[i + hit[0]] = True
            yield pa.array(dirty)
    return holds_item
