"""Unigram lattice of words: all segmentations into the pieces of a vocabulary, weighted by their probabilities."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np

from .textarrays import U64, prefix_hashes, span_hashes

SPACE_MARK = "▁"  # fixed value: how vocabularies write the space before a word
ZIPF_OFFSET = 2.7  # ranks become probabilities by Zipf's law with the usual offset
CELLS = 1 << 20  # cells (words times length) that are worked on at once


@dataclass
class Vocabulary:
    """Pieces by length in bytes: sorted hashes and their numbers; log probabilities by number.

    Numbers 0 to 255 are single bytes, which make every text possible; the last one is the end of a text.
    """
    lengths: list[int]
    hashes: list[np.ndarray]
    numbers: list[np.ndarray]
    log_p: np.ndarray

    def adapted(self, expected: np.ndarray, prior_weight: float) -> Vocabulary:
        """Expected counts plus ``prior_weight`` counts spread as the present probabilities say."""
        total = expected + prior_weight * np.exp(self.log_p)
        return replace(self, log_p=np.log(total / total.sum()))


def load(path: str) -> Vocabulary:
    """The scores of a SentencePiece model file as a unigram distribution.

    Scores of a unigram model are log probabilities; ranks (whole numbers down
    from 0, as merges have) become probabilities by Zipf's law. Pieces with
    A-Z, control pieces and pieces with a space inside are left out.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.get_score(i) <= -1e8:
            continue
        text = sp.id_to_piece(i).replace(SPACE_MARK, " ")
        if text and " " not in text[1:] and not any("A" <= c <= "Z" for c in text):
            pieces[text.encode()] = sp.get_score(i)
    scores = np.array(list(pieces.values()))
    ranks = bool((scores == np.round(scores)).all())
    weight = 1 / (ZIPF_OFFSET - scores) if ranks else np.exp(scores)
    rare = weight.min() if weight.size else 1.0
    # bytes are as rare as the rarest piece; the end is as likely as the best one
    p = np.concatenate([np.full(256, rare), weight, [weight.max() if weight.size else 1.0]])
    by_length: dict[int, list] = {}
    for number, piece in enumerate(pieces, start=256):
        by_length.setdefault(len(piece), []).append((piece, number))
    lengths = sorted(by_length)
    hashes, numbers = [], []
    for n in lengths:
        buf = np.frombuffer(b"".join(x for x, _ in by_length[n]), np.uint8)
        at = np.arange(len(by_length[n])) * n
        h = span_hashes(prefix_hashes(buf), at, at + n)
        order = np.argsort(h)
        hashes.append(h[order])
        numbers.append(np.array([m for _, m in by_length[n]])[order])
    return Vocabulary(lengths, hashes, numbers, np.log(p / p.sum()))


def _edges(vocab: Vocabulary, buf: np.ndarray, ends_at: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(length, piece number from each byte on or -1); ends_at: where each byte's word ends."""
    prefix = prefix_hashes(buf)
    place = np.arange(buf.size)
    out = []
    for n, known, number in zip(vocab.lengths, vocab.hashes, vocab.numbers, strict=True):
        found = np.full(buf.size, -1, np.int32)
        fits = np.flatnonzero(place + n <= ends_at)
        if not fits.size:
            break
        h = span_hashes(prefix, fits, fits + n)
        k = np.minimum(np.searchsorted(known, h), known.size - 1)
        found[fits] = np.where(known[k] == h, number[k], -1)
        out.append((n, found))
    if out and out[0][0] == 1:  # a single byte that is a piece itself is that piece
        out[0] = (1, np.where(out[0][1] >= 0, out[0][1], buf))
    else:
        out.insert(0, (1, buf.astype(np.int32)))
    return out


def _blocks(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Words in blocks of like length, with CELLS cells at most (a longer word alone)."""
    order = np.argsort(sizes, kind="stable")
    i = 0
    while i < order.size:
        j = i + 1
        step = max(1, CELLS // (int(sizes[order[i]]) + 1))
        j = min(order.size, i + step)
        while j > i + 1 and (j - i) * (int(sizes[order[j - 1]]) + 1) > 2 * CELLS:
            j = i + (j - i) // 2
        yield order[i:j]
        i = j


def _sum_exp(rows: list[np.ndarray]) -> np.ndarray:
    x = np.stack(rows)
    top = x.max(axis=0)
    base = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return base + np.log(np.exp(x - base).sum(axis=0))


def _one_word(edges: list[tuple[int, np.ndarray]], size: int, log_p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(log marginal, piece and expected count of every edge) of one long word: the same recursions edge by edge."""
    parts = [(np.flatnonzero(number[:size - n + 1] >= 0), n, number) for n, number in edges if n <= size]
    begin = np.concatenate([at for at, _, _ in parts])
    end = np.concatenate([at + n for at, n, _ in parts])
    piece = np.concatenate([number[at] for at, _, number in parts])

    def sums(order: np.ndarray, known: list[int], new: list[int]) -> list[float]:
        """Log sums at every place, edges in an order in which a place is complete before it is used."""
        total = [-math.inf] * (size + 1)
        total[known[order[0]]] = 0.0
        for k in order.tolist():
            x, y = total[new[k]], total[known[k]] + weight[k]
            total[new[k]] = y if x == -math.inf else max(x, y) + math.log1p(math.exp(-abs(x - y)))
        return total
    weight, b, e = log_p[piece].tolist(), begin.tolist(), end.tolist()
    forward = np.array(sums(np.argsort(end, kind="stable"), b, e))
    backward = np.array(sums(np.argsort(-begin, kind="stable"), e, b))
    return forward[size], piece, np.exp(forward[begin] + log_p[piece] + backward[end] - forward[size])


def word_log_probs(vocab: Vocabulary, words: list[bytes] | np.ndarray, counts: np.ndarray | None = None
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(log marginal probability of every word, expected counts of the pieces if word counts are given).

    A word is taken with the space before it. Forward recursion in log space
    over the byte positions, all words of a block at once; backward likewise.
    """
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    out, expected = np.zeros(sizes.size), np.zeros(vocab.log_p.size)
    log_p = np.append(vocab.log_p, -np.inf)  # number -1: no piece
    for block in _blocks(sizes):  # none without words
        buf = np.frombuffer(b" " + b" ".join(words[i] for i in block), np.uint8)
        size = sizes[block]
        begin = np.cumsum(size) - size
        edges = _edges(vocab, buf, np.repeat(begin + size, size))
        most = int(size.max())
        if most > 16 * block.size + 64:  # few long words: batching over words has nothing to batch
            for k, i in enumerate(block):
                own = [(n, number[begin[k]:begin[k] + size[k]]) for n, number in edges]
                out[i], piece, share = _one_word(own, int(size[k]), log_p)
                if counts is not None:
                    expected += np.bincount(piece, share * counts[i], minlength=expected.size)
            continue
        forward = np.full((most + 1, block.size), -np.inf)
        forward[0] = 0.0
        for j in range(1, most + 1):  # sizes ascend: the words from here on are long enough
            w = slice(int(np.searchsorted(size, j)), None)
            forward[j, w] = _sum_exp([forward[j - n, w] + log_p[number[begin[w] + j - n]] for n, number in edges if n <= j])
        total = forward[size, np.arange(block.size)]
        out[block] = total
        if counts is None:
            continue
        backward = np.full((most + 1, block.size), -np.inf)
        backward[size, np.arange(block.size)] = 0.0
        for j in range(most - 1, -1, -1):
            w = slice(int(np.searchsorted(size, j + 1)), None)
            rows = []
            for n, number in edges:
                if j + n > most:
                    break
                ww = slice(int(np.searchsorted(size, j + n)), None)
                if ww.start == block.size:
                    continue
                piece = number[begin[ww] + j]
                along = np.full(block.size - w.start, -np.inf)
                along[ww.start - w.start:] = log_p[piece] + backward[j + n, ww]
                rows.append(along)
                share = np.exp(forward[j, ww] + along[ww.start - w.start:] - total[ww]) * counts[block][ww]
                real = piece >= 0
                expected += np.bincount(piece[real], share[real], minlength=expected.size)
            backward[j, w] = _sum_exp(rows)
    return out, expected
