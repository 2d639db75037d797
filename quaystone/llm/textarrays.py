"""A batch's texts as NumPy arrays: UTF-8 bytes, words and 64-bit hashes of any span, without per-word Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20  # texts are worked on in pieces of about so many bytes (a longer text is a piece of its own)
SMALL_PIECE = 1 << 17  # for work that holds many arrays of a number for every byte: what a Python worker holds goes by this
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_WORD = np.ones(256, bool)  # all ASCII but letters and digits
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER_PLUS = LOWER.astype(U64) + U64(1)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _powers or _powers[0].size < n:
        size = -(-n >> 18) << 18  # steps, so that somewhat longer texts need no new ones
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, U64(base))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[:] = out
    return _powers[0], _powers[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits; one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null is empty."""
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1]
    offs = offs.astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def pieces(array: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``size`` bytes."""
    buf, offs = utf8(array)
    i, n = 0, len(array)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, side="right")) - 1)
        yield i, j, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def words(buf: np.ndarray, offs: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes outside ``gaps``), and the first word of every text and the end."""
    n = buf.size
    inside = np.zeros(n + 1, bool)
    np.logical_not(gaps[buf], out=inside[:n])
    begins, stops = inside[:n].copy(), inside[:n].copy()
    before, after = np.zeros(n + 1, bool), inside[1:].copy()
    before[1:] = inside[:n]
    before[offs] = False
    edge = offs[offs > 0] - 1
    after[edge] = False
    begins &= ~before[:n]
    stops &= ~after
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offs)


def prefix_hashes(buf: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = the hash of bytes i to j (A-Z lower-cased), times base**i."""
    out = np.zeros(buf.size + 1, U64)
    np.cumsum(_LOWER_PLUS[buf] * powers(buf.size + 1)[0][:buf.size], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span."""
    return mix64((prefix[ends] - prefix[starts]) * powers(prefix.size)[1][starts] + (ends - starts).astype(U64))


def word_hashes(buf: np.ndarray, offs: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word, and the first word of every text."""
    starts, ends, first = words(buf, offs, gaps)
    return span_hashes(prefix_hashes(buf), starts, ends), first


def rolled_shingles(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from every word on (also across texts; callers take what lies in one)."""
    rolled = np.zeros(max(0, w.size - k + 1), U64)
    for i in range(k):
        rolled += w[i:i + rolled.size] * U64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64))
    return mix64(rolled)


def whole_sequence(w: np.ndarray) -> np.ndarray:
    """One hash of a sequence of words."""
    one = np.array([w.size], U64)
    for i in range(w.size):
        one = mix64(one * U64(0x2545F4914F6CDD1D) + w[i:i + 1])
    return one


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """For every text the sorted distinct hashes of its k-word shingles (fewer words: all of them as one; none: empty)."""
    w, first = word_hashes(buf, offs)
    rolled = rolled_shingles(w, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            h = np.sort(rolled[a:b - k + 1])
            out.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
        elif b > a:
            out.append(whole_sequence(w[a:b]))
        else:
            out.append(np.zeros(0, U64))
    return out
