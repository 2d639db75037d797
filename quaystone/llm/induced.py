"""Suffix array with common prefixes by induced sorting, NumPy-batched, with disk-backed queues and output.

The suffixes at the left-most places of ascending runs (S*) are sorted first, by
naming their substrings and sorting the text of names, a third as long at most. All others are
induced: in order of the first symbol, every sorted suffix puts the suffix
before it into the queue of that one's first symbol, L suffixes upwards, then
S suffixes downwards. The queues together are a priority queue on the first
symbol. Queues and the sorted parts hold tuples (place, common prefix with the
tuple before it); beyond ``memory`` bytes they go to disk, and both are read
in blocks, so a symbol of any size takes no more memory than another. What a
task holds is the text (two bytes a symbol), the kinds of its places and,
while they are named, the S* places.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

from .textarrays import U64

BLOCK = 1 << 16  # tuples that are scanned at a time

Block = tuple[np.ndarray, np.ndarray]


class Tuples:
    """Per symbol a sequence of (place, common prefix), appended at its end; what doesn't fit in memory waits on disk.

    The file has no name in any folder (it is unlinked when opened) and belongs to this task alone.
    """

    def __init__(self, symbols: int, memory: int):
        self.held: list[list[Block]] = [[] for _ in range(symbols)]
        self.spilled: list[list[tuple[int, int]]] = [[] for _ in range(symbols)]
        self.memory, self.size, self.file, self.spills = memory, 0, None, 0

    def push(self, symbol: int, places: np.ndarray, common: np.ndarray) -> None:
        self.held[symbol].append((places.astype(np.int32), common.astype(np.int32)))
        self.size += 8 * places.size
        if self.size > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.spills += 1
        at = self.file.seek(0, 2)
        for symbol, parts in enumerate(self.held):
            for block in _merged(parts):
                self.file.write(block[0].tobytes())
                self.file.write(block[1].tobytes())
                self.spilled[symbol].append((at, block[0].size))
                at += 8 * block[0].size
            parts.clear()
        self.size = 0

    def _read(self, at: int, n: int) -> Block:
        self.file.seek(at)
        both = np.frombuffer(self.file.read(8 * n), np.int32)
        return both[:n], both[n:]

    def take(self, symbol: int) -> Block | None:
        """The first tuples of a symbol, which leave it; None when there are none."""
        if self.spilled[symbol]:
            return self._read(*self.spilled[symbol].pop(0))
        parts = self.held[symbol]
        if not parts:
            return None
        n = size = 0
        while n < len(parts) and size < BLOCK:
            size += parts[n][0].size
            n += 1
        first, self.held[symbol] = parts[:n], parts[n:]
        self.size -= 8 * size
        return tuple(np.concatenate([p[k] for p in first]) for k in (0, 1))

    def blocks(self, symbol: int, backwards: bool = False) -> Iterator[Block]:
        """All tuples of a symbol, block by block; they stay."""
        parts = [*self.spilled[symbol], *self.held[symbol]]
        for part in reversed(parts) if backwards else parts:
            yield self._read(*part) if isinstance(part[0], int) else part

    def turned(self, symbol: int, edge: int) -> Iterator[Block]:
        """All tuples of a symbol in reverse order; the first has ``edge`` in common with what comes before it now."""
        for places, common in self.blocks(symbol, backwards=True):
            yield places[::-1], np.concatenate(([edge], common[:0:-1])).astype(np.int32)
            edge = int(common[0])


def _merged(parts: list[Block]) -> Iterator[Block]:
    """Neighbouring parts as blocks of about ``BLOCK`` tuples."""
    held, size = [], 0
    for k, part in enumerate(parts):
        held.append(part)
        size += part[0].size
        if size >= BLOCK or k == len(parts) - 1:
            yield tuple(np.concatenate([p[k] for p in held]) for k in (0, 1))
            held, size = [], 0


class _Inducer:
    """Puts what lies before scanned suffixes into queues, with common prefixes.

    Two suffixes that start alike have one symbol more in common than those
    after them, whose common prefix is the least one scanned between them.
    """

    def __init__(self, text: np.ndarray, cap: int, symbols: int, memory: int):
        self.text, self.cap = text, cap
        self.queues = Tuples(symbols, memory)
        self.least = np.zeros(symbols, np.int64)  # of what was scanned since a symbol's last push

    def scan(self, places: np.ndarray, common: np.ndarray, wanted: np.ndarray) -> None:
        """wanted: which have a suffix before them to induce. One that starts like the scanned ones comes after them."""
        at = np.flatnonzero(wanted)
        seen = np.zeros(self.least.size, bool)
        if at.size:
            first = self.text[places[at] - 1]
            order = np.argsort(first, kind="stable")
            cuts = np.flatnonzero(np.diff(first[order])) + 1
            for group in np.split(order, cuts):
                symbol, spots = int(first[group[0]]), at[group]
                least = np.minimum.reduceat(common[:spots[-1] + 1], np.concatenate(([0], spots[:-1] + 1)))
                least[0] = min(least[0], self.least[symbol])
                self.queues.push(symbol, places[spots] - 1, np.minimum(least + 1, self.cap))
                rest = common[spots[-1] + 1:]
                self.least[symbol] = rest.min() if rest.size else self.cap
            seen[first] = True
        if common.size:
            self.least[~seen] = np.minimum(self.least[~seen], common.min())


def _kinds(text: np.ndarray) -> np.ndarray:
    """True for S: the suffix is less than the one after it. The last one (the end, least of all) is S."""
    out = np.ones(text.size, bool)
    # the first change at or after a place decides; looked up in pieces from the end
    later = True
    for end in range(text.size - 1, 0, -(1 << 20)):
        a = max(0, end - (1 << 20))
        rises, falls = text[a:end] < text[a + 1:end + 1], text[a:end] > text[a + 1:end + 1]
        change = np.flatnonzero(rises | falls)
        which = np.searchsorted(change, np.arange(end - a))
        known = which < change.size
        part = np.full(end - a, later)
        part[known] = rises[change[which[known]]]
        out[a:end] = part
        later = bool(part[0])
    return out


def _run(text: np.ndarray, place: int, cap: int) -> int:
    """How often the symbol of a place is repeated from it on, at most ``cap``."""
    other = np.flatnonzero(text[place:place + cap] != text[place])
    return int(other[0]) if other.size else min(cap, text.size - place)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of suffixes, at most ``cap``, symbol by symbol."""
    out = np.zeros(a.size, np.int32)
    width = 16
    for start in range(0, a.size, 1 << 14):
        open_ = np.arange(start, min(a.size, start + (1 << 14)))
        have = 0
        while open_.size and have < cap:
            step = np.arange(have, min(cap, have + width))
            x = a[open_, None] + step
            y = b[open_, None] + step
            inside = np.maximum(x, y) < text.size
            same = inside & (text[np.minimum(x, text.size - 1)] == text[np.minimum(y, text.size - 1)])
            run = np.where(same.all(axis=1), step.size, np.argmin(same, axis=1))
            out[open_] += run.astype(np.int32)
            open_ = open_[run == step.size]
            have += step.size
    return out


def _sorted_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a text of names, by their first ``depth`` names: ranks of 1, 2, 4, ... names."""
    rank, width = names.astype(np.int64) + 1, 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        behind = np.zeros_like(rank)
        behind[:-width] = rank[width:]
        key = rank * (rank.max() + 1) + behind
        order = np.argsort(key, kind="stable")
        step = np.concatenate(([1], (np.diff(key[order]) != 0).astype(np.int64)))
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(step)
        width *= 2
        if rank[order[-1]] == rank.size or width >= rank.size:
            break
    return order


def _sorted_stars(text: np.ndarray, is_s: np.ndarray, stars: np.ndarray, cap: int) -> np.ndarray:
    """S* places by their suffixes' first ``cap`` symbols."""
    if stars.size < 2:
        return stars
    # names: ranks of the substrings from one S* place to the next, compared six symbols (L before S) at a time
    size = np.diff(np.append(stars, text.size - 1)) + 1
    rank = np.zeros(stars.size, np.int32)
    for at in range(0, min(int(size.max()), cap + 8), 6):
        left = np.clip(size - at, 0, 6)
        if not left.any():
            break
        key = np.zeros(stars.size, U64)
        for k in range(6):  # symbols and kinds have 10 bits
            spot = np.minimum(stars + (at + k), text.size - 1)
            key = key * U64(1024) + np.where(k < left, text[spot].astype(U64) * U64(2) + is_s[spot] + U64(1), U64(0))
        order = np.lexsort((key, rank))
        step = (np.diff(rank[order]) != 0) | (key[order][1:] != key[order][:-1])
        new = np.empty_like(rank)
        new[order] = np.concatenate(([0], np.cumsum(step, dtype=np.int32)))
        rank = new
        if rank[order[-1]] == rank.size - 1:
            return stars[order]
    return stars[_sorted_names(rank, cap)]


def sorted_blocks(text: np.ndarray, cap: int, memory: int = 256 << 20, spills: list | None = None) -> Iterator[Block]:
    """Blocks of (places in suffix order, common prefix with the one before up to ``cap``) of a text of symbols 1 to 257.

    Suffixes that agree in ``cap`` symbols or more may come in any order. The end
    counts as a symbol less than all. ``spills`` gets how often something went to disk.
    """
    text = np.append(text, 0).astype(np.uint16)
    n = text.size
    is_s = _kinds(text)
    stars = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    ends_star = stars.size > 0 and stars[-1] == n - 1
    stars = _sorted_stars(text, is_s, stars, cap) if stars.size else stars
    if n > 1 and not ends_star:
        stars = np.concatenate(([n - 1], stars)).astype(np.int32)
    stars = stars[np.argsort(text[stars], kind="stable")] if stars.size else np.array([n - 1], np.int32)
    star_common = np.zeros(stars.size, np.int32)
    star_common[1:] = _common(text, stars[:-1], stars[1:], cap)
    symbols = int(text.max()) + 1
    star_at = np.searchsorted(text[stars], np.arange(symbols + 1))
    share = max(1, memory // 3)

    def before(places: np.ndarray, s: bool) -> np.ndarray:
        """Whether the suffix before is S (or L); the first place has none."""
        return (is_s[places - 1] == s) & (places > 0)

    up, lower, last_l = _Inducer(text, cap, symbols, share), Tuples(symbols, share), [-1] * symbols
    for c in range(symbols):
        while (now := up.queues.take(c)) is not None:
            places, common = now
            if last_l[c] < 0:
                common = common.copy()
                common[0] = 0
            lower.push(c, places, common)
            last_l[c] = int(places[-1])
            up.scan(places, common, before(places, False))
        own = slice(star_at[c], star_at[c + 1])
        if own.start < own.stop:
            places, common = stars[own], star_common[own].copy()
            common[0] = min(_run(text, last_l[c], cap), _run(text, int(places[0]), cap)) if last_l[c] >= 0 else 0
            up.scan(places, common, before(places, False))

    # downwards; a common prefix is now that with the one scanned before, which is greater
    down, upper, last_s = _Inducer(text, cap, symbols, share), Tuples(symbols, share), [-1] * symbols
    for c in range(symbols - 1, -1, -1):
        if c == 0:
            upper.push(0, np.array([n - 1]), np.zeros(1, np.int64))
            last_s[0] = n - 1
            break
        while (now := down.queues.take(c)) is not None:
            places, common = now
            if last_s[c] < 0:
                common = common.copy()
                common[0] = 0
            upper.push(c, places, common)
            last_s[c] = int(places[-1])
            down.scan(places, common, before(places, True))
        edge = min(_run(text, last_l[c], cap), _run(text, last_s[c], cap)) if last_l[c] >= 0 and last_s[c] >= 0 else 0
        for places, common in lower.turned(c, edge):
            down.scan(places, common, before(places, True))

    for c in range(symbols):
        yield from lower.blocks(c)
        edge = min(_run(text, last_l[c], cap), _run(text, last_s[c], cap)) if last_l[c] >= 0 and last_s[c] >= 0 else 0
        yield from upper.turned(c, edge)
    if spills is not None:
        spills.append(sum(t.spills for t in (up.queues, lower, down.queues, upper)))


def suffix_array(text: np.ndarray, cap: int, memory: int = 256 << 20) -> tuple[np.ndarray, np.ndarray, int]:
    """(places in suffix order, common prefixes, spills) as whole arrays."""
    spills: list[int] = []
    found = list(sorted_blocks(text, cap, memory, spills))
    return np.concatenate([p for p, _ in found]), np.concatenate([x for _, x in found]), spills[0]
