"""License scans by conditional compression.

Bounded, overlapping windows of words around cue words are compressed with
Zstandard twice: alone, and with a license template as raw dictionary. Templates
are ranked by the bytes that they spare, and those that spare some are confirmed
by the words that differ. Windows without a confirmed notice are given by the
template that explains them best.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted
from .license_texts import TEMPLATES
from .textarrays import LOWER, pieces

# What makes a line a candidate (in lower case).
CUES = ("licens", "licenc", "copyright", "spdx-", "released under", "creative commons", "public domain",
        "all rights reserved", "hereby granted", "free software", "mozilla public", "eclipse public", "creativecommons.org",
        "redistribution and use", "free and unencumbered", "permission is granted to anyone", "altered source versions",
        "to the extent possible under law")
# Words that make another license of a name; none may be added inside a notice.
QUALIFIERS = frozenset(("lesser", "library", "affero", "noncommercial", "non-commercial", "sharealike", "share-alike",
                        "noderivatives", "noderivs", "nc", "nd", "sa", "attribution", "advertising", "evil"))
SPDX_TAG = "spdx-license-identifier"
SPDX_JOINS = ("or", "and", "with")
GAP = 2          # candidate lines so near to each other are one block
FAR = 4096       # cues of a long line with so many bytes between them are in two blocks
GROUP = 2048     # cues within so many bytes are judged in one window
KEEP_SHARE = 0.5  # unconfirmed blocks: templates that spare at least so much of what the best one spares are compared
SPARED = 1       # templates that spare so many bytes of a tile are compared with its words
TILES = (16, 64)  # words that a notice has at most, by which tiles of twice so many are cut for the ranking
MISSING = 0.1    # share of a template's words that may be missing or changed
WORD_BYTES = 48  # a window of n words has n times so many bytes at most
EXTRA = 8        # a quarter of the template's words, and so many or another quarter, may be added inside a notice
LEVEL = 19

WORDS = re.compile(r"[\w.\-]*\w")
VERSION = re.compile(r"v?\d")
WORD_COST, NEVER = 16, 1 << 20  # of a missing word, in added words; of a change that no notice may have


def _cues(lower: bytes) -> list[int]:
    """First bytes of all cue words."""
    out = set()
    for cue in CUES:
        at = lower.find(cue.encode())
        while at >= 0:
            out.add(at)
            at = lower.find(cue.encode(), at + 1)
    return sorted(out)


def candidate_blocks(lower: bytes) -> list[tuple[int, int, int, int, list[int]]]:
    """(first byte, end byte, first line, lines, cues) of the blocks of a text.

    A block is a run of lines with cues; of lines longer than FAR it has what
    lies within FAR / 2 of its cues.
    """
    cues = _cues(lower)
    if not cues:
        return []
    breaks = np.flatnonzero(np.frombuffer(lower, np.uint8) == 10)
    lines = np.searchsorted(breaks, cues).tolist()
    runs: list[list[tuple[int, int]]] = []
    for at, line in zip(cues, lines, strict=True):
        if runs and line - runs[-1][-1][1] <= GAP and at - runs[-1][-1][0] <= FAR:
            runs[-1].append((at, line))
        else:
            runs.append([(at, line)])
    out = []
    for run in runs:
        (first, a), (last, b) = run[0], run[-1]
        begin = max(int(breaks[a - 1]) + 1 if a else 0, first - FAR // 2)
        end = min(int(breaks[b]) if b < breaks.size else len(lower), last + FAR // 2)
        while begin < first and lower[begin] & 0xC0 == 0x80:  # whole characters only
            begin += 1
        while end < len(lower) and lower[end] & 0xC0 == 0x80:
            end += 1
        out.append((begin, end, a, b - a + 1, [at for at, _ in run]))
    return out


def _words(text: str) -> list[str]:
    return [w.lower() for w in WORDS.findall(text)]


def _text(data: bytes) -> str:
    return data.decode("utf-8", "surrogateescape")  # encodes back to the same bytes


def _left(text: bytes, at: int, n: int) -> int:
    """Where the last ``n`` words before ``at`` begin."""
    part = _text(text[max(0, at - WORD_BYTES * n):at])
    spans = [m.start() for m in WORDS.finditer(part)]
    return at - len(part[spans[-n]:].encode("utf-8", "surrogateescape")) if len(spans) > n else max(0, at - WORD_BYTES * n)


def _right(text: bytes, at: int, n: int) -> int:
    """Where the first ``n`` words from ``at`` on end."""
    part = _text(text[at:at + WORD_BYTES * n])
    spans = [m.end() for m in WORDS.finditer(part)]
    return at + len(part[:spans[n - 1]].encode("utf-8", "surrogateescape")) if len(spans) > n else min(len(text), at + WORD_BYTES * n)


class Scanner:
    """Compressors and word lists for a set of templates."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]]):
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.known, self.vocabulary, self.bare = [], {}, []
        for name, texts in templates.items():
            for text in texts:
                raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(level=LEVEL)
                words = _words(text)
                raw_words = zstandard.ZstdCompressionDict((" ".join(words) or " ").encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw_words.precompute_compress(level=LEVEL)
                self.bare.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=raw_words, write_content_size=False))
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)
                # a version or a qualifier may not be missing
                cost = np.array([NEVER if w in QUALIFIERS or VERSION.match(w) else WORD_COST for w in words], np.int64)
                self.known.append((name, ids, cost, zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False)))
        self.sizes = np.array([ids.size for _, ids, _, _ in self.known], np.int64)
        self.bags = np.zeros((len(self.known), len(self.vocabulary)), np.int32)
        for k, (_, ids, _, _) in enumerate(self.known):
            np.add.at(self.bags[k], ids, 1)
        self.tags = {}  # identifiers of SPDX lines
        for name in templates:
            raw = zstandard.ZstdCompressionDict(f"SPDX-License-Identifier: {name}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            tag = name, zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False)
            for end in ("", "-only", "-or-later"):
                self.tags.setdefault(name.lower() + end, tag)
        most = int(self.sizes.max(initial=0))
        self.reach = most + most // 4 + EXTRA  # words that a notice has at most on either side of a cue
        # words from the first to the last of a notice, and the tiles that one lies in whole
        spread = self.sizes + self.sizes // 4 + np.minimum(EXTRA, self.sizes // 4)
        steps = np.array(sorted({*TILES, int(spread.max(initial=1))}), np.int64)
        self.step = steps[np.searchsorted(steps, spread)]
        self.seen: dict[bytes, list] = {}
        self.gains: dict[tuple[bytes, int], list[int]] = {}

    def spared(self, text: bytes, ks: Iterable[int]) -> list[int]:
        alone = len(self.plain.compress(text))
        return [alone - len(self.known[k][3].compress(text)) for k in ks]

    def ranked(self, words: list[str], own: np.ndarray) -> list[int]:
        """The templates that spare bytes of the window's words, the one that spares most first.

        Words are compressed bare, in tiles of twice the words that a notice may
        have, half of them in the next tile too, so that every notice lies whole
        in a tile and is no small part of it. No template can be confirmed in a
        tile that lacks more than MISSING of its words, so none is compressed there.
        """
        gains: dict[int, int] = {}
        ks = self.able(own, np.flatnonzero(self.sizes))
        for step in np.unique(self.step[ks]).tolist():
            own_step = ks[self.step[ks] == step]
            for at in range(0, max(1, own.size - step), step):
                able = self.able(own[at:at + 2 * step], own_step).tolist()
                if able:
                    tile = " ".join(words[at:at + 2 * step]).encode("utf-8", "surrogateescape")
                    alone = len(self.plain.compress(tile))
                    for k in able:
                        gains[k] = max(gains.get(k, 0), alone - len(self.bare[k].compress(tile)))
        return sorted((k for k, gain in gains.items() if gain >= SPARED), key=lambda k: (-gains[k], k))

    def able(self, own: np.ndarray, ks: np.ndarray) -> np.ndarray:
        """Those of the templates with at most MISSING of their words not among ``own``."""
        bag = np.bincount(own[own >= 0], minlength=len(self.vocabulary))
        return ks[self.sizes[ks] - np.minimum(self.bags[ks], bag).sum(axis=1) <= MISSING * self.sizes[ks]]

    def place(self, k: int, own: np.ndarray, added_cost: np.ndarray) -> tuple[int, list[int]] | None:
        """(words added, places of the words found) where the template fits best, if it is confirmed there."""
        _, ids, miss, _ = self.known[k]
        m, n = ids.size, own.size
        run = np.concatenate(([0], np.cumsum(added_cost)))
        table = np.zeros((m + 1, n + 1), np.int64)
        for i in range(1, m + 1):
            row = table[i - 1] + miss[i - 1]
            np.minimum(row[1:], np.where(own == ids[i - 1], table[i - 1, :-1], row[1:]), out=row[1:])
            table[i] = np.minimum.accumulate(row - run) + run if i < m else row
        j = int(np.argmin(table[m]))
        if table[m, j] >= NEVER:
            return None
        at, i = [], m
        while i:
            if j and own[j - 1] == ids[i - 1] and table[i, j] == table[i - 1, j - 1]:
                i, j = i - 1, j - 1
                at.append(j)
            elif table[i, j] == table[i - 1, j] + miss[i - 1]:
                i -= 1
            else:
                j -= 1
        if not at:
            return None
        at.reverse()
        added = at[-1] - at[0] + 1 - len(at)
        return (added, at) if m - len(at) <= MISSING * m and added <= m // 4 + min(EXTRA, m // 4) else None

    def tagged(self, text: str, spans: list[tuple[int, int]], words: list[str], own: np.ndarray) -> list[tuple]:
        """The known licenses of SPDX expressions, as confirmed() gives them; their words are taken."""
        out = []
        for i, word in enumerate(words):
            j = i + 1
            # an identifier follows the tag or a joining word, a joining word or a slash an identifier
            while word == SPDX_TAG and j < len(words) and (j == i + 1 or words[j] in SPDX_JOINS or words[j - 1] in SPDX_JOINS
                                                            or text[spans[j - 1][1]:spans[j][0]] == "/"):
                if words[j] in self.tags and words[j - 1] != "with":
                    name, compressor = self.tags[words[j]]
                    a, b = spans[i][0], spans[j][1]
                    tag = f"{text[a:spans[i][1]]}: {text[spans[j][0]:b]}".encode("utf-8", "surrogateescape")
                    out.append((a, b, name, len(self.plain.compress(tag)) - len(compressor.compress(tag)), 0, 0))
                    own[[i, j]] = -1
                j += 1
        return out

    def confirmed(self, text: str) -> list[tuple[int, int, str, int, int, int]]:
        """(first character, end, license, bytes spared, words missing, words added) of the notices of a window."""
        spans = [m.span() for m in WORDS.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        own = np.array([self.vocabulary.get(w, -1) for w in words], np.int64)
        added_cost = np.array([NEVER if w in QUALIFIERS else 1 for w in words], np.int64)
        out = self.tagged(text, spans, words, own)
        ranking = self.ranked(words, own)
        while True:  # what a notice took is not judged again, the words left over are
            best = None
            able = set(self.able(own, np.array(ranking, np.int64)).tolist())
            for k in ranking:  # a template with fewer words than the best one found is not compared
                if k in able and (best is None or self.sizes[k] >= -best[0][0]):
                    fit = self.place(k, own, added_cost)
                    if fit:
                        rank = (-len(fit[1]), int(self.sizes[k]) - len(fit[1]), fit[0], k)
                        if best is None or rank < best[0]:
                            best = rank, fit
            if best is None:
                return out
            k, (added, at) = best[0][-1], best[1]
            found = len(at)
            fit = added, at
            while fit and len(fit[1]) >= found:  # further places of the same template that fit as well
                added, at = fit
                a, b = spans[at[0]][0], spans[at[-1]][1]
                out.append((a, b, self.known[k][0], self.spared(text[a:b].encode("utf-8", "surrogateescape"), [k])[0],
                            int(self.sizes[k]) - len(at), added))
                own[at] = -1
                fit = self.place(k, own, added_cost)

    def explained(self, block: bytes, cues: list[int]) -> tuple[str | None, int, int, int, bool]:
        """The template that spares most in a window of words around a cue, for blocks without a confirmed notice.

        Windows go as far as the templates judged in them are long, so a notice
        is never a small part of what is compressed.
        """
        gains: dict[int, tuple[int, bytes]] = {}
        low = 0
        for reach in sorted({min(16, self.reach), min(64, self.reach), self.reach}):
            fitting = [k for k in range(len(self.known)) if low < self.sizes[k] + EXTRA <= reach]
            low, done = reach, -1
            for at in cues if fitting else ():
                if at <= done:  # all that may be around this cue was in the window before
                    continue
                done = _right(block, at, reach)
                window = block[_left(block, at, reach):_right(block, done, reach)]
                if (window, reach) not in self.gains:
                    if len(self.gains) >= 1024:
                        self.gains.clear()
                    self.gains[window, reach] = self.spared(window, fitting)
                for k, gain in zip(fitting, self.gains[window, reach], strict=True):
                    if k not in gains or gain > gains[k][0]:
                        gains[k] = gain, window
        ranked = sorted(((g, k) for k, (g, _) in gains.items()), key=lambda x: (-x[0], x[1]))
        if not ranked or ranked[0][0] <= 0:
            return None, 0, 0, 0, False
        best = None
        words = list(self.vocabulary)
        for gain, k in ranked:
            if gain < KEEP_SHARE * ranked[0][0]:
                break
            theirs, own = [words[i] for i in self.known[k][1].tolist()], _words(_text(gains[k][1]))
            same = sum(m.size for m in difflib.SequenceMatcher(None, theirs, own, autojunk=False).get_matching_blocks())
            rank = (len(theirs) - same, -gain)
            if best is None or rank < best[0]:
                best = (rank, self.known[k][0], gain, len(theirs) - same, len(own) - same)
        return *best[1:], False

    def judge(self, whole: bytes, begin: int, end: int, cues: list[int], every: list[int]) -> list[tuple[str | None, int, int, int, bool]]:
        """(license, bytes spared, template words missing, words added, confirmed) of the notices of a block; ``every``: all cues of the text."""
        found: dict[str, tuple] = {}
        i = 0
        while i < len(cues):
            j = bisect.bisect_right(cues, cues[i] + GROUP)
            start = _left(whole, cues[i], self.reach)
            window = whole[start:_right(whole, cues[j - 1], self.reach)]
            i = j
            if window not in self.seen:
                if len(self.seen) >= 1024:  # what was judged lately, for texts that come again and again
                    self.seen.clear()
                text = _text(window)
                self.seen[window] = [(*(len(text[:x].encode("utf-8", "surrogateescape")) for x in (a, b)), *rest)
                                     for a, b, *rest in self.confirmed(text)]
            for a, b, name, spared, missing, added in self.seen[window]:
                holds = [bisect.bisect_left(c, start + b) - bisect.bisect_left(c, start + a) for c in (every, cues)]
                if holds[0] and not holds[1]:  # a notice of another block
                    continue
                if name not in found or (missing, added, -spared) < (found[name][2], found[name][3], -found[name][1]):
                    found[name] = name, spared, missing, added, True
        return list(found.values()) or [self.explained(whole[begin:end], [c - begin for c in cues])]


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  templates: Mapping[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """A row for every candidate block and license confirmed in it: id, first_line, n_lines, block, license, spared_bytes, missing_words, added_words, confirmed.

    A notice is confirmed, wherever it lies in the windows of words around the
    block's cues, if its template spares bytes there and no more than a tenth of a template's words are missing or
    changed (versions and words such as Lesser may not be) and few are added, or if an
    SPDX line names its license;
    spared_bytes and added_words are those of the notice itself. A block without a
    confirmed notice has one row, of the template that explains it best; license
    is null where no template spares a byte. Lines of more than FAR bytes are
    given by what lies around their cues. Null and empty texts have no blocks;
    rows alike are reported each. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, first_line int, n_lines int, block string, license string, spared_bytes int, "
              "missing_words int, added_words int, confirmed boolean")

    def run(batches):
        scanner = Scanner(templates)
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
        for batch in batches:
            for i, _, buf, offs in pieces(batch.column(1)):
                rows, found = [], []
                lower, whole = LOWER[buf].tobytes(), buf.tobytes()
                for j, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True), start=i):
                    blocks = candidate_blocks(lower[a:b])
                    every = [c for *_, cues in blocks for c in cues]
                    for begin, end, line, n, cues in blocks:
                        block = whole[a + begin:a + end].decode("utf-8", "replace")
                        for row in scanner.judge(whole[a:b], begin, end, cues, every):
                            rows.append(j)
                            found.append((line, n, block, *row))
                cols = list(zip(*found, strict=True)) if found else [()] * 8
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)]],
                    names=["id", "first_line", "n_lines", "block", "license", "spared_bytes", "missing_words", "added_words", "confirmed"])
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("body"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
