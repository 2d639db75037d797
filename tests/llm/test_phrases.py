"""Phrase mining against plain counts, the merged summaries against their bound."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quaystone.llm import collocate

from .conftest import SCHEMA


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain(rows, least, max_words, top, percent=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    best = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = {}
    for (lang, w), a in best.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = (lang, w[i:i + m])
                inside[key] = max(inside.get(key, 0), a)
    out = []
    for (lang, w), a in best.items():
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        if 100 * inside.get((lang, w), 0) < percent * a:
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def phrases_rows():
    rng = random.Random(11)
    vocab = ["The", "of", "a", "New", "York", "é", "中文", "x y", "Ab", "aB", "z"] + [f"w{k}" for k in range(30)]
    weights = [20, 15, 12, 8, 8, 5, 5, 4, 4, 4, 4] + [1] * 30
    rows = []
    for k in range(160):
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ". ", "!? "]) for w in rng.choices(vocab, weights, k=rng.randint(0, 120)))
        rows.append((text + " new york city " * rng.randint(0, 2), rng.choice(["en", "en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", "fr"), (" \t\n", None), ("w" * 9_000 + " of the", "en"), ("of the " * 4_000, "en"),
             (".,;" * 500, "de"), ("New York " * 40 + ".", "de")] + [rows[3]] * 5
    return rows


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, g, "s", 1, 2, "k", 3, 0.5) for i, (t, g) in enumerate(phrases_rows())]
    return spark.createDataFrame(rows, SCHEMA).repartition(6).cache()


SMALL = {"counters": 8, "filter_bits": 1 << 16, "held": 500, "block_bytes": 300, "held_bytes": 1_000}


@pytest.mark.parametrize("options", [{}, SMALL, SMALL | {"block_bytes": 40}])
def test_collocations(table, options):
    got = [tuple(r) for r in collocate.collocations(table, least=6, top=40, **options).collect()]
    assert sorted(got) == sorted(plain(phrases_rows(), 6, 4, 40))
    assert len({r[0] for r in got}) >= 3


def test_rounds_and_longer_phrases(spark, table):
    """So few filter bits that what survives is counted in several rounds."""
    rows = table.limit(1_000)
    many = [(i, " ".join(f"q{(i * 7 + j) % 900} r{j % 11}" for j in range(400)), "en") for i in range(60)]
    wide = spark.createDataFrame(many, "doc_id long, text string, lang string")
    got = collocate.collocations(wide, least=3, top=100, max_words=5, filter_bits=1 << 14).collect()
    assert sorted(map(tuple, got)) == sorted(plain([(t, g) for _, t, g in many], 3, 5, 100))
    assert collocate.collocations(rows, least=6, top=None).where("rank is not null").count() == 0


def test_empty(spark, table):
    assert collocate.collocations(table.where("false")).count() == 0
    assert collocate.collocations(table.withColumn("text", table.source.substr(9, 1))).count() == 0
    with pytest.raises(ValueError):
        collocate.collocations(table, max_words=1)


@pytest.mark.parametrize("seed", range(4))
def test_merged_summaries_lose_no_frequent_key(seed):
    """Whatever the order and size of what is merged: counters plus what was taken reach the true count, within the bound."""
    rng = np.random.default_rng(seed)
    stream = np.concatenate([rng.zipf(1.3, 30_000) % 5_000, rng.integers(5_000, 30_000, 30_000)]).astype(np.uint64)
    rng.shuffle(stream)
    least = 40
    state = collocate.MisraGries(stream.size // least + 1)
    for part in np.array_split(stream, rng.integers(3, 60)):
        state.add(*collocate._sums(part))
    true = dict(zip(*[x.tolist() for x in np.unique(stream, return_counts=True)], strict=True))
    found = set(state.may_reach(least).tolist())
    assert {k for k, c in true.items() if c >= least} <= found
    assert state.keys.size <= state.capacity and state.taken * (state.capacity + 1) <= stream.size
    assert all(true[k] - state.taken <= c <= true[k] for k, c in zip(state.keys.tolist(), state.counts.tolist(), strict=True))
    assert state.taken > 0


def test_blocks_own_every_byte_once():
    texts = ["ab cd. ef " * 50, "", "x" * 400, "a b c d e f g h " * 30, None, "k."]
    for size in (7, 64, 1_000, 10_000):
        owned = sum(own for _, _, _, own in collocate.blocks(pa.array(texts), size, 3))
        assert owned == sum(len((t or "").encode()) for t in texts)
