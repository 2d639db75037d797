"""Cross-tokenizer alignment against byte ranges compared one by one."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quaystone.llm import align
from quaystone.llm.registry import BYTES, PIECES

from .conftest import SCHEMA, sentence


def byte_decoder():
    from tokenizers.pre_tokenizers import ByteLevel

    step = ByteLevel(add_prefix_space=False, use_regex=False)
    return {step.pre_tokenize_str(chr(b))[0][0]: b for b in range(128)}


def plain_tokens(texts):
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(BYTES, encoding="utf-8") as f:
        vocab = {k: e for e, k in json.load(f)["model"]["vocab"].items()}
    table, n = {}, 0
    for byte in range(256):  # the usual byte to character table, built anew
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            table[chr(byte)] = byte
        else:
            table[chr(256 + n)] = byte
            n += 1
    assert all(table[c] == byte for c, byte in byte_decoder().items())
    out = []
    for text in texts:
        if not text:
            out.append(([], []))
            continue
        ta = [(k, bytes(table[c] for c in vocab[k])) for k in a.encode(" " + text, add_special_tokens=False).ids]
        tb = []
        for k in b.encode(text):
            piece = b.id_to_piece(k)
            tb.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
        goal = (" " + text).encode()
        same = b"".join(x for _, x in ta) == goal and b"".join(x for _, x in tb) == goal
        out.append((ta, tb) if same else ([], []))
    return out


def spans(tokens):
    at, out = 0, []
    for _, raw in tokens:
        out.append((at, at + len(raw)))
        at += len(raw)
    return out


def plain(texts):
    rows, total = [], Counter()
    for ta, tb in plain_tokens(texts):
        sa, sb = spans(ta), spans(tb)
        links, low = [], 0
        for i, (a0, a1) in enumerate(sa):
            while low < len(sb) and sb[low][1] <= a0:
                low += 1
            j = low
            while j < len(sb) and sb[j][0] < a1:
                links.append((ta[i][0], tb[j][0]))
                j += 1
        groups, shared, i, j = [], sorted({e for _, e in sa} & {e for _, e in sb}), 0, 0
        for end in shared:
            x = [k for k in range(i, len(sa)) if sa[k][1] <= end] if len(sa) < 3_000 else None
            if x is None:
                x = []
                while i + len(x) < len(sa) and sa[i + len(x)][1] <= end:
                    x.append(i + len(x))
            y = []
            while j + len(y) < len(sb) and sb[j + len(y)][1] <= end:
                y.append(j + len(y))
            groups.append(",".join(str(ta[k][0]) for k in x) + "|" + ",".join(str(tb[k][0]) for k in y))
            i, j = i + len(x), j + len(y)
        total.update(links)
        rows.append((len(ta), len(tb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = defaultdict(int)
    for (_, b), c in total.items():
        most[b] = max(most[b], c)
    return total, [(na, nb, ng, len(ln), sum(total[p] == most[p[1]] for p in ln), sum(total[p] for p in ln), sha)
                   for na, nb, ng, ln, sha in rows]


def align_texts():
    rng = random.Random(2)
    return [None, "", " ", "a", "The quick  brown fox,\n\tjumps over 12345 lazy dogs!", "<|endoftext|> <s> </s> <unk>", "▁ under ▁score",
            "naïve café – Grüße 中文字符 日本語 \U0001f600\U0001f600 Ω", "\x00\x01\x7f", "\r\n\r\n  x ", "ﬁ ligature ½", "a" * 3_000, " " * 500,
            "\n" * 300 + "end", "def f(x):\n    return x ** 2  # π\n" * 200, sentence(rng, 6_000), "é" * 2_000 + " zz", "é ​﻿",
            "internationalization tokenization misaligned " * 30, "x", "a"] + [sentence(rng, rng.randint(1, 40)) for _ in range(60)]


@pytest.fixture(scope="module")
def table(spark):
    texts = align_texts()
    rows = [(i, t, "en", "s", 1, 2, "k", 3, 0.5) for i, t in enumerate(texts)] + [(4, texts[4], *["x"] * 2, 1, 2, "k", 3, 0.5)] * 3
    rows.append((None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("options", [{}, {"lane": 3, "batch_bytes": 200}, {"broadcast_pairs": 20}, {"broadcast_pairs": 0, "lane": 40}])
def test_alignment(table, options):
    rows = table.select("doc_id", "text").collect()
    total, want = plain([t for _, t in rows])
    texts, pairs = align.alignment(table, path_a=BYTES, path_b=PIECES, keep=("doc_id",), **options)
    got = [tuple(r) for r in texts.select(*NAMES, "doc_id").collect()]
    assert sorted(got, key=str) == sorted([(*w, i) for (i, _), w in zip(rows, want, strict=True)], key=str)
    assert {(r["a"], r["b"]): r["total"] for r in pairs.collect()} == total
    assert sum(w[0] == 0 for w in want) >= 3 and any(w[0] > 2_000 for w in want)


def test_clashing_names_and_empty(spark, table):
    odd = table.withColumnRenamed("n_chars", "n_a").withColumnRenamed("shard", "weird` name")
    texts, _ = align.alignment(odd, path_a=BYTES, path_b=PIECES, keep=("n_a", "weird` name"))
    assert texts.columns == [*NAMES, "n_a_src", "weird` name"]
    assert texts.where("n_a_src = 1 and `weird`` name` = 2").count() == table.count() - 1
    texts, pairs = align.alignment(table.where("false"), path_a=BYTES, path_b=PIECES)
    assert texts.count() == 0 and pairs.count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_lockstep_merge(seed):
    """Random ends of several texts: links are the overlaps, cuts the shared ends, whatever the lanes."""
    rng = np.random.default_rng(seed)
    first_a, first_b, ends_a, ends_b, at = [0], [0], [], [], 0
    for _ in range(12):
        n = int(rng.integers(0, 200))
        for ends, first in ((ends_a, first_a), (ends_b, first_b)):
            inner = np.flatnonzero(rng.random(max(0, n - 1)) < 0.4) + 1
            ends += [at + int(x) for x in inner] + ([at + n] if n else [])
            first.append(len(ends))
        at += n
    ends_a, ends_b, first_a, first_b = map(np.array, (ends_a, ends_b, first_a, first_b))
    begin_a, begin_b = np.concatenate(([0], ends_a[:-1])), np.concatenate(([0], ends_b[:-1]))
    want = {(i, j) for i in range(ends_a.size) for j in range(ends_b.size) if begin_a[i] < ends_b[j] and begin_b[j] < ends_a[i]}
    for lane in (1, 2, 7, 1_000):
        la, lb, ca, cb = align.merge(ends_a, ends_b, align.lanes(ends_a, first_a, ends_b, first_b, lane))
        assert sorted(zip(la.tolist(), lb.tolist(), strict=True)) == sorted(want)
        assert sorted(ends_a[ca]) == sorted(ends_b[cb]) == sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
