"""Sharding, mixing, scoring, decontamination, license scans and the pipeline on a hard table and the small tables."""

import gc
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quaystone.llm import decontaminate, jaccard, license_scan, lm_score, mix, quality, shard, textarrays
from quaystone.llm.lattice import load, word_log_probs
from quaystone.llm.registry import PIECES
from quaystone.llm.textarrays import pieces, powers

from ..conftest import SF_MID, SF_SMALL
from .conftest import sentence

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def test_shards(spark, hard, nothing):
    out = shard.shard_rows(hard, 4, rows_per_block=6)
    assert out.columns == [*[c if c != "shard" else "shard_src" for c in hard.columns], "shard", "slot"]
    got = out.collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == hard.count() and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) <= set(range(4))
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r["doc_id"], r["text"]) for r in hard.collect())
    again = shard.shard_rows(hard.repartition(3), 4, rows_per_block=6).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert shard.shard_rows(nothing).count() == 0


def test_communication_matrix_law():
    """Margins are exact; a cell's mean and variance are those of the hypergeometric law."""
    cells = []
    for seed in range(1500):
        m = shard.communication_matrix([30, 50, 20], [40, 60], seed)
        assert [sum(r) for r in m] == [30, 50, 20] and [sum(c) for c in zip(*m, strict=True)] == [40, 60]
        cells.append(m[0][0])
    assert abs(np.mean(cells) - 12) < 0.25 and abs(np.var(cells) - 30 * 0.4 * 0.6 * 70 / 99) < 0.6
    big = shard.hypergeometric(np.random.Generator(np.random.PCG64(1)), 10**12, 10**12, 10**6)
    assert abs(big - 5 * 10**5) < 5000


def test_mix(spark, hard, nothing):
    plan = mix.plan_mix(hard).collect()
    rows = [tuple(r) for r in hard.select("doc_id", "text", "source").collect()]
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, budget, target = set(order), 1.5 * sum(size.values()), {}
    while left:
        level = budget / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in left}
            break
        for s in over:
            target[s] = 2.0 * size[s]
            budget -= target[s]
        left -= over
    assert len(plan) == len(rows)
    for r in plan:
        s = r["row"]["source"]
        assert r["source_size"] == size[s] and math.isclose(r["target"], target[s], rel_tol=1e-9)
        rate = target[s] / size[s] if size[s] else 0
        assert r["copies"] in (math.floor(rate), math.floor(rate) + (rate > math.floor(rate)))
    out = mix.mix(hard)
    assert out.columns == hard.columns and out.count() == sum(r["copies"] for r in plan)
    assert mix.plan_mix(nothing).count() == 0


def test_mix_hits_targets(spark):
    plan = mix.plan_mix(spark.read.parquet(f"{SF_MID}/documents.parquet")).groupBy("row.source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target"))
    total = plan.agg(F.sum("taken"), F.sum("target")).first()
    assert abs(total[0] / total[1] - 1) < 0.05


def test_quality(spark, hard, nothing):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    held = quality.score(docs, model).join(labels, "doc_id").where(quality.held_out(F.col("doc_id")))
    right, n = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count(F.lit(1))).first()
    assert n > 40 and right > 0.97
    out = quality.score(hard, model)
    assert out.columns == [*[c if c != "score" else "score_src" for c in hard.columns], "score", "predicted"]
    got = out.collect()
    assert len(got) == hard.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not r["text"]}) == 1
    assert quality.score(nothing, model).count() == 0
    alone = quality.fit(hard, labels.where("quality = 1"))
    assert np.all(alone.weight == 0)
    assert quality.fit(nothing, labels).bias == 0
    again = quality.fit(docs.repartition(7), labels)
    assert np.array_equal(model.weight, again.weight)


def test_features_stay_in_their_text():
    """Batching texts together or apart makes no difference."""
    import pyarrow as pa

    from quaystone.llm.textarrays import pieces
    texts = ["ab ab cd", "", "éa", "x", "cd cd", "中", "long word here"]
    _, _, buf, offs = next(pieces(pa.array(texts)))
    kinds, at = quality.features(buf, offs)
    for j, t in enumerate(texts):
        if not t:
            assert all(a[j] == a[j + 1] for a in at)
            continue
        _, _, b, o = next(pieces(pa.array([t])))
        alone, _ = quality.features(b, o)
        for k, a, own in zip(kinds, at, alone, strict=True):
            assert k[a[j]:a[j + 1]].tolist() == own.tolist()


def test_decontaminate(spark, hard, nothing):
    items = spark.createDataFrame([(1, "Which river flows through the old city of green bridges and seven hills? It is the long winding Tarn river."),
                                   (2, "tiny item"), (3, None), (4, ""), (None, "A question nobody asked about rare basalt columns near lakes. The answer is forty two.")],
                                  "item_id long, text string")
    leak = "which river flows through the OLD city of green bridges and seven hills? it is the long winding tarn river."
    half = "which river flows through the old city of green bridges and seven hills? nobody knows at all."
    pad = " ".join(f"pad{i}" for i in range(500))
    extra = spark.createDataFrame([(900, f"{pad} {leak} {pad}"), (901, leak), (902, f"{pad} {half}"), (903, "a tiny item"), (904, "tiny"),
                                   (905, f"{pad} A question nobody asked about rare basalt columns near lakes. The answer is forty two.")],
                                  "doc_id long, text string")
    docs = hard.select("doc_id", "text", "copy").unionByName(extra, allowMissingColumns=True)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(docs, items).collect()}
    assert got == {(900, 1), (901, 1), (903, 2), (905, None)}
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 4
    small = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(docs, items, index_words=5).collect()}
    assert small == got
    assert decontaminate.contaminations(nothing, items).count() == 0
    assert decontaminate.contaminations(docs, items.limit(0)).count() == 0


def test_block_max_search_loses_nothing(spark):
    """Every item that scores at the threshold on a passage by plain BM25 is retrieved."""
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    index = next(iter(decontaminate.build_indexes(items, threshold=0.2)))
    impact = np.zeros((index.terms.size, len(index.items)))
    term = np.repeat(np.arange(index.terms.size), np.diff(index.post_at[index.block_at]))
    impact[term, index.post_item] = index.post_impact
    rng = np.random.default_rng(2)
    hits = 0
    for _ in range(300):
        found = np.unique(rng.integers(0, index.terms.size, int(rng.integers(1, 400))))
        plain = impact[found].sum(axis=0)
        want = {i for i in range(len(index.items)) if plain[i] >= 0.2}
        got = {i for i, s in index.search(found) if abs(s - plain[i]) < 1e-9}
        assert got == want
        hits += len(want)
    assert hits > 20


def test_lattice():
    vocab = load(PIECES)
    assert abs(np.exp(vocab.log_p).sum() - 1) < 1e-9
    words = [b"the", b"of", "élè中".encode(), b"x" * 700, b"$$%", b"a"]
    known = {}
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i in range(sp.get_piece_size()):
        t = sp.id_to_piece(i).replace("▁", " ")
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) and sp.get_score(i) > -1e8 and t and " " not in t[1:] and not re.search("[A-Z]", t):
            known.setdefault(t.encode(), 256 + len(known))
    for w, got in zip(words, word_log_probs(vocab, words)[0], strict=True):
        b = b" " + w
        f = [0.0] + [-math.inf] * len(b)
        for j in range(1, len(b) + 1):
            along = [f[j - n] + vocab.log_p[known.get(b[j - n:j], b[j - 1] if n == 1 else -1)]
                     for n in range(1, min(j, 48) + 1) if n == 1 or b[j - n:j] in known]
            top = max(along)
            f[j] = top + math.log(sum(math.exp(x - top) for x in along))
        assert math.isclose(got, f[-1], rel_tol=1e-9)
    expected = word_log_probs(vocab, words, np.ones(len(words)))[1]
    size = {n: len(k) for k, n in known.items()}
    assert math.isclose(sum(expected[i] * size.get(i, 1) for i in range(expected.size)), sum(len(w) + 1 for w in words), rel_tol=1e-6)


@pytest.mark.parametrize("most", [1 << 20, 4])
def test_lm_scores(spark, hard, nothing, monkeypatch, most):
    monkeypatch.setattr(lm_score, "MAX_FREQUENT", most)
    rows = [tuple(r) for r in hard.select("doc_id", "text").collect()]
    got = lm_score.lattice_scores(hard, vocab_path=PIECES).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    tokens = [(i, [*WORD.findall(lower(t or "")), ""]) for i, t in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n = sum(c.values())
    want = [(str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n,
             round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in ws), 4)) for i, ws in tokens]
    assert sorted((str(r[0]), *r[1:5], round(r[5], 4)) for r in got) == sorted(want)
    assert all(r["score"] < 0 for r in got)
    assert lm_score.lattice_scores(nothing, vocab_path=PIECES).count() == 0


def test_licenses(spark, hard, nothing):
    rows = [(1, "text\nLicensed under CC BY-NC 4.0.\nmore"), (2, "Licensed under the Apache License, Version 2.0."), (3, "All rights reserved."),
            (4, "this work is licensed under the GNU General Public License, version 3."), (5, "we need a licence to fish here"), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["confirmed"], r["first_line"]) for r in license_scan.scan_licenses(docs).collect()}
    assert got[1] == ("CC-BY-NC-4.0", True, 1) and got[2] == ("Apache-2.0", True, 0) and got[4] == ("GPL-3.0", True, 0)
    assert not got[3][1] and not got[5][1] and set(got) == {1, 2, 3, 4, 5}
    assert license_scan.scan_licenses(nothing).count() == 0 and license_scan.scan_licenses(hard).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for name, fn in corpus_pipeline.STAGES:
        before = docs
        docs = fn(spark, docs, SF_SMALL).cache()
        assert docs.columns[:5] == before.columns
        assert docs.limit(0).count() == 0 and docs.count() > 0, name
        if name in ("quality classifier", "benchmark decontamination"):
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"}
    assert sorted(map(str, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(str, docs.collect()))


def test_pipeline_on_hard_rows(spark, hard, nothing):
    for table in (hard.drop("shard", "keep_id", "copy", "score"), nothing):
        docs = table
        for _, fn in corpus_pipeline.STAGES:
            docs = fn(spark, docs, SF_SMALL)
        docs.count()


def prose(n, seed=8):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, k)) for k in rng.integers(2, 10, n // 6))[:n]


@pytest.mark.parametrize("n", [1_000, 10_000, 100_000])
def test_license_inside_a_long_line(spark, n):
    text = prose(n)
    cut = text.index(" ", n // 2)
    rows = [(1, text[:cut] + " Released under the MIT License. " + text[cut:]), (2, text[:cut] + " licensed by the é council " + text[cut:]),
            (3, "Licensed under CC BY-NC 4.0. " + text + " Released under the MIT License.")]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["license"], r["confirmed"]) for r in got if r["doc_id"] == 1} == {("MIT", True)}
    assert not any(r["confirmed"] for r in got if r["doc_id"] == 2) and {r["first_line"] for r in got} == {0}
    if n > license_scan.FAR:
        assert [(r["license"], r["confirmed"]) for r in got if r["doc_id"] == 3] == [("CC-BY-NC-4.0", True), ("MIT", True)]
        assert all(len(r["block"]) <= 2 * license_scan.FAR for r in got)


def test_every_license_of_a_block(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
            (2, "Released under the MIT License.\nsome text\nLicensed under CC BY-NC 4.0."),
            (3, prose(2_000) + " Released under the MIT License. Licensed under CC BY 4.0. Released under CC0 1.0. " + prose(3_000, 9)),
            (4, "Released under the MIT License.\n" * 300),
            (5, "This work is licensed under the GNU General Public License, version 2."),
            (6, "This work is licensed under the GNU Lesser General Public License, version 3."),
            (7, "This work is licensed under the GNU General Public License, version 9.")]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sure = defaultdict(list)
    for r in got:
        if r["confirmed"]:
            sure[r["doc_id"]].append(r["license"])
    assert {k: sorted(v) for k, v in sure.items()} == {
        1: ["Apache-2.0", "MIT"], 2: ["CC-BY-NC-4.0", "MIT"], 3: ["CC-BY-4.0", "CC0-1.0", "MIT"], 4: ["MIT"], 5: ["GPL-2.0"], 6: ["LGPL-3.0"]}
    assert [r["license"] for r in got if r["doc_id"] == 7] == ["GPL-3.0"]


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED.  IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""
THIRD = """3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""
ADVERTS = """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement: made by the University.
"""


def test_license_texts_not_taken_from_the_templates(spark):
    cases = [
        ("SPDX-License-Identifier: MIT", ["MIT"]), ("/* SPDX-License-Identifier: BSD-3-Clause */", ["BSD-3-Clause"]),
        ("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]), ("SPDX-License-Identifier: MIT/Apache-2.0", ["Apache-2.0", "MIT"]),
        ("# SPDX-License-Identifier: (GPL-2.0-or-later WITH Linux-syscall-note) OR MIT", ["GPL-2.0", "MIT"]),
        ("SPDX-License-Identifier: EUPL-1.2 or so", []),
        ("\n".join(" * " + x for x in BSD.format(THIRD).split("\n")), ["BSD-3-Clause"]), (BSD.format(""), ["BSD-2-Clause"]),
        (BSD.format(ADVERTS + THIRD), []),  # the four-clause license is none of the templates
        ("This module is free software; you may redistribute it and/or modify it under the terms\nof the GNU Lesser General Public License "
         "as published by\n# the Free Software Foundation; either version 2.1 of the License, or\n# (at your option) any later version.", ["LGPL-2.1"]),
        ("Licensed under either of\n * Apache License, Version 2.0\n * or the MIT license\nat your option.", ["Apache-2.0", "MIT"]),
        ("This text is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
        ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that "
         "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND ACME DISCLAIMS "
         "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL ACME "
         "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
         "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
         "PERFORMANCE OF THIS SOFTWARE.", ["ISC"]),
        ("the GNU GPL applies here, not the MIT license", [])]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    sure = defaultdict(set)
    for r in license_scan.scan_licenses(docs).collect():
        if r["confirmed"]:
            sure[r["doc_id"]].add(r["license"])
    assert [sorted(sure[i]) for i in range(len(cases))] == [want for _, want in cases]
    opening = spark.createDataFrame([(1, "\n".join(BSD.split("\n")[:3]))], "doc_id long, text string")
    assert [(r["license"], r["confirmed"]) for r in license_scan.scan_licenses(opening).collect()] == [("BSD-2-Clause", False)]
    own = license_scan.scan_licenses(docs, templates={"Mine": ("all is licensed to me",)}).where("confirmed").count()
    assert own == 0


def test_fit_takes_a_row_an_id(spark, monkeypatch):
    rows = [(i, f"good words number {i}" if i % 2 else f"bad bad things {i}") for i in range(40)]
    docs = spark.createDataFrame(rows + [(1, f"again {k}") for k in range(300)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    bags = []
    monkeypatch.setattr(quality, "train", lambda ready, **_: bags.append(ready))
    quality.fit(docs, labels)
    known = {r[0] for r in labels.where(~quality.held_out(F.col("doc_id"))).collect()}
    assert 1 in known and len(bags[0]) == len(known)
    half = sum(a.nbytes + b.nbytes for a, b, _ in bags[0]) // 2
    quality.fit(docs, labels, max_bytes=half)
    assert 0 < sum(a.nbytes + b.nbytes for a, b, _ in bags[1]) <= half and len(bags[1]) >= len(known) // 3


def test_shards_spread_rows_alike(spark):
    docs = spark.createDataFrame([(1, "alike")] * 4000 + [(i, "own") for i in range(2000)], "doc_id long, text string").repartition(6)
    out = shard.shard_rows(docs, 4, rows_per_block=200)
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(1500))
        assert 800 < sum(r["text"] == "alike" for r in rows if r["shard"] == s) < 1200
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows))
    seen = []
    real = shard.communication_matrix
    try:
        shard.communication_matrix = lambda blocks, *a: seen.append(max(blocks)) or real(blocks, *a)
        shard.shard_rows(docs, 4, rows_per_block=200)
    finally:
        shard.communication_matrix = real
    assert seen[0] <= 300


def test_fit_brings_packed_features_by_partition(spark, monkeypatch):
    rows = [(i, prose(3_000, i)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    bags, brought = [], []
    monkeypatch.setattr(quality, "train", lambda ready, **_: bags.extend(ready))
    at_once, by_part = type(docs).collect, type(docs).toLocalIterator

    def watched(rows, whole):
        for r in rows:
            data = [x for x in r if isinstance(x, bytes | bytearray)]
            assert not (whole and data)  # texts' features never come in one collect()
            brought.extend(map(len, data))
            yield r
    monkeypatch.setattr(type(docs), "collect", lambda self: list(watched(at_once(self), True)))
    monkeypatch.setattr(type(docs), "toLocalIterator", lambda self: watched(by_part(self), False))
    quality.fit(docs, labels)
    kept = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    assert len(bags) == len(kept) == len(brought) and 3 * sum(brought) < sum(a.nbytes + b.nbytes for a, b, _ in bags)
    for i, (ids, share, label) in zip(kept, bags, strict=True):
        buf = np.frombuffer(rows[i][1].encode(), np.uint8)
        want, n = np.unique(np.concatenate(quality.features(buf, np.array([0, buf.size]))[0]), return_counts=True)
        assert (ids == want).all() and share.tobytes() == (n / n.sum()).astype(np.float32).tobytes() and label == i % 2


def varied(text, rng, others):
    """A notice with words added, left out or changed, on one or many lines."""
    words = text.split()
    for _ in range(int(rng.integers(0, 1 + len(words) // 5))):
        words.insert(int(rng.integers(0, len(words) + 1)), others[int(rng.integers(0, len(others)))])
    for _ in range(int(rng.integers(0, 1 + len(words) // 10))):
        words.pop(int(rng.integers(0, len(words))))
    return (" ", "\n", "\n * ")[int(rng.integers(0, 3))].join(words)


def test_license_is_ranked_by_compression_before_its_words(monkeypatch):
    rng, others = np.random.default_rng(3), prose(20_000).split()
    scanner, known = license_scan.Scanner(license_scan.TEMPLATES), [t for texts in license_scan.TEMPLATES.values() for t in texts]
    compared, rankings = set(), []
    place, ranked = license_scan.Scanner.place, license_scan.Scanner.ranked
    monkeypatch.setattr(license_scan.Scanner, "place", lambda self, k, *a: compared.add(k) or place(self, k, *a))
    monkeypatch.setattr(license_scan.Scanner, "ranked", lambda self, *a: rankings.append(ranked(self, *a)) or rankings[-1])
    texts = [" ".join((" ".join(others[i:i + i % 300]), varied(t, rng, others), varied(known[-i], rng, others), " ".join(others[:i % 50])))
             for i, t in enumerate(known)]
    got = []
    for text in texts:
        compared.clear()
        got.append(scanner.confirmed(text))
        assert compared <= set(rankings[-1]) and len(rankings[-1]) < len(known)
    monkeypatch.setattr(license_scan.Scanner, "ranked", lambda self, *_: list(range(len(self.known))))
    assert got == [scanner.confirmed(text) for text in texts]  # as if the words of every template were compared
    assert sum(map(len, got)) > len(texts)
    assert license_scan.Scanner({}).confirmed("under the MIT License") == license_scan.Scanner({"None": ("--",)}).confirmed("a -- b") == []


def test_license_that_spares_nothing_is_not_confirmed(monkeypatch):
    whole = license_scan.zstandard.ZstdCompressor
    text = "Released under the MIT License."
    assert license_scan.Scanner(license_scan.TEMPLATES).confirmed(text)
    monkeypatch.setattr(license_scan.zstandard, "ZstdCompressor", lambda *a, dict_data=None, **k: whole(*a, **k))
    assert not license_scan.Scanner(license_scan.TEMPLATES).confirmed(text)


def peak_mb(work):
    """MB that ``work`` holds at most; NumPy reports its arrays."""
    gc.collect()
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_scans_hold_little_of_a_batch(spark, monkeypatch):
    texts = pa.array([sentence(random.Random(i), 400) for i in range(2500)])  # some 4 MB, an Arrow batch
    assert texts.nbytes > 3_900_000
    real, scans = F.arrow_udf, []
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: scans.append(f) or real(kind)(f))
    docs = spark.range(1).selectExpr("id doc_id", "'a b' text")
    quality.score(docs, quality.Model(np.random.default_rng(1).random(1 << quality.BITS), 0.5))
    items = spark.range(1).selectExpr("id item_id", "'aaa bbb ccc ddd eee fff ggg. hhh iii' text")
    decontaminate.decontaminate(docs, items)
    score, holds_item = scans
    monkeypatch.setattr(textarrays, "_powers", [])
    powers(1 << 17)  # kept by a worker, whatever it scans
    assert peak_mb(lambda: [*score(iter([texts]))]) < 20
    assert peak_mb(lambda: [*holds_item(iter([texts]))]) < 20
    batch = pa.RecordBatch.from_arrays([texts], names=["body"])
    assert peak_mb(lambda: Counter(h.size for *_, h in jaccard._sized_sets([batch], 5))) < 20
    assert sum(p.size for p in powers(1)) * 8 <= 1 << 23


def test_small_pieces_change_no_score(spark, monkeypatch):
    texts = [sentence(random.Random(i), 30 + i % 50) for i in range(1500)] + ["", "x", sentence(random.Random(7), 60_000), "é ü 中文 ß" * 9]
    assert len(texts[-2]) > 1 << 17
    model = quality.Model(np.random.default_rng(1).normal(size=1 << quality.BITS), 0.5)
    real, scans = F.arrow_udf, []
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: scans.append(f) or real(kind)(f))
    quality.score(spark.range(1).selectExpr("id doc_id", "'a b' text"), model)
    (got,), own = scans[0](iter([pa.array(texts)])), []
    for text in texts:
        kinds, _ = quality.features(*next(pieces(pa.array([text])))[2:])
        found = np.concatenate(kinds)
        own.append(1 / (1 + np.exp(-(model.weight[found].sum() / max(1, found.size) + model.bias))))
    assert np.abs(got.to_numpy() - np.array(own)).max() < 1e-10


def test_driver_tables_start_no_python_workers(spark, monkeypatch):
    made, real = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(data) or real(self, data, *a, **b))
    docs = spark.range(60).selectExpr("id doc_id", "concat('a b c ', id) text")
    items = spark.range(3).selectExpr("id item_id", "concat('w', id, ' bbb ccc ddd eee fff ggg. hhh iii') text")
    assert shard.shard_rows(docs, 4).count() == 60
    assert decontaminate.decontaminate(docs, items).count() == 60
    assert len(made) == 3 and all(isinstance(d, pa.Table) for d in made)
