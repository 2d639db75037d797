"""Exact dedup, Jaccard join, substring dedup and line chunks against plain Python on a hard table."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaystone.llm import exact, induced, jaccard, line_chunks, suffix_dedup
from quaystone.llm.components import components

SPACE = re.compile("[\x20\x09-\x0d]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.mark.parametrize("max_bits", [1 << 27, 64])
def test_exact_dedup(spark, hard, nothing, max_bits):
    out = exact.exact_dedup(hard, keep=("keep_id", "source"), max_bits=max_bits)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_code_points", "keep_id_src", "source"]
    rows = hard.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(SPACE.sub("", t or "").encode()).hexdigest()].append((-len(t or ""), i is None, i))
    want, kept = [], Counter()
    for sha, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        want += [(m[2], best[2], len(members), sha, -m[0]) for m in members]
        kept[sha] = 1
    got = out.collect()
    assert sorted(((r[0], r[1], r[2], r[4], r[5]) for r in got), key=key) == sorted(want, key=key)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == kept
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    assert exact.exact_dedup(nothing).count() == 0


def brute_sets(rows, k=5):
    out = []
    for i, t in rows:
        w = [x for x in SPACE.split(lower(t or "")) if x]
        out.append((i, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    return out


def brute_components(rows):
    sets = brute_sets(rows)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(x)] = find(y)
    least = defaultdict(list)
    for x, (i, s) in enumerate(sets):
        least[find(x)].append(i)
    return [(i, len(s), i if not s else min((v for v in least[find(x)] if v is not None), default=None)) for x, (i, s) in enumerate(sets)]


def test_jaccard(spark, hard, nothing):
    rows = [tuple(r) for r in hard.select("doc_id", "text").collect()]
    got = [tuple(r) for r in jaccard.jaccard_classes(hard).collect()]
    want = brute_components(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert jaccard.jaccard_classes(nothing).count() == 0
    kept = jaccard.drop_near_copies(hard)
    assert kept.columns == hard.columns
    comp = {i: c for i, _, c in want}
    stays = Counter(r["doc_id"] for r in kept.collect())
    assert all(n == 1 for i, n in stays.items() if i is not None and comp[i] is not None)
    assert {i for i in stays if i is not None} == {i for i, n, c in want if i is not None and (n == 0 or c == i)}


def test_jaccard_chains_and_hot_passage(spark):
    """Chains of copies, one large group around a leader, and a passage in many otherwise different texts."""
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    rows, now = [], word(100)
    for i in range(12):
        rows.append((i, " ".join(now)))
        now = now[4:] + word(4)
    base = word(80)
    for i in range(60):
        at = int(rng.integers(0, 80))
        rows.append((100 + i, " ".join(base[:at] + word(int(rng.integers(1, 3))) + base[at + 1:])))
    hot = word(30)
    for i in range(60):
        rows.append((300 + i, " ".join(word(10) + hot + word(int(rng.integers(0, 4))))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted(tuple(r) for r in jaccard.jaccard_classes(df).collect())
    assert got == sorted(brute_components(rows))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(50, 51), (51, 50)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140)) and got[51] == 50 == got[50]


def brute_repeats(rows, n):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[k:k + n] for b in texts for k in range(len(b) - n + 1))
    out = []
    for (i, _), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k:k + n]] > 1:
                gone[k:k + n] = b"\1" * n
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("options", [{}, {"hot_strands": 1}, {"shard_bytes": 2000, "queue_bytes": 4096}])
def test_suffix_dedup(spark, hard, nothing, options):
    rows = [tuple(r) for r in hard.select("doc_id", "text").collect()]
    got = [(*r[:4], bytes(r[4])) for r in suffix_dedup.remove_repeats(hard, length=40, gram=12, **options).collect()]
    assert sorted(got, key=key) == sorted(brute_repeats(rows, 40), key=key)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_induced_sort_matches_plain_sort():
    rng = np.random.default_rng(1)
    spilled = 0
    for trial in range(150):
        t = rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(0, 60)))
        if trial % 3 == 0 and t.size > 10:
            t = np.tile(t[:5], 8)
        s = [*t.tolist(), 0]
        want = sorted(range(len(s)), key=lambda i: s[i:])
        common = [0]
        for a, b in zip(want, want[1:], strict=False):
            k = 0
            while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            common.append(k)
        order, got, spills = induced.suffix_array(t, 1000, memory=64 if trial % 2 else 1 << 20)
        assert order.tolist() == want and got.tolist() == common
        spilled += spills
    assert spilled > 50


def brute_chunks(rows):
    docs = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        ends = [k for k in range(len(lines)) if k == len(lines) - 1 or k >= 1 and (h[k - 1] * 31 + h[k]) % 4 == 0]
        docs[(i, t or "")] = [("\n".join(lines[a:b + 1]), a, b - a + 1) for a, b in zip([0, *[e + 1 for e in ends[:-1]]], ends, strict=True)]
    first = {}
    for d in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        for body, a, n in docs[d]:
            first.setdefault(body, (d, a)) if n >= 2 else None
    out = {}
    for d, chunks in docs.items():
        left = [c for c in chunks if c[2] < 2 or first[c[0]] == (d, c[1])]
        out[d] = (sum(c[2] for c in chunks), len(chunks), len(chunks) - len(left), sum(c[2] for c in chunks) - sum(c[2] for c in left),
                  "\n".join(c[0] for c in left))
    return [(i, *out[(i, t or "")]) for i, t in rows]


def test_line_chunks(spark, hard, nothing):
    lines = [f"line {i}" for i in range(60)]
    more = [(500, "\n".join(lines)), (501, "\n".join(["new", *lines])), (502, "\n".join(lines[:30] + ["new", "newer"] + lines[30:]))]
    docs = hard.where("doc_id is not null").select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [tuple(r) for r in docs.collect()]
    got = [tuple(r) for r in line_chunks.line_chunk_dedup(docs).collect()]
    assert sorted(got, key=key) == sorted(brute_chunks(rows), key=key)
    assert all(r[4] >= 30 for r in got if r[0] in (501, 502))  # an inserted line moves the boundaries near it only
    assert line_chunks.line_chunk_dedup(hard).count() == hard.count()
    assert line_chunks.line_chunk_dedup(nothing).count() == 0


def test_native_plans_have_no_python(spark, hard):
    from quaystone.llm import shard

    for out in (exact.exact_dedup(hard), line_chunks.line_chunk_dedup(hard), shard.shard_rows(hard)):
        plan = out._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
        assert out.agg(F.count(F.lit(1))).first()[0] == hard.count()


def brute_pairs(rows):
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda d: (d[0] is None, d[0] or 0))
    seen, kept = set(), {}
    for d in docs:
        lines, gone = d[1].split("\n"), set()
        for k in range(len(lines) - 1):
            if tuple(lines[k:k + 2]) in seen:
                gone |= {k, k + 1}
            seen.add(tuple(lines[k:k + 2]))
        kept[d] = len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return [(i, *kept[i, t or ""]) for i, t in rows]


def test_line_pairs_find_short_passages(spark, hard, nothing):
    rows, i = [], 0
    for n in range(2, 9):  # 20 passages of every length, each in two documents between other lines
        for k in range(20):
            passage = [f"passage {n} {k} line {x}" for x in range(n)]
            for _ in range(2):
                rows.append((i, "\n".join([f"own {i} a", f"own {i} b", *passage, f"own {i} c", f"own {i} d"])))
                i += 1
    rows += [(i, "a\na\na\nb"), (i + 1, "b\na\na"), (i + 2, None), (i + 3, "\n\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_chunks.line_chunk_dedup(docs, pairs=True).collect()}
    assert sorted((d, r["n_removed_lines"], r["kept_text"]) for d, r in got.items()) == sorted(brute_pairs(rows))
    at = 0
    for n in range(2, 9):
        for _ in range(20):
            first, second = got[at], got[at + 1]
            assert first["n_removed_lines"] == 0 and (second["n_removed_lines"], second["n_removed_chunks"]) == (n, 1)
            assert second["kept_text"] == "\n".join(f"own {at + 1} {x}" for x in "abcd")
            at += 2
    some = hard.where("doc_id is not null").select("doc_id", "text")
    out = [(r["doc_id"], r["n_removed_lines"], r["kept_text"]) for r in line_chunks.line_chunk_dedup(some, pairs=True).collect()]
    assert sorted(out) == sorted(brute_pairs([tuple(r) for r in some.collect()]))
    assert line_chunks.line_chunk_dedup(nothing, pairs=True).count() == 0
