"""Every stage of corpus_pipeline.py against a plain version, on the stage's own input."""

from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from quaystone.llm import quality, registry
from quaystone.llm.textarrays import pieces
from tests.conftest import SF_MID, SF_SMALL

from .test_dedup import brute_components


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output rows) of every stage."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, fn in corpus_pipeline.STAGES:
        after = fn(spark, docs, SF_SMALL).cache()
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def by_sql(docs, sql):
    con = duckdb.connect()
    con.register("d", docs.toPandas())
    con.sql("CREATE VIEW documents AS SELECT * FROM d")
    con.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{SF_SMALL}/benchmark.parquet'")
    return con.sql(sql).fetchdf()


def test_quality_stage(spark):
    before = spark.read.parquet(f"{SF_MID}/documents.parquet")
    after = corpus_pipeline.STAGES[0][1](spark, before, SF_MID)
    model = quality.fit(before, spark.read.parquet(f"{SF_MID}/labels.parquet"))
    want = Counter()
    for r in before.collect():  # one text at a time
        (_, _, buf, offs), = pieces(pa.array([r["text"] or ""]))
        values = np.concatenate([model.weight[k] for k in quality.features(buf, offs)[0]])
        p = 1 / (1 + np.exp(-(values.sum() / max(1, values.size) + model.bias)))
        if round(float(p), quality.SCORE_PLACES) >= 0.3:
            want[tuple(r)] += 1
    assert rows(after) == want and 0 < sum(want.values()) < before.count()


def test_near_copies_stage(stages):
    before, after = stages["n-gram Jaccard join"]
    given = before.select("doc_id", "text").collect()
    least = {i: c for i, _, c in brute_components([tuple(r) for r in given])}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(i for i, c in least.items() if i == c)
    assert not rows(after) - rows(before) and len(set(least.values())) < len(given)


def test_benchmark_stage(stages):
    before, after = stages["benchmark decontamination"]
    dirty = set(by_sql(before, registry.OP1_SQL)["doc_id"])
    assert rows(after) == Counter(tuple(r) for r in before.collect() if r["doc_id"] not in dirty)
    assert dirty


def test_mix_stage(stages):
    before, after = stages["mixing sources to target weights"]
    plan = by_sql(before, registry.OP6_SQL)
    worded = plan[plan["size"] > 0]
    copies = dict(zip(worded["doc_id"], worded["taken"] // worded["size"], strict=True))
    got = Counter(r["doc_id"] for r in after.collect())
    assert {i: n for i, n in copies.items() if n} == {i: n for i, n in got.items() if i in copies}
    assert set(rows(after)) <= set(rows(before))


def test_shard_stage(stages):
    before, after = stages["sharding"]
    assert rows(after.select(*before.columns)) == rows(before)
    slots = {}
    for r in after.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert set(slots) == set(range(24)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
