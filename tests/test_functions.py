import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quaystone.functions.columns import nan_to_null, numeric_or_null, truthy, value_text
from quaystone.functions.fingerprint import table_fingerprint
from quaystone.functions.ordering import prefix_sums, with_row_index
from quaystone.functions.quantiles import exact_quantiles


def _np_quantile(values, p):
    v = np.sort(np.asarray([x for x in values if x is not None and not math.isnan(x)], dtype=float))
    return float(np.quantile(v, p)) if len(v) else None


@pytest.mark.parametrize("max_bracket", [200_000, 50, 3])
def test_exact_quantiles_match_numpy(spark, max_bracket):
    rng = np.random.default_rng(7)
    vals = [float(x) for x in rng.normal(100, 30, 2000).round(2)]
    vals += [55.5] * 1200          # a hot value holding a third of the rows
    vals += [None] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = exact_quantiles(df, ["x"], probs, max_bracket=max_bracket)
    for p in probs:
        assert got[("x", p)] == pytest.approx(_np_quantile(vals, p), rel=1e-12)


def test_exact_quantiles_empty_and_single(spark):
    df = spark.createDataFrame([(None, 4.0)], "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.5])
    assert got[("a", 0.5)] is None and got[("b", 0.5)] == 4.0


def test_median_ignores_nan(spark):
    df = nan_to_null(spark.createDataFrame([(1.0,), (2.5,), (4.0,), (float("nan"),)], "x double"))
    assert exact_quantiles(df, ["x"], [0.5])[("x", 0.5)] == 2.5


def test_row_index_matches_row_number(spark):
    pdf = pd.DataFrame({"k": np.arange(3000), "g": np.arange(3000) % 3, "v": np.random.default_rng(1).random(3000)})
    df = spark.createDataFrame(pdf).repartition(7)
    got = with_row_index(df, ["v", "k"], "i").toPandas().sort_values("k")
    want = pdf.sort_values(["v", "k"]).assign(i=np.arange(3000)).sort_values("k")
    assert (got["i"].values == want["i"].values).all()
    got = with_row_index(df, ["v", "k"], "i", partition_by="g").toPandas().sort_values("k")
    want = pdf.sort_values(["v", "k"]).assign(i=lambda d: d.groupby("g").cumcount()).sort_values("k")
    assert (got["i"].values == want["i"].values).all()


def test_prefix_sums(spark):
    pdf = pd.DataFrame({"s": np.arange(500, dtype=float), "g": np.arange(500) % 2, "x": np.ones(500)})
    df = spark.createDataFrame(pdf).repartition(4)
    got = prefix_sums(df, "s", ["x"], descending=True, partition_by="g").toPandas().sort_values("s")
    want = pdf.sort_values("s", ascending=False).assign(cum_x=lambda d: d.groupby("g")["x"].cumsum()).sort_values("s")
    assert np.allclose(got["cum_x"].values, want["cum_x"].values)


def test_numeric_text_and_truthiness(spark):
    df = spark.createDataFrame([(t,) for t in [None, " ", "", "NA", "1e3", "1d", "abc", " 12.5 "]], "t string")
    rows = df.select(numeric_or_null("t", df.schema["t"].dataType).alias("n"),
                     truthy("t", df.schema["t"].dataType).alias("b")).collect()
    assert [r["n"] for r in rows] == [None, None, None, None, 1000.0, None, None, 12.5]
    assert [r["b"] for r in rows] == [None, True, False, True, True, True, True, True]


def test_value_text_like_python(spark):
    vals = [1.0, 2.5, 10000000.0, 0.1, -3.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(value_text("x", df.schema["x"].dataType)).collect()]
    assert got == [str(v) for v in vals]


def test_fingerprint_layout_insensitive_and_change_sensitive(spark):
    df = spark.range(1000).select((F.col("id") % 17).alias("a"), (F.col("id") * 1.5).alias("b"))
    fp = table_fingerprint(df)
    assert fp == table_fingerprint(df.repartition(3).orderBy(F.desc("b")))
    assert fp != table_fingerprint(df.withColumn("b", F.when(F.col("a") == 3, F.col("b") + 1).otherwise(F.col("b"))))
    assert fp != table_fingerprint(df.withColumnRenamed("b", "c"))
    nulls = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    swapped = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert table_fingerprint(nulls) == table_fingerprint(swapped)
    assert table_fingerprint(nulls) != table_fingerprint(spark.createDataFrame([(None, 1), (None, 1)], "a int, b int"))


def test_quantiles_bring_two_rows_a_rank_to_the_driver(spark, monkeypatch):
    """Missed and too wide brackets are narrowed; only the wanted ranks are collected."""
    import numpy as np

    from quaystone.functions import quantiles
    rng = np.random.default_rng(4)
    data = {"a": rng.normal(size=5000), "b": rng.integers(0, 5, 5000).astype(float), "c": np.full(5000, 7.0)}
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), "a double, b double, c double").repartition(4)
    seen = []
    pick = quantiles._pick
    monkeypatch.setattr(quantiles, "_pick", lambda *a: seen.append(pick(*a)) or seen[-1])
    for kw in ({}, {"max_bracket": 50, "accuracy": 20}, {"accuracy": 2}):
        got = quantiles.exact_quantiles(df, list(data), [0.05, 0.5, 0.999], **kw)
        for (c, p), v in got.items():
            assert abs(v - np.quantile(data[c], p)) < 1e-12
    assert all(len(ranks) <= 2 for found in seen for ranks in found.values())
