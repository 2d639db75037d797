"""NaN, wide correlation matrices, typed distinct counts, sketches, malformed CSV, sinks written twice, draws."""

import math
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaystone.functions import comoments, sketches
from quaystone.operators import calibrate, clean, eda, runs, stats
from quaystone.operators.gate import run_gate, run_gate_paths
from quaystone.operators.measure import build_contract
from quaystone.plans.cleaning import CleaningPlan, Impute
from quaystone.plans.examples import orders_draft
from quaystone.sources.tables import csv_files, read_counted, read_parquet, read_table, write_text
from tests.conftest import SF_SMALL

NAN = float("nan")


def _scratch():
    return tempfile.mkdtemp(prefix="qs-edge-", dir="/tmp")


def plain_correlations(pdf):
    out = {}
    names = sorted(pdf.columns)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            x, y = pdf[a].to_numpy(float), pdf[b].to_numpy(float)
            both = ~np.isnan(x) & ~np.isnan(y)
            x, y = x[both], y[both]
            if x.size > 1 and np.isfinite(x).all() and np.isfinite(y).all() and np.ptp(x) > 0 and np.ptp(y) > 0:
                out[a, b] = float(np.corrcoef(x - x[0], y - y[0])[0, 1])
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_correlations_of_holed_columns(spark, block):
    """NaN and nulls are missing pair by pair; constants, also where both sides have values, and infinities have none."""
    rng = np.random.default_rng(1)
    n = 500
    k = rng.normal(size=n)
    data = {"a": k, "b": k * 2 + rng.normal(size=n), "far": 1e9 + k * 1e-3, "const": np.full(n, 3.0), "few": rng.normal(size=n)}
    data["b"][::7] = NAN
    data["few"][5:] = NAN
    data["half"] = np.where(np.arange(n) < 250, 5.25, rng.normal(size=n))
    data["first"] = np.where(np.arange(n) < 250, rng.normal(size=n), NAN)  # half is constant where first has values
    data["odd"] = rng.normal(size=n)
    data["odd"][400] = math.inf
    data["late"] = np.where(np.arange(n) > 450, rng.normal(size=n), NAN)  # odd is finite where late has values
    data["one"] = np.where(np.arange(n) == 9, 1.0, NAN)
    import pandas as pd
    pdf = pd.DataFrame(data)
    df = spark.createDataFrame(pdf).repartition(4).withColumn("text", F.lit("x"))
    got = {(r["col_a"], r["col_b"]): r["value"] for r in eda.correlations(df, block=block).collect()}
    want = plain_correlations(pdf)
    assert set(got) == set(want) and ("first", "half") not in got and ("late", "odd") in got
    assert all(got[p] == pytest.approx(want[p], abs=1e-9) for p in want)


def test_two_hundred_columns(spark):
    n = 200
    df = spark.range(2_000).select(*[((F.col("id") * (2 * i + 1) + F.floor(F.col("id") / (i + 2))) % 101).alias(f"c{i:03d}") for i in range(n)])
    pdf = df.toPandas()
    got = {(r["col_a"], r["col_b"]): r["value"] for r in eda.correlations(df).collect()}
    want = np.corrcoef(pdf.to_numpy(float), rowvar=False)
    assert len(got) == n * (n - 1) // 2
    assert all(abs(v - want[int(a[1:]), int(b[1:])]) < 1e-9 for (a, b), v in got.items())
    cells = comoments.accumulate(df, df.columns[:100], df.columns[100:], {c: (50.0, 50.0) for c in df.columns})
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_nan_in_histogram_and_impute(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, NAN, 4.0, 3.0, None, math.inf)], "x double")
    hist = {r["bin"]: r for r in eda.histogram(df, "x", 3).collect()}
    assert [hist[b]["count"] for b in (1, 2, 3)] == [1, 1, 2] and hist[1]["lower"] == 1.0 and hist[3]["upper"] == 4.0
    tame = df.where("x is null or x < 100 or isnan(x)")
    for strategy, want in (("mean", 2.5), ("median", 2.5), ("mode", 1.0), ("constant", 9.0)):
        out = clean.execute_plan(tame, CleaningPlan([Impute("x", strategy, "t", 9.0 if strategy == "constant" else None)]))
        assert sorted(r["x"] for r in out.collect()) == sorted([1.0, 2.0, 3.0, 4.0, want, want]), strategy


def test_typed_distinct_counts_in_one_scan(spark):
    path = _scratch()
    rows = [(i % 7, float(i % 5) if i % 3 else NAN, f"t{i % 4}" if i % 2 else None, i % 2 == 0, None) for i in range(100)]
    spark.createDataFrame(rows + [(1, -0.0, "", None, None)], "i int, d double, t string, b boolean, n long").write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    out = stats.distinct_counts(df, df.columns, {"t", "b"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    got = {r["column"]: r for r in out.collect()}
    assert {c: r["u"] for c, r in got.items()} == {"i": 7, "d": 5, "t": 3, "b": 2}
    assert {v["value"]: v["count"] for v in got["t"]["vals"]} == {"t1": 25, "t3": 25, "": 1} and got["i"]["vals"] == []


def test_decimal_places_by_arithmetic(spark):
    """Against the shortest text of every value, as Python writes it."""
    rng = random.Random(4)
    values = [round(rng.uniform(-1e6, 1e6), p) for p in range(12) for _ in range(150)] + [rng.uniform(0, 1) for _ in range(100)]
    values += [0.1 + 0.2, 1e15 + 0.5, 2.0 ** 53, 1e16, 1e-4, 1e-5, 123456789.123456789, 0.0, -0.0, 4503599627370495.5, 1e22]

    def places(v):
        text = repr(v)
        if "e" in text or "." not in text:
            return None
        return len(text.split(".")[1].rstrip("0"))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    got = {r["i"]: r["p"] for r in df.groupBy("i").agg(stats._decimal_places_expr("x", df.schema["x"].dataType).alias("p")).collect()}
    assert [got[i] for i in range(len(values))] == [places(v) for v in values]


def test_sketches_merge(spark):
    df = spark.range(200_000).select((F.col("id") % 60_000).alias("many"), F.when(F.col("id") % 2 == 0, F.lit(NAN)).otherwise(F.col("id") % 9).alias("few"),
                                     F.lit(None).cast("string").alias("none"))
    path = _scratch()
    for k in range(3):
        sketches.sketch_columns(df.where(F.col("many") % 3 == k)).write.mode("append").parquet(path)
    merged = sketches.merge_sketches(spark.read.parquet(path))
    got = {r["column"]: r for r in sketches.distinct_estimates(merged).collect()}
    assert abs(got["many"]["distinct_estimate"] / 60_000 - 1) < 0.03 and got["many"]["values"] == 200_000
    assert got["few"]["distinct_estimate"] == 9 and got["few"]["values"] == 100_000
    assert got["none"]["distinct_estimate"] == 0 and got["none"]["values"] == 0
    whole = sketches.distinct_estimates(sketches.sketch_columns(df)).where("column = 'many'").first()
    assert whole["distinct_estimate"] == got["many"]["distinct_estimate"]


def _write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)


def test_csv_is_split_unless_a_file_needs_whole_reading(spark):
    root = _scratch()
    _write(f"{root}/plain one.csv", "k,t\n" + "".join(f"{i},\"a, \"\"quoted\"\" text {i}\"\n" for i in range(30_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert csv_files(spark, root)[1] == []
        assert read_table(spark, root, fmt="csv").rdd.getNumPartitions() > 4
        _write(f"{root}/open.csv", "k,t\n70000,\"two\nlines\"\n70001,\n70002,\"  \"\n")
        assert [[os.path.basename(f) for f in part] for part in csv_files(spark, root)] == [["plain one.csv"], ["open.csv"]]
        df = read_table(spark, root, fmt="csv")
        assert df.rdd.getNumPartitions() > 4  # the plain file still is
        assert df.count() == 30_003 and df.where("k >= 70000").orderBy("k").select("t").collect() == [("two\nlines",), (None,), ("  ",)]
        assert dict(df.dtypes) == {"k": "bigint", "t": "string"} and df.where("k = 12").first()["t"] == 'a, "quoted" text 12'
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_malformed_records_are_counted(spark):
    root = _scratch()
    orders = read_parquet(spark, f"{SF_SMALL}/orders.parquet")
    contract = build_contract(orders_draft(), orders, contract_version="1", run_id="r", created_by="t", dataset_name="o")
    write_text(spark, contract.to_json(), f"{root}/contract")
    orders.coalesce(1).write.option("header", True).csv(f"{root}/good.csv")
    report = run_gate_paths(spark, f"{root}/good.csv", f"{root}/contract", run_id="good")
    assert "ARTIFACTS_CSV_LOADS" not in report.check_ids()
    (part,) = [f for f in os.listdir(f"{root}/good.csv") if f.endswith(".csv")]
    with open(f"{root}/good.csv/{part}") as f:
        lines = f.read().splitlines()
    lines[5] += ",surplus"
    lines[9] = lines[9].split(",")[0]
    lines.insert(20, "1,2")
    _write(f"{root}/bad.csv", "\n".join(lines) + "\n")
    bad = run_gate_paths(spark, f"{root}/bad.csv", f"{root}/contract", run_id="bad")
    found = {f.check_id: f for f in bad.findings}
    assert found["ARTIFACTS_CSV_LOADS"].observed_value == 3 and "3 of" in found["ARTIFACTS_CSV_LOADS"].message
    assert "INTEGRITY_SHA256_MATCH" in found and found["SCALE_DRIFT_ROW_COUNT"].observed_value == orders.count() - 2
    assert bad.checks_run == report.checks_run and not bad.passed
    df, seen = read_counted(spark, f"{root}/bad.csv")
    assert df.count() == orders.count() - 2 and seen == {"records": orders.count() + 1, "malformed": 3}


def test_sinks_are_written_twice(spark):
    root = _scratch()
    orders = read_parquet(spark, f"{SF_SMALL}/orders.parquet")
    contract = build_contract(orders_draft(), orders, contract_version="1", run_id="r", created_by="t", dataset_name="o")
    odd = orders.withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit("/"), (F.col("o_orderkey") % 13).cast("string")))
    report = run_gate(odd, contract, run_id="007")
    assert runs.read_findings.__doc__ and report.errors
    for _ in range(2):
        runs.write_findings(spark, report, root)
        runs.append_run(runs.run_record(spark, run_id="007", report=report, rows=1, columns=2), f"{root}/runs")
    runs.append_run(runs.run_record(spark, run_id="8", report=report, rows=1, columns=2), f"{root}/runs")
    assert sorted(r["run_id"] for r in runs.read_runs(spark, f"{root}/runs").collect()) == ["007", "8"]
    values = runs.read_unexpected(spark, root).where("run_id = '007'").collect()
    (finding,) = [f for f in report.findings if f.check_id == "CONSTRAINTS_CLOSED_DOMAIN"]
    assert len(values) == finding.observed_value > 60 and len(finding.observed) == 50
    assert sum(v["count"] for v in values) == orders.count()
    assert runs.read_findings(spark, root).count() == len(report.findings) and runs.read_reports(spark, root).count() == 1
    # a second attempt without findings leaves none of the first
    clean_report = run_gate(orders, contract, run_id="007")
    runs.write_findings(spark, clean_report, root)
    assert runs.read_findings(spark, root).where("run_id = '007'").count() == len(clean_report.findings) < len(report.findings)
    assert runs.read_unexpected(spark, root).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 1_000, (1 << 31) + 12_345])
def test_draws_are_a_permutation(spark, n):
    sizes = [s for s in (1, 6, 999) if s < n] or [1]
    pos = calibrate.draw_positions(spark, n, sizes, 30, 5).toPandas()
    assert pos["pos"].between(0, n - 1).all()
    for (size, _), batch in pos.groupby(["size", "iter"]):
        assert len(batch) == size and (size >= n or batch["pos"].nunique() == size)
    if n == 1_000:
        # every position is drawn about as often, and no two batches are alike
        hits = pos[pos["size"] == 6]["pos"].value_counts()
        assert hits.max() <= 6 and pos[pos["size"] == 999].groupby("iter")["pos"].apply(tuple).nunique() == 30


def test_large_sides_give_the_same(spark, monkeypatch):
    """Beyond their counted bounds, joins shuffle: the results stay."""
    from quaystone.functions import ordering
    from quaystone.operators import profile
    df = spark.range(3_000).select((F.col("id") % 700).alias("a"), (F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    small = [profile.duplicate_row_count(df.select("a", "g")), ordering.with_row_index(df, ["k"], "i", partition_by="g").orderBy("k").collect(),
             sorted(calibrate.calibrate(df, "a", "k", sizes=(20, 5_000), n_iter=10).collect())]
    monkeypatch.setattr(profile, "BROADCAST_REPEATED_HASHES", 0)
    monkeypatch.setattr(ordering, "OFFSETS_BROADCAST_ROWS", 0)
    monkeypatch.setattr(calibrate, "BROADCAST_POPULATION_ROWS", 0)
    assert profile.duplicate_row_count(df.select("a", "g")) == small[0] == 3_000 - 2_100
    assert ordering.with_row_index(df, ["k"], "i", partition_by="g", group_count=3).orderBy("k").collect() == small[1]
    assert sorted(calibrate.calibrate(df, "a", "k", sizes=(20, 5_000), n_iter=10).collect()) == small[2]
