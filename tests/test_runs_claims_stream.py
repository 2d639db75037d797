import os
import tempfile
import time

from pyspark.sql import functions as F

from quaystone.operators import claims, logs, runs
from quaystone.operators.gate import run_gate
from quaystone.operators.measure import build_contract
from quaystone.plans.examples import orders_draft
from quaystone.sources.tables import read_parquet
from quaystone.streaming import gate_batches
from tests.conftest import SF_SMALL


def _scratch():
    return tempfile.mkdtemp(prefix="qs-test-", dir="/tmp")


def test_claim_checks(spark):
    stats = spark.createDataFrame([("a.mean", 1.0), ("b.median", 2.0)], "stat_key string, value double")
    cl = spark.createDataFrame([("c1", "a.mean"), ("c2", "zz.max")], "claim string, evidence_stat_key string")
    assert [r["claim"] for r in claims.missing_evidence(cl, stats).collect()] == ["c2"]
    exp = spark.createDataFrame([("lr", "cv", "roc_auc", 0.8)], "variant string, split string, metric string, value double")
    mc = spark.createDataFrame([("lr", "cv", "roc_auc", 0.8), ("lr", "cv", "roc_auc", 0.81), ("rf", "cv", "f1", 0.5)],
                               "variant string, split string, metric string, value double")
    assert sorted(r["status"] for r in claims.check_metric_claims(mc, exp).collect()) == ["mismatch", "ok", "unknown"]
    deps = spark.createDataFrame([("one currency",), ("other",)], "dependency string")
    assum = spark.createDataFrame([("one currency",)], "assumption string")
    assert claims.supported_dependencies(deps, assum).count() == 1


def test_gated_publish_and_run_record(spark):
    root = _scratch()
    o = read_parquet(spark, f"{SF_SMALL}/orders.parquet")
    c = build_contract(orders_draft(), o, contract_version="1", run_id="r", created_by="t", dataset_name="o")
    snap = runs.snapshot(o, root, "run-1")
    ok = run_gate(snap, c, run_id="run-1")
    out = runs.gated_publish(snap, ok, f"{root}/published", f"{root}/quarantine")
    assert out.published and ok.passed
    bad = run_gate(snap.withColumn("o_totalprice", F.col("o_totalprice") * 100), c, run_id="run-2")
    out2 = runs.gated_publish(snap, bad, f"{root}/published2", f"{root}/quarantine2")
    assert not out2.published and "SCALE_DRIFT_MEDIAN" in out2.reason
    rec = runs.run_record(spark, run_id="run-2", report=bad, rows=snap.count(), columns=len(snap.columns),
                          modeling_started=False)
    runs.append_run(rec, f"{root}/runs")
    status = runs.run_status(spark.read.parquet(f"{root}/runs")).first()
    assert status["is_fail"] and status["headline"] == "failed: validation_failed" and status["not_started_reason"]
    late = runs.run_status(runs.run_record(spark, run_id="run-3", report=ok, rows=1, columns=1, status="halted_error",
                                           modeling_started=True, failure_category="artifact_missing",
                                           degraded_stages=("plan",))).first()
    assert late["is_fail"] and not late["is_pass"] and late["is_degraded"] and late["not_started_reason"] is None
    only = runs.run_status(runs.run_record(spark, run_id="run-4", report=ok, rows=1, columns=1, validate_only=True)).first()
    assert only["is_pass"] and not only["modeling_started"] and "validation" in only["not_started_reason"]


def test_winner_is_verified(spark):
    import pytest
    e = spark.createDataFrame([("a", "test", "roc_auc", 0.9), ("b", "cv", "roc_auc", 0.8)], "variant string, split string, metric string, value double")
    assert runs.verified_winner(e, "a", "roc_auc") == 0.9
    for bad in (("b", "roc_auc"), ("a", "f1"), (None, "f1"), ("a", None)):
        with pytest.raises(ValueError):
            runs.verified_winner(e, *bad)


def test_log_levels(spark):
    path = os.path.join(_scratch(), "run.log")
    with open(path, "w") as fh:
        fh.write("2026 INFO start\n2026 WARN slow\n2026 INFO after ERROR seen\nplain [ERROR] line\n2026 INFO end\n")
    log = logs.read_log(spark, path)
    counts = {r["level"]: r["lines"] for r in logs.level_counts(log).collect()}
    assert counts == {"INFO": 2, "WARNING": 1, "ERROR": 1, "OTHER": 1}
    assert [r["line"] for r in logs.tail(log, 2).collect()] == ["plain [ERROR] line", "2026 INFO end"]


def test_streaming_gate_routes_batches(spark):
    root = _scratch()
    o = read_parquet(spark, f"{SF_SMALL}/orders.parquet")
    c = build_contract(orders_draft(), o, contract_version="1", run_id="r", created_by="t", dataset_name="o")
    src = f"{root}/src"
    o.write.parquet(src)
    stream = spark.readStream.schema(o.schema).parquet(src)
    q = gate_batches(stream, c, out_root=f"{root}/out", checkpoint=f"{root}/ckpt")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{root}/out/published").count() == o.count()
    time.sleep(0.1)
