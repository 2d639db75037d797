import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quaystone.operators.gate import run_gate_paths
from quaystone.operators.measure import build_contract
from quaystone.plans.examples import orders_draft
from quaystone.sources.tables import read_parquet, read_table, write_text
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    ids = {r["check_id"] for r in rows}
    assert "SCALE_DRIFT_MEDIAN" in ids and "INTEGRITY_SHA256_MATCH" in ids
    msg = [r["message"] for r in rows if r["check_id"] == "SCALE_DRIFT_MEDIAN"][0]
    assert "SUSPECTED SCALE CHANGE" in msg


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 30
    # the training-data queries are there exactly if their package is
    assert ("pipeline" in q) == any(k.startswith("op10_") for k in q) == (entry.llm_registry is not None)


def test_csv_scan_tokens_blanks_and_inference(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="qs-csv-", dir="/tmp"), "t.csv")
    with open(path, "w") as fh:
        fh.write("id,total,flag,name\n1,1.5,True,a\n2, ,False,NA\n3,NaN,True, \n4,7,False,None\n")
    df = read_table(spark, path)
    types = dict(df.dtypes)
    assert types["id"] == "bigint" and types["flag"] == "boolean" and types["total"] == "string"
    rows = df.orderBy("id").collect()
    assert rows[1]["name"] is None and rows[2]["name"] == " " and rows[3]["name"] is None
    assert rows[1]["total"] == " " and rows[2]["total"] is None


def test_gate_over_stored_artifacts(spark):
    root = tempfile.mkdtemp(prefix="qs-art-", dir="/tmp")
    o = read_parquet(spark, f"{SF_SMALL}/orders.parquet")
    c = build_contract(orders_draft(), o, contract_version="1", run_id="r", created_by="t", dataset_name="o")
    o.write.parquet(f"{root}/orders")
    write_text(spark, c.to_json(), f"{root}/contract")
    ok = run_gate_paths(spark, f"{root}/orders", f"{root}/contract", run_id="a")
    assert ok.passed, ok.check_ids()
    missing = run_gate_paths(spark, f"{root}/nothing", f"{root}/contract", run_id="b")
    assert missing.check_ids() == ["ARTIFACTS_CSV_FILE_EXISTS"]
    nocontract = run_gate_paths(spark, f"{root}/orders", f"{root}/no-contract", run_id="c")
    assert nocontract.check_ids() == ["ARTIFACTS_CONTRACT_FILE_EXISTS"]
    o.withColumn("o_totalprice", F.col("o_totalprice") * 100).write.parquet(f"{root}/orders_x100")
    bad = run_gate_paths(spark, f"{root}/orders_x100", f"{root}/contract", run_id="d")
    assert "SCALE_DRIFT_MEDIAN" in bad.check_ids()
