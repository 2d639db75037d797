"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints ONE JSON line.

  profile_lineitem      column profile + top values + duplicate count
  contract_lineitem     contract measurement (observed facts + fingerprint)
  gate_lineitem_clean   gate of the unchanged table against its contract
  gate_lineitem_x100    gate after a ×100 unit change of l_extendedprice
  calibration_orders    3,000-iteration resampling calibration of o_totalprice
  cv_documents_labels   split + 5-fold CV of 3 variants + winner test (documents ⋈ labels)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quaystone.operators import calibrate, faults, gate, measure, profile  # noqa: E402
from quaystone.operators.train import run_experiments  # noqa: E402
from quaystone.plans.examples import churn_like, lineitem_draft  # noqa: E402
from quaystone.plans.modeling import ExperimentPlan, FeaturePlan, Variant  # noqa: E402
from quaystone.session import checkpoint_dir, get_spark  # noqa: E402
from quaystone.sources.tables import read_parquet  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app_name="quaystone-bench", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    li = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    orders = read_parquet(spark, f"{sf_dir}/orders.parquet")
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    labels = read_parquet(spark, f"{sf_dir}/labels.parquet")
    li.count(), orders.count(), docs.count(), labels.count()  # materialise the balanced scans

    def prof():
        p = profile.profile(li, target="l_linestatus")
        p.columns.collect()
        p.top_values.collect()
        return p.summary.collect()

    timed("profile_lineitem", prof)
    contract = timed("contract_lineitem", lambda: measure.build_contract(
        lineitem_draft(), li, contract_version="1.0.0", run_id="bench", created_by="bench",
        dataset_name="lineitem"))
    clean = timed("gate_lineitem_clean", lambda: gate.run_gate(li, contract, run_id="bench-clean"))
    x100 = timed("gate_lineitem_x100", lambda: gate.run_gate(
        faults.scale_change(li, "l_extendedprice", 100.0), contract, run_id="bench-x100"))
    assert "SCALE_DRIFT_MEDIAN" in x100.check_ids(), x100.check_ids()
    assert "SCALE_DRIFT_MEDIAN" not in clean.check_ids()
    timed("calibration_orders", lambda: calibrate.calibrate(
        orders, "o_totalprice", "o_orderkey",
        rate_expr=(F.col("o_orderstatus") == "F").cast("int")).collect())

    table = churn_like(docs, labels)
    fplan = FeaturePlan(target="toxic", use_features=["lang", "source", "n_chars"],
                        transforms={"n_chars": "log1p"}, encoders={"lang": "onehot", "source": "onehot"})
    eplan = ExperimentPlan(variants=[
        Variant("logistic", "logistic_regression", {"C": 1.0, "max_iter": 1000, "class_weight": "balanced"}),
        Variant("forest", "random_forest", {"n_estimators": 200, "max_depth": 10, "class_weight": "balanced"}),
        Variant("boosting", "gradient_boosting", {"n_estimators": 150, "learning_rate": 0.1, "max_depth": 3}),
    ], cv_folds=5, primary_metric="roc_auc")
    timed("cv_documents_labels", lambda: run_experiments(table, fplan, eplan, "doc_id").experiments.collect())

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
