import tempfile

from pyspark.sql import functions as F

from quaystone.operators import runs
from quaystone.operators.measure import build_contract
from quaystone.plans.cleaning import Cast, CleaningPlan, Impute, Rename
from quaystone.plans.examples import churn_like, churn_like_draft, orders_draft
from quaystone.plans.modeling import ExperimentPlan, FeaturePlan, Variant
from quaystone.sources.tables import read_contracts, read_parquet, write_text
from tests.conftest import SF_MID, SF_SMALL


def test_contracts_table(spark):
    root = tempfile.mkdtemp(prefix="qs-contracts-", dir="/tmp")
    o = read_parquet(spark, f"{SF_SMALL}/orders.parquet")
    c = build_contract(orders_draft(), o, contract_version="2.0.0", run_id="r", created_by="t", dataset_name="orders")
    good = runs.write_contract(spark, c, f"{root}/good")
    write_text(spark, c.to_json()[:40], f"{root}/broken")
    write_text(spark, '{"contract_version": "1"}', f"{root}/invalid")
    got = {r["status"]: r for r in read_contracts(spark, good).collect()} | \
          {r["status"]: r for r in read_contracts(spark, f"{root}/broken").collect()} | \
          {r["status"]: r for r in read_contracts(spark, f"{root}/invalid").collect()}
    assert got["ok"]["dataset_name"] == "orders" and got["ok"]["contract_version"] == "2.0.0"
    assert "invalid_json" in got and "invalid_schema" in got


def test_replay_is_deterministic(spark):
    docs = read_parquet(spark, f"{SF_MID}/documents.parquet")
    labels = read_parquet(spark, f"{SF_MID}/labels.parquet")
    raw = churn_like(docs, labels).withColumnRenamed("n_chars", "NChars") \
        .withColumn("NChars", F.col("NChars").cast("string"))
    plan = CleaningPlan([Rename("NChars", "n_chars", "snake case"), Cast("n_chars", "int64", "count"),
                         Impute("quality", "mode", "none expected")])
    fplan = FeaturePlan(target="toxic", use_features=["lang", "n_chars"], encoders={"lang": "onehot"})
    eplan = ExperimentPlan([Variant("lr", "logistic_regression", {"C": 0.5}),
                            Variant("rf", "random_forest", {"n_estimators": 10, "max_depth": 3})], cv_folds=3)
    from quaystone.plans.cleaning import check_plan
    assert any("no nulls" in e for e in check_plan(plan, raw.columns, {c: 0 for c in raw.columns}))
    plan = CleaningPlan(plan.operations[:2])
    a = runs.replay(raw, plan, churn_like_draft(), fplan, eplan, key="doc_id")
    b = runs.replay(raw.repartition(3), plan, churn_like_draft(), fplan, eplan, key="doc_id")
    assert a.contract_fingerprint == b.contract_fingerprint and a.findings == b.findings == []
    assert a.winner == b.winner and [x[:3] for x in a.cv] == [x[:3] for x in b.cv]
    lr_a = [x for x in a.cv if x[0] == "lr"]
    lr_b = [x for x in b.cv if x[0] == "lr"]
    assert all(abs(x[3] - y[3]) < 1e-9 for x, y in zip(lr_a, lr_b))
    blocked = runs.replay(raw, plan, churn_like_draft(), fplan, eplan, key="doc_id",
                          fault=lambda d: d.withColumn("n_chars", F.col("n_chars") * 100))
    assert blocked.winner is None and ("SCALE_DRIFT_MEDIAN", "ERROR", "n_chars") in blocked.findings


def test_replay_from_the_plan_table(spark):
    import json

    import pytest

    from quaystone.plans.modeling import Ratio
    from quaystone.plans.store import StoredPlanError, plan_document, plan_fingerprint, plans_table, stored_plans
    docs = read_parquet(spark, f"{SF_SMALL}/documents.parquet")
    labels = read_parquet(spark, f"{SF_SMALL}/labels.parquet")
    raw = churn_like(docs, labels).withColumnRenamed("n_chars", "NChars")
    cleaning = CleaningPlan([Rename("NChars", "n_chars", "snake case"), Cast("n_chars", "int64", "count")])
    fplan = FeaturePlan(target="toxic", use_features=["lang", "n_chars"], derived=[Ratio("r", "n_chars", "quality")],
                        transforms={"n_chars": "log1p"}, encoders={"lang": "onehot"}, advisory_overrides={"quality": "é"})
    eplan = ExperimentPlan([Variant("lr", "logistic_regression", {"C": 0.5}),
                            Variant("rf", "random_forest", {"n_estimators": 10, "max_depth": None})], cv_folds=2)
    path = f"{tempfile.mkdtemp(prefix='qs-plans-', dir='/tmp')}/plans"
    for _ in range(2):
        runs.write_plans(spark, "run-1", [cleaning, churn_like_draft(), fplan, eplan], path)
    runs.write_plans(spark, "run-2", [cleaning, churn_like_draft()], path)
    table = spark.read.parquet(path)
    assert table.count() == 6
    again = stored_plans(table, "run-1")
    assert (again["cleaning"], again["contract"], again["feature"], again["experiment"]) == (cleaning, churn_like_draft(), fplan, eplan)
    assert plan_fingerprint(again["feature"]) == plan_fingerprint(fplan)
    gated = runs.replay_stored(raw, path, "run-2", key="doc_id")
    assert gated.findings == [] and gated.winner is None
    full = runs.replay_stored(raw.repartition(3), path, "run-1", key="doc_id")
    assert full.contract_fingerprint == gated.contract_fingerprint and full.winner in ("lr", "rf")
    kind, document = plan_document(eplan)
    changed = json.dumps(json.loads(document) | {"cv_folds": 3})
    rows = plans_table(spark, "x", [eplan]).withColumn("document", F.lit(changed))
    for bad in (rows, plans_table(spark, "x", [eplan, eplan]), plans_table(spark, "x", [eplan]).withColumn("kind", F.lit("odd"))):
        with pytest.raises(StoredPlanError):
            stored_plans(bad, "x")
    with pytest.raises(StoredPlanError):
        runs.replay_stored(raw, path, "run-3", key="doc_id")


def test_three_tables_are_judged_by_one_join(spark):
    from quaystone.operators.gate import run_gate, run_gates
    from quaystone.plans.examples import lineitem_draft
    o, li = (read_parquet(spark, f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem"))
    churn = churn_like(read_parquet(spark, f"{SF_SMALL}/documents.parquet"), read_parquet(spark, f"{SF_SMALL}/labels.parquet"))
    cases = {}
    for name, df, draft, candidate in (("orders", o, orders_draft(), o.withColumn("o_totalprice", F.col("o_totalprice") * 100)),
                                       ("lineitem", li, lineitem_draft(), li.drop("l_tax").withColumn("extra", F.lit(1))),
                                       ("churn", churn, churn_like_draft(), churn.withColumn("lang", F.lit("xx")))):
        contract = build_contract(draft, df, contract_version="1", run_id="r", created_by="t", dataset_name=name)
        cases[name] = (candidate, contract)
    cases["no_table"] = (None, cases["orders"][1])
    cases["no_contract"] = (o, None)
    together = run_gates(cases, run_id="r")
    assert list(together) == list(cases)
    for name, (df, contract) in cases.items():
        alone = run_gate(df, contract, run_id="r")
        assert alone.findings == together[name].findings and alone.checks_run == together[name].checks_run and alone.errors
        values = [None if r.unexpected is None else sorted(map(tuple, r.unexpected.collect())) for r in (alone, together[name])]
        assert values[0] == values[1]
