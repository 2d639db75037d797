"""Profile, cleaning, EDA, metrics, calibration, splits — differential checks
against direct pandas/NumPy results on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quaystone.operators import calibrate, clean, eda, evaluate, profile
from quaystone.operators.clean import CleaningExecutionError
from quaystone.operators.features import stratified_folds, stratified_split
from quaystone.plans.cleaning import (
    Cast,
    CleaningPlan,
    Clip,
    DropDuplicates,
    Impute,
    Rename,
    StandardizeCategory,
    check_plan,
)


def test_profile_blank_top_values_duplicates(spark):
    rows = [("a", 1.0, True), (" ", 2.0, False), ("a", 1.0, True), (None, None, None), ("b", 4.0, True),
            ("a", 1.0, True)]
    df = spark.createDataFrame(rows, "s string, x double, b boolean")
    p = profile.profile(df)
    cols = {r["column"]: r for r in p.columns.collect()}
    assert cols["s"]["blank_string_count"] == 1 and cols["s"]["null_count"] == 1
    assert cols["x"]["median"] == 1.0 and cols["x"]["unique_count"] == 3 and cols["x"]["is_numeric"]
    assert not cols["b"]["is_numeric"] and cols["b"]["unique_count"] == 2
    top = {(r["column"], r["value"]): (r["count"], r["rank"]) for r in p.top_values.collect()}
    assert top[("s", "a")] == (3, 1) and top[("b", "True")] == (4, 1)
    assert p.summary.first()["duplicate_row_count"] == 2


def test_cleaning_plan_executes_in_order(spark):
    df = spark.createDataFrame([("1", "Yes", 5), (" ", "No", 50), ("3.5", "Yes", None), (None, "No", 7)],
                               "TotalCharges string, Churn string, n int")
    plan = CleaningPlan([
        Rename("TotalCharges", "total", "snake case"),
        Cast("total", "float64", "text number"),
        Impute("total", "median", "blank placeholders"),
        StandardizeCategory("Churn", {"Yes": "1", "No": "0"}, "binary label"),
        Cast("Churn", "int64", "label type"),
        Clip("n", "cap", max=10),
    ])
    assert check_plan(plan, df.columns, {"TotalCharges": 1, "Churn": 0, "n": 1}) == []
    out = clean.execute_plan(df, plan).toPandas()
    assert list(out["total"]) == [1.0, 2.25, 3.5, 2.25]
    assert list(out["Churn"]) == [1, 0, 1, 0]
    assert out["n"].tolist()[:2] == [5, 10] and pd.isna(out["n"].tolist()[2])


def test_cleaning_execution_errors(spark):
    df = spark.createDataFrame([("1",), (None,), ("x",)], "a string")
    with pytest.raises(CleaningExecutionError):
        clean.cast(df, "a", "int64")
    with pytest.raises(CleaningExecutionError):
        clean.standardize_category(df, "a", {"1": "one"})
    with pytest.raises(CleaningExecutionError):
        clean.impute(spark.createDataFrame([(None,)], "a string"), "a", "mode")


def test_plan_rules(spark):
    plan = CleaningPlan([Impute("a", "median", "x"), Rename("a", "b", ""), Rename("zz", "c", "r")])
    errs = check_plan(plan, ["a", "b"], {"a": 0, "b": 0})
    assert any("no nulls" in e for e in errs) and any("reason" in e for e in errs)
    assert any("does not exist" in e for e in errs)


def test_mode_smallest_on_ties_and_drop_duplicates(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "a"), (5, None)], "k int, v string")
    assert clean.mode_value(df, "v") == "a"
    kept = clean.drop_duplicates(df, ["v"], order_by="k").orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in kept] == [(1, "b"), (2, "a"), (5, None)]
    assert clean.execute_plan(df.unionByName(df), CleaningPlan([DropDuplicates("exact copies")])).count() == 5


def test_eda_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.normal(size=200), "y": rng.normal(size=200), "c": rng.choice(list("abc"), 200),
                        "t": rng.integers(0, 2, 200)})
    df = spark.createDataFrame(pdf)
    stats = {r["stat_key"]: r["value"] for r in eda.eda_stats(df, target="t").collect()}
    assert stats["x.median"] == pytest.approx(pdf.x.median())
    assert stats["x.std"] == pytest.approx(pdf.x.std())
    assert stats["t.positive_rate"] == pytest.approx(pdf.t.mean())
    for cat, rate in pdf.groupby("c").t.mean().items():
        assert stats[f"c.target_rate_by_category.{cat}"] == pytest.approx(rate)
    corr = {r["pair"]: r["value"] for r in eda.correlations(df).collect()}
    assert corr["x__vs__y"] == pytest.approx(pdf.x.corr(pdf.y))
    hist = eda.histogram(df, "x").orderBy("bin").toPandas()
    counts, _ = np.histogram(pdf.x, bins=30)
    assert hist["count"].tolist() == counts.tolist()


def test_metrics_fixture_vectors(spark):
    df = spark.createDataFrame(list(zip([0, 1, 1, 0, 1], [.1, .8, .6, .3, .9])), "label int, score double")
    m = evaluate.metrics(df).first()
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (2, 0, 0, 3)
    assert m["roc_auc"] == pytest.approx(1.0) and m["accuracy"] == pytest.approx(1.0)
    ties = spark.createDataFrame(list(zip([0, 1, 0, 1, 0], [.1, .4, .35, .8, .4])), "label int, score double")
    m = evaluate.metrics(ties).first()
    assert m["roc_auc"] == pytest.approx(0.916667, abs=1e-6)
    assert m["pr_auc"] == pytest.approx(0.833333, abs=1e-6)


def test_winner_tie_goes_to_earliest(spark):
    cv = spark.createDataFrame([("b", 0.8), ("a", 0.8), ("c", 0.7)], "variant string, roc_auc double")
    assert evaluate.select_winner(cv, "roc_auc", ["a", "b", "c"]) == "a"
    assert evaluate.select_winner(cv, "roc_auc", ["b", "a", "c"]) == "b"


def test_calibration_brute_force(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": np.arange(400), "v": rng.normal(50, 10, 400).round(2), "r": rng.integers(0, 2, 400)})
    df = spark.createDataFrame(pdf)
    out = calibrate.calibrate(df, "v", "k", rate_expr=F.col("r"), sizes=(30, 400, 500), n_iter=40, seed=9)
    got = {(r["statistic"], r["batch_n"]): r for r in out.collect()}
    pos = calibrate.draw_positions(spark, 400, (30, 400, 500), 40, 9).toPandas()
    pop_med, pop_rate = pdf.v.median(), pdf.r.mean()
    for size, grp in pos.groupby("size"):
        per = grp.groupby("iter")["pos"].apply(list)
        assert all(len(p) == size for p in per)
        if size < 400:
            assert all(len(set(p)) == size for p in per)
        med = np.array([np.median(pdf.v.values[p]) for p in per])
        dev = np.abs(med - pop_med) / pop_med * 100
        row = got[("median_dev_pct", size)]
        assert row["p95"] == pytest.approx(np.percentile(dev, 95)) and row["max"] == pytest.approx(dev.max())
        rate = np.array([pdf.r.values[p].mean() for p in per])
        assert got[("rate_dev_pp", size)]["p50"] == pytest.approx(np.percentile(np.abs(rate - pop_rate) * 100, 50))


def test_splits_are_stratified_and_stable(spark):
    pdf = pd.DataFrame({"k": np.arange(1000), "y": (np.arange(1000) % 4 == 0).astype(int)})
    df = spark.createDataFrame(pdf)
    s1 = stratified_split(df, "y", "k").toPandas().sort_values("k")
    s2 = stratified_split(df.repartition(5), "y", "k").toPandas().sort_values("k")
    assert (s1.split.values == s2.split.values).all()
    test = s1[s1.split == "test"]
    assert len(test[test.y == 1]) == 50 and len(test[test.y == 0]) == 150
    folds = stratified_folds(df.join(spark.createDataFrame(s1[s1.split == "train"][["k"]]), "k"), "y", "k", 5).toPandas()
    counts = folds.groupby(["fold", "y"]).size().unstack()
    assert counts.max().max() - counts.min().min() <= 1 + 120 - 120 or (counts[1].max() - counts[1].min() <= 1)


def test_target_facts_match_separate_measures(spark):
    from quaystone.operators.measure import measure_positive_rate, target_class_counts, target_facts
    num = spark.createDataFrame([(1,), (0,), (1,), (None,), (2,), (2,)], "y int")
    txt = spark.createDataFrame([("no",), ("yes",), (None,), ("yes",)], "y string")
    for df, dom in ((num, None), (txt, ["no", "yes"])):
        facts = target_facts(df, "y", dom)
        rate = facts["positive_rate"]
        assert facts["class_counts"] == {r["value"]: r["count"] for r in target_class_counts(df, "y").collect()}
        assert rate == pytest.approx(measure_positive_rate(df, "y", dom))
    assert target_facts(num, "y", None)["positive_rate"] == pytest.approx(2 / 6)
    assert target_facts(txt, "y", ["no", "yes"]) == {"class_counts": {"no": 1, "yes": 2, "null": 1}, "positive_rate": 0.5}


def test_profile_target_distribution_matches_grouped_counts(spark):
    from quaystone.operators.measure import target_class_counts
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", None), ("null", 5)], "t string, u int")
    for target in ("t", "u"):
        p = profile.profile(df, target=target)
        got = {r["value"]: r["count"] for r in p.target_distribution.collect()}
        want = {r["value"]: r["count"] for r in target_class_counts(df, target).collect()}
        assert got == want, target
