"""Nothing is lost: CSV scan, text of doubles, NULL group keys, position-based faults, plan ranges."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quaystone.functions.columns import value_text
from quaystone.functions.ordering import first_rows, prefix_sums, row_at, with_row_index
from quaystone.operators import evaluate, faults
from quaystone.operators.features import stratified_folds, stratified_split
from quaystone.operators.measure import target_facts
from quaystone.plans.modeling import ExperimentPlan, Variant, check_experiment_plan
from quaystone.sources.tables import read_contract_text, read_table


def _csv(text):
    path = os.path.join(tempfile.mkdtemp(prefix="qs-csv-", dir="/tmp"), "t.csv")
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path


def test_csv_quotes_line_breaks_and_long_numbers(spark):
    path = _csv('id,big,note\n1,99999999999999999999,"two\nlines"\n2,5,"say ""hi"", please"\n3,7,NA\n')
    df = read_table(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "big": "string", "note": "string"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, "99999999999999999999", "two\nlines"), (2, "5", 'say "hi", please'), (3, "7", None)]
    typed = read_table(spark, path, schema="id int, big decimal(20,0), note string")
    assert [r["note"] for r in typed.orderBy("id").collect()][2] is None and typed.schema["id"].dataType.simpleString() == "int"
    with pytest.raises(Exception):
        read_table(spark, path, schema="id int, big int, note string").collect()


def test_contract_text_missing_is_not_an_error_but_several_are(spark):
    root = tempfile.mkdtemp(prefix="qs-doc-", dir="/tmp")
    assert read_contract_text(spark, f"{root}/none") is None
    for n in ("a", "b"):
        with open(f"{root}/{n}.json", "w") as fh:
            fh.write("{}")
    with pytest.raises(ValueError):
        read_contract_text(spark, root)


def test_text_of_doubles_is_pythons(spark):
    values = [0.123456789012, 0.123456789013, 1e16, 1.5e-5, 123456789.125, 1e7, 12345678.9, 0.0001, 0.00012345, -2.5e-7, 3.0, -0.5,
              1.7976931348623157e308, 1234567890123456.0, 0.1, 2.5e20, 0.001, 9999999.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["x"]: r["t"] for r in df.select("x", value_text("x", df.schema["x"].dataType).alias("t")).collect()}
    assert got == {v: repr(v) for v in values}
    facts = target_facts(df, "x", None)
    assert len(facts["class_counts"]) == len(values)


def test_null_group_keys_keep_their_rows(spark):
    rows = [(i, None if i % 10 == 0 else "a" if i % 2 else "b", i % 3 == 0, i / 100) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, g string, y boolean, s double").withColumn("y", F.col("y").cast("int"))
    assert with_row_index(df, ["id"], "k", partition_by="g").count() == 100
    sums = prefix_sums(df, "id", ["s"], partition_by=["g"]).where("g is null").orderBy("id").collect()
    assert len(sums) == 10 and abs(sums[-1]["cum_s"] - 4.5) < 1e-9
    split = stratified_split(df, "g", "id")
    assert split.count() == 100 and split.where("g is null and split = 'test'").count() == 2
    assert stratified_folds(df, "g", "id").where("g is null").select("fold").distinct().count() == 5
    both = evaluate.metrics(df, "y", "s", group_by="g")
    assert both.count() == evaluate.confusion(df, "y", "s", "g").count() == 3


def test_positions_are_found_on_key_columns(spark):
    df = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 100).alias("wide")).repartition(4)
    assert row_at(df, 50, ["k"]) is None
    assert sorted(r["k"] for r in first_rows(df, 3, ["k"]).collect()) == [0, 1, 2]
    assert first_rows(df, 99, ["k"]).count() == 50 and first_rows(df, 0, ["k"]).count() == 0
    plan = first_rows(df, 3, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    for wrong in (lambda: faults.inject_nulls(df, "wide", 51, ["k"]), lambda: faults.unknown_category(df, "wide", "z", ["k"], 50)):
        with pytest.raises(faults.FaultInjectionError):
            wrong()
    flipped = faults.flip_target_encoding(spark.createDataFrame([(0.0,), (1.0,), (None,)], "y double"), "y")
    assert [r["y"] for r in flipped.collect()] == [1.0, 0.0, None]


def test_plan_ranges():
    ok = [Variant("f", "random_forest", {"class_weight": "balanced_subsample", "max_depth": 30}), Variant("l", "logistic_regression", {"C": 100})]
    assert check_experiment_plan(ExperimentPlan(ok)) == []
    for params in ({"n_estimators": 5_000_000}, {"max_depth": 60}, {"max_depth": True}, {"class_weight": "odd"}, {"n_jobs": 2}):
        assert check_experiment_plan(ExperimentPlan([ok[1], Variant("f", "random_forest", params)]))
    for params in ({"learning_rate": -3.0}, {"learning_rate": 2}, {"max_depth": 11}):
        assert check_experiment_plan(ExperimentPlan([ok[1], Variant("g", "gradient_boosting", params)]))
    assert check_experiment_plan(ExperimentPlan([ok[0], Variant("l", "logistic_regression", {"C": 0})]))
