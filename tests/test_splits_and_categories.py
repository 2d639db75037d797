"""Splits that move keys only, and category dictionaries of any size."""

import hashlib
import tempfile

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quaystone.operators import features, splits
from quaystone.operators.features import FeatureBuilder, FeatureBuildError
from quaystone.plans.modeling import FeaturePlan, Ratio


def digest(key, seed=42):
    return "" if key is None else hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def plain_test_rows(rows, fraction=0.2):
    """Per class the first floor(fraction · n + 0.5) (digest, key) places, all rows of the last place included."""
    out, classes = set(), {}
    for key, label in rows:
        classes.setdefault(label, []).append((digest(key), key is not None, key))
    for label, places in classes.items():
        n = int(len(places) * fraction + 0.5)
        if n:
            last = sorted(places)[n - 1]
            out |= {(label, p[2]) for p in places if p <= last}
    return out


@pytest.mark.parametrize("sorted_rows", [20_000, 5, 0])
def test_split_equals_a_sort(spark, sorted_rows):
    """A hot class, tiny ones, rows without label, copies of one key and rows without key."""
    rows = [(i, "hot" if i % 3 else f"c{i % 40}") for i in range(6_000)] + [(i, None) for i in range(7_000, 7_050)]
    rows += [(9_000, "few"), (9_001, "few"), (9_002, "one")] + [(8_888, "copies")] * 30 + [(8_889, "copies"), (None, "copies"), (None, "hot")]
    df = spark.createDataFrame(rows, "k long, y string").repartition(7)
    got = splits.stratified_split(df, "y", "k", sorted_rows=sorted_rows)
    assert got.columns == ["k", "y", "split"] and got.count() == len(rows)
    test = {(r["y"], r["k"]) for r in got.where("split = 'test'").collect()}
    assert test == plain_test_rows(rows)
    for label, n in (("hot", 4_001), (None, 50), ("few", 2), ("one", 1)):
        here = F.col("y").isNull() if label is None else F.col("y") == label
        assert got.where(here & (F.col("split") == "test")).count() == int(n * 0.2 + 0.5)


def test_no_wide_row_is_shuffled_or_written(spark):
    wide = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"), F.repeat(F.lit("w"), 50).alias("wide"))
    path = tempfile.mkdtemp(prefix="qs-split-", dir="/tmp")
    wide.write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    for out in (splits.stratified_split(df, "y", "k"), splits.stratified_folds(df, "y", "k", 4)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" in plan
        assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
        assert out.count() == 20_000
    borders, n_classes = splits.class_borders(df, "y", "k")
    assert n_classes == 3 and borders.columns == ["_b_class", "_b_order", "_b_key"] and borders.count() == 3


def test_more_classes_and_keys_than_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(splits, "BROADCAST_CLASSES", 10)
    monkeypatch.setattr(splits, "BROADCAST_FOLDS", 10)
    rows = [(i, f"c{i % 50}") for i in range(2_000)]
    df = spark.createDataFrame(rows, "k long, y string")
    split = splits.stratified_split(df, "y", "k", sorted_rows=3)
    assert {(r["y"], r["k"]) for r in split.where("split = 'test'").collect()} == plain_test_rows(rows)
    folds = splits.stratified_folds(df, "y", "k", 4)
    assert folds.count() == 2_000
    sizes = {(r["y"], r["fold"]): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    assert set(sizes.values()) == {10}


def test_empty_table(spark):
    none = spark.createDataFrame([], "k long, y string")
    assert splits.stratified_split(none, "y", "k").count() == 0
    assert splits.stratified_folds(none, "y", "k").count() == 0


def test_five_million_categories(spark):
    """More categories than are broadcast: coded in order, none on the driver."""
    n = 5_000_000
    data = spark.range(n + 1).select(F.when(F.col("id") < n, F.format_string("c%07d", F.pmod(F.col("id") * 7, F.lit(n)))).alias("cat"),
                                     F.lit(1).alias("y"))
    plan = FeaturePlan(target="y", use_features=["cat"], encoders={"cat": "ordinal"})
    fitted = FeatureBuilder(plan).fit(data)
    assert fitted.sizes == {"cat": n} and fitted.category_fill == {"cat": "c0000000"}
    out = fitted.transform_columns(data)
    assert "Map" not in out._jdf.queryExecution().optimizedPlan().toString()
    wrong = out.where(F.col("_f_cat") != F.substring("cat", 2, 7).cast("double")).count()
    row = out.agg(F.count(F.lit(1)), F.countDistinct("_f_cat"), F.max("_f_cat")).first()
    assert wrong == 0 and tuple(row) == (n + 1, n, float(n - 1))


@pytest.mark.parametrize("limit", [500_000, 0])
def test_codes_fills_and_unseen_values(spark, monkeypatch, limit):
    monkeypatch.setattr(features, "BROADCAST_CATEGORIES", limit)
    rows = [("b", 10, None), ("a", 9, None), ("b", 100, None), (None, None, None), ("a", 10, None), ("é", 9, None), ("", 2, None)]
    train = spark.createDataFrame(rows, "t string, n int, v string").withColumn("y", F.lit(1))
    plan = FeaturePlan(target="y", use_features=["t", "n", "v"], encoders={"t": "onehot", "n": "ordinal", "v": "onehot"})
    fitted = FeatureBuilder(plan).fit(train)
    # ties go to the smallest value; numbers are ordered as numbers; a column without values has one category
    assert fitted.category_fill == {"t": "a", "n": "9", "v": ""} and fitted.sizes == {"t": 4, "n": 4, "v": 1}
    new = spark.createDataFrame([("a", 100, None), ("zz", 7, "x"), (None, None, None), ("", 2, None)], "t string, n int, v string").withColumn("y", F.lit(1))
    got = [list(r["f"]) for r in fitted.transform(new.coalesce(1)).select(vector_to_array("features").alias("f")).collect()]
    want = [[0, 1, 0, 0, 3, 1], [0, 0, 0, 0, -1, 0], [0, 1, 0, 0, 1, 1], [1, 0, 0, 0, 0, 1]]
    assert sorted(got) == sorted([float(x) for x in w] for w in want)


def test_one_pipeline_is_saved_and_loaded(spark):
    rows = [(i, "ab"[i % 2], float(i % 13) if i % 5 else float("nan"), float(i % 7), int(i % 13 > 6)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, c string, x double, z double, y int")
    plan = FeaturePlan(target="y", use_features=["c", "x"], derived=[Ratio("xz", "x", "z")], transforms={"x": "minmax_scale"},
                       encoders={"c": "onehot"})
    model = Pipeline(stages=[FeatureBuilder(plan), LogisticRegression(labelCol="y", maxIter=20)]).fit(df)
    path = tempfile.mkdtemp(prefix="qs-pipe-", dir="/tmp")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    scores = [m.transform(df).orderBy("k").select(vector_to_array("probability")[1].alias("p")).collect() for m in (model, again)]
    assert scores[0] == scores[1] and len(scores[0]) == 400
    assert all(0 <= r["p"] <= 1 for r in scores[0])  # NaN was filled, not carried on
    assert again.stages[0].plan == plan and again.stages[0].uid == model.stages[0].uid


def test_features_without_a_group(spark):
    df = spark.createDataFrame([("a", 1, 1)], "t string, x int, y int")
    for use in (["t"], ["nowhere"]):
        with pytest.raises(FeatureBuildError):
            FeatureBuilder(FeaturePlan(target="y", use_features=use)).fit(df)
