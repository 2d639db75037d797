import tempfile

import pytest
from pyspark.sql import functions as F

from quaystone.operators.train import load_model, run_experiments, save_model, score
from quaystone.plans.examples import churn_like, churn_like_draft
from quaystone.plans.modeling import ExperimentPlan, FeaturePlan, Ratio, Variant, check_experiment_plan, check_feature_plan
from quaystone.operators.measure import build_contract
from quaystone.sources.tables import read_parquet
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def table(spark):
    docs = read_parquet(spark, f"{SF_MID}/documents.parquet")
    labels = read_parquet(spark, f"{SF_MID}/labels.parquet")
    return churn_like(docs, labels).withColumn("n_lines", (F.col("n_chars") % 17) + 1).checkpoint(eager=True)


def test_plan_rules(table):
    contract = build_contract(churn_like_draft(), table.drop("n_lines"), contract_version="1", run_id="r",
                              created_by="t", dataset_name="c")
    bad = FeaturePlan(target="toxic", use_features=["doc_id", "quality"])
    errs = check_feature_plan(bad, contract)
    assert any("hard-excluded" in e for e in errs) and any("advisory" in e for e in errs)
    assert any("required" in e for e in errs)
    assert check_experiment_plan(ExperimentPlan([Variant("a", "logistic_regression", {"random_state": 1})], 11))


def test_experiments_end_to_end(spark, table):
    fplan = FeaturePlan(target="toxic", use_features=["lang", "source", "n_chars", "n_lines"],
                        derived=[Ratio("chars_per_line", "n_chars", "n_lines")],
                        transforms={"n_chars": "log1p", "n_lines": "minmax_scale"},
                        encoders={"lang": "onehot", "source": "ordinal"})
    eplan = ExperimentPlan([Variant("lr", "logistic_regression", {"C": 1.0, "class_weight": "balanced"}),
                            Variant("rf", "random_forest", {"n_estimators": 20, "max_depth": 4})], cv_folds=3)
    res = run_experiments(table, fplan, eplan, "doc_id")
    exp = res.experiments.collect()
    assert {r["variant"] for r in exp if r["split"] == "cv"} == {"lr", "rf"}
    assert {r["variant"] for r in exp if r["split"] == "test"} == {res.winner}
    oof = res.oof
    assert oof.groupBy("variant").count().collect()[0]["count"] == oof.filter("variant = 'lr'").count()
    # the test rows never appear among the out-of-fold rows
    fitted, model = res.models[res.winner]
    path = tempfile.mkdtemp(prefix="qs-model-", dir="/tmp")
    save_model(spark, fitted, model, path)
    f2, m2 = load_model(spark, path)
    a = score(fitted, model, table, "toxic", "doc_id").orderBy("doc_id").collect()
    b = score(f2, m2, table, "toxic", "doc_id").orderBy("doc_id").collect()
    assert [r["score"] for r in a] == pytest.approx([r["score"] for r in b])


def test_feature_builder_matches_brute_force(spark, table):
    """Exact medians/modes as fills, population-std and min-max scaling of
    the filled columns, one-hot over sorted labels (two encoded columns of
    different cardinality), ordinal for a third — against pandas."""
    import math

    import numpy as np
    from pyspark.ml.functions import vector_to_array

    from quaystone.operators.features import FeatureBuilder

    t = (table.withColumn("n_chars", F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("n_chars")))
         .withColumn("lang", F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("lang")))
         .withColumn("n2", F.col("n_chars") * 1.5)
         .withColumn("n3", (F.col("doc_id") % 13).cast("double"))
         .withColumn("kind", F.concat(F.lit("k"), (F.col("doc_id") % 3).cast("string"))))
    plan = FeaturePlan(target="toxic", use_features=["lang", "source", "kind", "n_chars", "n2", "n3"],
                       transforms={"n_chars": "log1p", "n3": "minmax_scale"},
                       encoders={"lang": "onehot", "source": "onehot", "kind": "ordinal"})
    fitted = FeatureBuilder(plan).fit(t)
    got = {r["doc_id"]: r["v"] for r in
           fitted.transform(t).select("doc_id", vector_to_array("features").alias("v")).collect()}
    pdf = t.select("doc_id", "lang", "source", "kind", "n_chars", "n2", "n3").toPandas()

    def mode(s):
        vc = s.dropna().value_counts()
        return sorted(vc[vc == vc.max()].index)[0]

    filled = {c: pdf[c].astype("float64").fillna(float(np.median(pdf[c].dropna()))) for c in ("n_chars", "n2", "n3")}
    cats = {c: pdf[c].fillna(mode(pdf[c])) for c in ("lang", "source", "kind")}
    labels = {c: sorted(cats[c].unique()) for c in cats}
    mu, sd = filled["n2"].mean(), filled["n2"].std(ddof=0)
    lo, hi = filled["n3"].min(), filled["n3"].max()
    assert len(labels["lang"]) == 4 and len(labels["source"]) > 4
    for i, key in enumerate(pdf["doc_id"]):
        want = []
        for c in ("lang", "source"):
            want += [1.0 if cats[c][i] == v else 0.0 for v in labels[c]]
        want.append(float(labels["kind"].index(cats["kind"][i])))
        want.append(math.log1p(filled["n_chars"][i]))
        want.append((filled["n2"][i] - mu) / sd)
        want.append((filled["n3"][i] - lo) / (hi - lo))
        assert list(got[key]) == pytest.approx(want, rel=1e-9, abs=1e-9), key


def test_onehot_unseen_category_is_all_zeros(spark, table):
    from pyspark.ml.functions import vector_to_array

    from quaystone.operators.features import FeatureBuilder
    plan = FeaturePlan(target="toxic", use_features=["lang", "n_chars"], encoders={"lang": "onehot"})
    fitted = FeatureBuilder(plan).fit(table.filter(F.col("lang") != "fr"))
    rows = (fitted.transform(table).select("lang", vector_to_array("features").alias("v"))
            .dropDuplicates(["lang"]).collect())
    by = {r["lang"]: list(r["v"]) for r in rows}
    assert all(len(v) == 3 + 1 for v in by.values())          # de, en, es + n_chars
    assert by["fr"][:3] == [0.0, 0.0, 0.0]
    assert by["de"][:3] == [1.0, 0.0, 0.0] and by["es"][:3] == [0.0, 0.0, 1.0]
