"""Training protocol on Spark ML: stratified hold-out, k-fold out-of-fold
predictions per variant (preprocessing refit inside every fold, once for all variants), winner by
the primary CV metric, one final evaluation of the winner on the hold-out.

Estimator mapping (same family and protocol, not identical numbers):
logistic regression ``C`` → ``regParam = 1/(C·n)`` with no elastic net and no
internal standardisation; ``class_weight="balanced"`` → a weight column
n / (2·n_class); trees map depth/estimators/learning rate/min leaf directly.
The seed is fixed here, never by a plan.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.operators.evaluate import METRICS, metrics, select_winner
from quaystone.operators.features import FeatureBuilder
from quaystone.operators.splits import stratified_folds, stratified_split
from quaystone.plans.modeling import ExperimentPlan, FeaturePlan, Variant
from quaystone.session import checkpoint_dir

SEED = 42
LOGISTIC_TOL = 1e-4
# Concurrent fits submitted by the cross-validation loop.
DEFAULT_PARALLELISM = 8
ROWS_PER_FIT_PARTITION = 200_000
# Relative cost of one fit, used only to order concurrent submissions.
_COST = {"gradient_boosting": 3, "random_forest": 2, "logistic_regression": 1}


def class_counts(df: DataFrame, label: str) -> dict:
    """label → row count (one small aggregate; partial aggregation first)."""
    return {r[label]: int(r["n"]) for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_weights(df: DataFrame, label: str, counts: dict | None = None) -> F.Column:
    """``balanced`` weights n / (k · n_class) as a map lookup on the label."""
    counts = class_counts(df, label) if counts is None else counts
    n = sum(counts.values())
    k = len(counts)
    w = F.create_map(*[x for y, c in counts.items() for x in (F.lit(y), F.lit(n / (k * c)))])
    return F.element_at(w, F.col(label)).cast("double")


def make_estimator(variant: Variant, n_rows: int, weighted: bool):
    p = dict(variant.params)
    common = {"featuresCol": "features", "labelCol": "_y"}
    if weighted:
        common["weightCol"] = "_w"
    if variant.estimator == "logistic_regression":
        c = float(p.get("C", 1.0))
        # tol: the reference estimator's default stopping tolerance (1e-4)
        return LogisticRegression(maxIter=int(p.get("max_iter", 100)), regParam=1.0 / (c * max(n_rows, 1)),
                                  elasticNetParam=0.0, standardization=False, tol=LOGISTIC_TOL, **common)
    if variant.estimator == "random_forest":
        depth = p.get("max_depth")
        return RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)),
                                      maxDepth=int(depth) if depth is not None else 30,
                                      minInstancesPerNode=int(p.get("min_samples_leaf", 1)), seed=SEED, **common)
    if variant.estimator == "gradient_boosting":
        return GBTClassifier(maxIter=int(p.get("n_estimators", 100)), stepSize=float(p.get("learning_rate", 0.1)),
                             maxDepth=int(p.get("max_depth", 3)), seed=SEED, **common)
    raise ValueError(f"unknown estimator {variant.estimator!r}")


@dataclass
class TrainingSide:
    """One training set with its preprocessing fitted and its vectors kept: shared by all variants fitted on it."""
    fitted: object
    vectors: DataFrame           # features, _y
    counts: dict                 # label → rows

    def release(self) -> None:
        self.vectors.unpersist()


def training_side(df_train: DataFrame, fplan: FeaturePlan) -> TrainingSide:
    fitted = FeatureBuilder(fplan).fit(df_train)
    counts = class_counts(df_train, fplan.target)   # also gives the row count
    vectors = fitted.transform(df_train).select("features", F.col(fplan.target).cast("double").alias("_y"))
    want = max(1, -(-sum(counts.values()) // ROWS_PER_FIT_PARTITION))
    if want < vectors.rdd.getNumPartitions():
        vectors = vectors.coalesce(want)
    return TrainingSide(fitted, vectors.persist(StorageLevel.MEMORY_AND_DISK), counts)


def fit_on(side: TrainingSide, variant: Variant):
    weighted = variant.params.get("class_weight") is not None
    rows = side.vectors
    if weighted:
        rows = rows.withColumn("_w", class_weights(rows, "_y", {float(y): n for y, n in side.counts.items() if y is not None}))
    return make_estimator(variant, sum(side.counts.values()), weighted).fit(rows)


def out_of_fold(df_train: DataFrame, fplan: FeaturePlan, variants: list[Variant], key: str, k: int,
                parallelism: int = DEFAULT_PARALLELISM) -> DataFrame:
    """OOF scores: each row scored by the model of the fold that did not see
    it. Preprocessing is fitted once per fold and shared by the variants; the
    fits are independent Spark jobs, submitted from a thread pool (as
    ``CrossValidator(parallelism=…)`` does) so the scheduler can overlap them."""
    sides, models = _fit_all(df_train, None, fplan, variants, k, parallelism)
    try:
        return _oof(df_train, fplan, variants, key, k, sides, models).checkpoint(eager=True)
    finally:
        for side in sides.values():
            side.release()


def _fit_all(train: DataFrame, full: DataFrame | None, fplan: FeaturePlan, variants: list[Variant], k: int, parallelism: int):
    """({fold or None: side}, {(variant, fold or None): model}); None is the full training split, if asked for."""
    sources = {i: train.filter(F.col("fold") != i) for i in range(k)} | ({} if full is None else {None: full})
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        sides = dict(zip(sources, pool.map(lambda t: training_side(t, fplan), sources.values()), strict=True))
        # longest chains of Spark jobs first (boosting runs one job chain per
        # iteration), so they do not start last and set the wall-clock time
        tasks = sorted(((v, i) for v in variants for i in sides), key=lambda t: -_COST.get(t[0].estimator, 1))
        models = list(pool.map(lambda t: fit_on(sides[t[1]], t[0]), tasks))
    return sides, {(v.name, i): m for (v, i), m in zip(tasks, models, strict=True)}


def _oof(train: DataFrame, fplan: FeaturePlan, variants: list[Variant], key: str, k: int, sides: dict, models: dict) -> DataFrame:
    parts = [score(sides[i].fitted, models[(v.name, i)], train.filter(F.col("fold") == i), fplan.target, key)
             .withColumn("fold", F.lit(i)).withColumn("variant", F.lit(v.name)) for v in variants for i in range(k)]
    return reduce(DataFrame.unionByName, parts)


@dataclass
class ExperimentResult:
    winner: str
    cv_metrics: DataFrame        # one row per variant
    test_metrics: DataFrame      # one row (winner)
    experiments: DataFrame       # long: variant, estimator, split, metric, value
    oof: DataFrame
    models: dict


def fit_variant(df_train: DataFrame, fplan: FeaturePlan, variant: Variant):
    """Preprocessing + estimator fitted on the full training split."""
    side = training_side(df_train, fplan)
    try:
        return side.fitted, fit_on(side, variant)
    finally:
        side.release()


def score(fitted, model, df: DataFrame, label: str, key: str) -> DataFrame:
    out = model.transform(fitted.transform(df).withColumn("_y", F.col(label).cast("double")))
    return out.select(key, F.col(label).cast("int").alias("label"),
                      vector_to_array("probability")[1].alias("score"))


def run_experiments(df: DataFrame, fplan: FeaturePlan, eplan: ExperimentPlan, key: str,
                    parallelism: int = 2 * DEFAULT_PARALLELISM) -> ExperimentResult:
    """Split once; out-of-fold predictions for every variant; every variant
    also fitted on the full training split (all of these fits are
    independent and run concurrently); winner by the primary CV metric; the
    hold-out is scored once, by the winner."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    label = fplan.target
    split = stratified_split(df, label, key).checkpoint(eager=True)
    train = stratified_folds(split.filter(F.col("split") == "train").drop("split"), label, key,
                             eplan.cv_folds).checkpoint(eager=True)
    test = split.filter(F.col("split") == "test").drop("split")
    sides, models = _fit_all(train, train.drop("fold"), fplan, eplan.variants, eplan.cv_folds, parallelism)
    try:
        oof = _oof(train, fplan, eplan.variants, key, eplan.cv_folds, sides, models).checkpoint(eager=True)
    finally:
        for side in sides.values():
            side.release()
    fitted_models = {v.name: (sides[None].fitted, models[(v.name, None)]) for v in eplan.variants}
    cv = metrics(oof, group_by="variant").checkpoint(eager=True)
    winner = select_winner(cv, eplan.primary_metric, [v.name for v in eplan.variants])
    fitted, model = fitted_models[winner]
    test_pred = score(fitted, model, test, label, key)
    test_m = metrics(test_pred.withColumn("variant", F.lit(winner)), group_by="variant")
    est = spark.createDataFrame([(v.name, v.estimator) for v in eplan.variants], "variant string, estimator string")
    long_cv = cv.unpivot(["variant"], list(METRICS), "metric", "value").withColumn("split", F.lit("cv"))
    long_test = test_m.unpivot(["variant"], list(METRICS), "metric", "value").withColumn("split", F.lit("test"))
    experiments = long_cv.unionByName(long_test).join(F.broadcast(est), "variant")  # est: one row per variant
    return ExperimentResult(winner=winner, cv_metrics=cv, test_metrics=test_m, experiments=experiments,
                            oof=oof, models=fitted_models)


# ---------------------------------------------------------------------------
# persistence: one PipelineModel, reloadable to the same scores
# ---------------------------------------------------------------------------

def save_model(spark, fitted, model, path: str) -> None:
    """The fitted features and the classifier as one saved ``PipelineModel``."""
    PipelineModel(stages=[fitted, model]).write().overwrite().save(path)


def load_model(spark, path: str):
    """(fitted features, classifier) of a saved model."""
    fitted, model = PipelineModel.load(path).stages
    return fitted, model
