"""Binary-classification metrics over a predictions table.

Input: a DataFrame with a 0/1 label column, a score (probability of class 1)
and optional grouping columns (e.g. ``variant``). Threshold 0.5 gives the
predicted label. ROC-AUC is exact with ties (average ranks); PR-AUC is
average precision (step sum Σ ΔR·P), not the trapezoid.

Scores are first grouped (ties collapse, partial aggregation), then running
sums in score order come from ``functions.ordering.prefix_sums`` — range
partitioned, so no single task ever holds all distinct scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.functions.ordering import null_safe_join, prefix_sums

THRESHOLD = 0.5
METRICS = ("roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy")


def _names(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def confusion(pred: DataFrame, label: str = "label", score: str = "score", group_by=None) -> DataFrame:
    """tn, fp, fn, tp and the threshold metrics per group."""
    g = _names(group_by)
    y = F.col(label).cast("int")
    p = (F.col(score) >= F.lit(THRESHOLD)).cast("int")
    agg = pred.groupBy(*g).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    accuracy = F.coalesce(F.try_divide(tp + tn, tp + tn + fp + fn), F.lit(0.0))
    return agg.select(*g, "tn", "fp", "fn", "tp", precision.alias("precision"), recall.alias("recall"),
                      f1.alias("f1"), accuracy.alias("accuracy"))


def _grouped(pred: DataFrame, group_by) -> tuple[DataFrame, list[str], bool]:
    g = _names(group_by)
    if g:
        return pred, g, False
    return pred.withColumn("_qs_all", F.lit(0)), ["_qs_all"], True


def ranking_metrics(pred: DataFrame, label: str = "label", score: str = "score", group_by=None) -> DataFrame:
    """roc_auc and pr_auc (average precision) per group."""
    pred, g, single = _grouped(pred, group_by)
    y = F.col(label).cast("int")
    by_score = pred.groupBy(*g, F.col(score).cast("double").alias("_s")).agg(
        F.count_if(y == 1).cast("double").alias("pos"), F.count_if(y == 0).cast("double").alias("neg"))
    cum = prefix_sums(by_score.withColumn("n", F.col("pos") + F.col("neg")), "_s", ["pos", "neg", "n"],
                      descending=True, partition_by=g)
    # the last running sums are the totals: nothing is grouped again
    totals = cum.groupBy(*g).agg(F.max("cum_pos").alias("_qs_P"), F.max("cum_neg").alias("_qs_N"))
    j = null_safe_join(cum, totals, g)
    # negatives scored strictly below s = N - (negatives scored >= s)
    roc_term = F.col("pos") * (F.col("_qs_N") - F.col("cum_neg") + 0.5 * F.col("neg"))
    ap_term = F.col("pos") * F.col("cum_pos") / F.col("cum_n")
    out = j.groupBy(*g).agg(
        F.try_divide(F.sum(roc_term), F.first("_qs_P") * F.first("_qs_N")).alias("roc_auc"),
        F.try_divide(F.sum(ap_term), F.first("_qs_P")).alias("pr_auc"))
    return out.drop("_qs_all") if single else out


def metrics(pred: DataFrame, label: str = "label", score: str = "score", group_by=None) -> DataFrame:
    """All six metrics plus the confusion cells, one row per group."""
    pred, g, single = _grouped(pred, group_by)
    out = null_safe_join(confusion(pred, label, score, g), ranking_metrics(pred, label, score, g), g)
    return out.drop("_qs_all") if single else out


def metrics_long(wide: DataFrame, id_cols: list[str]) -> DataFrame:
    """(id…, metric, value) from a wide metrics table."""
    return wide.unpivot(id_cols, list(METRICS), "metric", "value")


def select_winner(cv: DataFrame, primary_metric: str, variant_order: list[str]) -> str:
    """Highest primary metric; an exact tie goes to the earliest-declared variant."""
    pos = F.create_map(*[x for i, v in enumerate(variant_order) for x in (F.lit(v), F.lit(i))])
    row = (cv.withColumn("_pos", F.element_at(pos, F.col("variant")))
           .orderBy(F.desc(primary_metric), F.asc("_pos")).limit(1).collect())
    if not row:
        raise ValueError("no variants to choose from")
    return row[0]["variant"]


def comparison_table(metrics_df: DataFrame, winner: str | None = None) -> DataFrame:
    """variant × six metrics as columns, with a winner flag."""
    out = metrics_df.select("variant", *METRICS)
    return out.withColumn("is_winner", F.col("variant") == F.lit(winner) if winner else F.lit(False))


def comparison_from_long(experiments: DataFrame, split: str) -> DataFrame:
    """variant × six metrics as columns from the long experiments table
    (``groupBy(variant).pivot(metric)`` over one split; the pivot values are
    listed, so no extra job discovers them)."""
    return (experiments.filter(F.col("split") == split)
            .groupBy("variant").pivot("metric", list(METRICS)).agg(F.first("value")))


def lookup_metric(experiments: DataFrame, variant: str, split: str, metric: str) -> float:
    """One number from the long experiments table; test metrics exist only
    for the winner."""
    rows = (experiments.filter((F.col("variant") == variant) & (F.col("split") == split)
                               & (F.col("metric") == metric)).select("value").limit(2).collect())
    if not rows:
        raise KeyError(f"no {split} {metric} for variant {variant!r}")
    return float(rows[0]["value"])
