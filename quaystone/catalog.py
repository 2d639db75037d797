"""Registered queries over the bundled tables, and their DuckDB oracles.

Every query reads the given tables (or data Spark derives from them) whole.
Doubles are rounded to 6 places and counts are bigint on both sides, so the
value hashes compare exactly. Queries without an oracle are checked against
brute force in ``tests/``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone import catalog_edge
from quaystone.functions.fingerprint import md5_buckets
from quaystone.operators import calibrate, clean, eda, evaluate, faults, gate, measure, profile
from quaystone.operators.splits import stratified_folds, stratified_split
from quaystone.plans.cleaning import Cast, CleaningPlan, Clip, DropColumn, Impute, Rename, StandardizeCategory
from quaystone.plans.examples import churn_like, churn_like_draft, lineitem_draft, orders_draft
from quaystone.session import checkpoint_dir
from quaystone.sources.tables import read_parquet, read_table, write_table


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet")


def _r(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def _rounded(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places."""
    return df.select(*[_r(f.name).alias(f.name) if f.dataType.simpleString() in ("double", "float")
                       else F.col(f.name) for f in df.schema.fields])


def _churn(spark, sf):
    return churn_like(_t(spark, sf, "documents"), _t(spark, sf, "labels"))


def _contract(draft, df, name):
    return measure.build_contract(draft, df, contract_version="1.0.0", run_id="catalog", created_by="catalog",
                                  dataset_name=name, created_at="2026-01-01T00:00:00Z")


def _findings(report, spark) -> DataFrame:
    return _rounded(report.findings_df(spark).select(
        "check_id", "check_family", "severity", "column", F.col("observed_value").cast("double").alias("observed_value")))


# ---------------------------------------------------------------------------
# profile
# ---------------------------------------------------------------------------

def q_pro_columns_lineitem(spark, sf):
    cols, _ = profile.profile_columns(_t(spark, sf, "lineitem"))
    return _rounded(cols.select("column", "is_numeric", "null_count", "non_null_count", "unique_count",
                                "blank_string_count", "min", "max", "mean", "median"))


def q_pro_top_values_orders(spark, sf):
    o = _t(spark, sf, "orders")
    _, facts = profile.profile_columns(o)
    return profile.top_values(o, facts).select("column", "value", F.col("count").cast("bigint"), F.col("rank").cast("bigint"))


def q_pro_summary_documents(spark, sf):
    d = _t(spark, sf, "documents").select("text", "lang", "source", "n_chars")
    return profile.profile(d, target="lang").summary.select(
        F.col("row_count").cast("bigint"), F.col("column_count").cast("bigint"),
        F.col("duplicate_row_count").cast("bigint"))


def q_pro_target_distribution_labels(spark, sf):
    return measure.target_class_counts(_t(spark, sf, "labels"), "toxic").select("value", F.col("count").cast("bigint"))


def q_pro_preview_orders(spark, sf):
    return _rounded(profile.preview(_t(spark, sf, "orders"), "o_orderkey", 20))


def q_flt_low_cardinality_lineitem(spark, sf):
    cols, _ = profile.profile_columns(_t(spark, sf, "lineitem"))
    return profile.low_cardinality_columns(cols, target="l_linestatus").select(
        "column", F.col("position").cast("bigint"), F.col("unique_count").cast("bigint"))


def q_flt_widest_spread_lineitem(spark, sf):
    cols, _ = profile.profile_columns(_t(spark, sf, "lineitem"))
    return _rounded(profile.widest_spread_column(cols, target="l_linestatus"))


# ---------------------------------------------------------------------------
# EDA
# ---------------------------------------------------------------------------

def q_eda_stats_churn(spark, sf):
    return _rounded(eda.eda_stats(_churn(spark, sf), target="toxic"))


def q_eda_correlations_lineitem(spark, sf):
    return _rounded(eda.correlations(_t(spark, sf, "lineitem")))


def q_eda_histogram_orders(spark, sf):
    return _rounded(eda.histogram(_t(spark, sf, "orders"), "o_totalprice")).select(
        F.col("bin").cast("bigint"), "lower", "upper", "count")


def q_eda_target_rate_lang(spark, sf):
    return _rounded(eda.target_rate_series(_churn(spark, sf), "lang", "toxic"))


# ---------------------------------------------------------------------------
# contract measurement
# ---------------------------------------------------------------------------

def q_con_observed_lineitem(spark, sf):
    c = _contract(lineitem_draft(), _t(spark, sf, "lineitem"), "lineitem")
    return _rounded(measure.observed_table(c, spark).drop("dtype")
                    .withColumn("decimal_places_max", F.col("decimal_places_max").cast("double")))


def q_con_value_distribution_lineitem(spark, sf):
    c = _contract(lineitem_draft(), _t(spark, sf, "lineitem"), "lineitem")
    rows = [(col.name, k, v) for col in c.columns for k, v in (col.observed.value_distribution or {}).items()]
    return _rounded(spark.createDataFrame(rows, "column string, value string, share double"))


def q_con_target_lineitem(spark, sf):
    li = _t(spark, sf, "lineitem")
    rate = measure.measure_positive_rate(li, "l_linestatus", ["F", "O"])
    return _rounded(measure.target_class_counts(li, "l_linestatus")
                    .select("value", F.col("count").cast("bigint"), F.lit(rate).alias("positive_rate")))


def q_con_md5_buckets_orders(spark, sf):
    return md5_buckets(_t(spark, sf, "orders"))


# ---------------------------------------------------------------------------
# gate
# ---------------------------------------------------------------------------

def q_gate_lineitem_scale_x100(spark, sf):
    li = _t(spark, sf, "lineitem")
    c = _contract(lineitem_draft(), li, "lineitem")
    rep = gate.run_gate(faults.scale_change(li, "l_extendedprice", 100.0), c, run_id="x100", fault_injection="scale_change")
    return _findings(rep, spark)


def q_gate_orders_scale_x1_10(spark, sf):
    o = _t(spark, sf, "orders")
    c = _contract(orders_draft(), o, "orders")
    rep = gate.run_gate(faults.scale_change(o, "o_totalprice", 1.10), c, run_id="x1.10")
    return _findings(rep, spark)


def q_gate_churn_flip_target(spark, sf):
    t = _churn(spark, sf)
    c = _contract(churn_like_draft(), t, "churn")
    return _findings(gate.run_gate(faults.flip_target_encoding(t, "toxic"), c, run_id="flip"), spark)


def q_gate_churn_inject_nulls(spark, sf):
    t = _churn(spark, sf)
    c = _contract(churn_like_draft(), t, "churn")
    return _findings(gate.run_gate(faults.inject_nulls(t, "n_chars", 25, "doc_id"), c, run_id="nulls"), spark)


def q_gate_churn_unknown_category(spark, sf):
    t = _churn(spark, sf)
    c = _contract(churn_like_draft(), t, "churn")
    return _findings(gate.run_gate(faults.unknown_category(t, "lang", "xx", "doc_id", 0), c, run_id="cat"), spark)


def q_gate_churn_truncate(spark, sf):
    t = _churn(spark, sf)
    c = _contract(churn_like_draft(), t, "churn")
    return _findings(gate.run_gate(faults.truncate_dataset(t, 19, "doc_id"), c, run_id="trunc"), spark)


def q_gate_orders_rename(spark, sf):
    o = _t(spark, sf, "orders")
    c = _contract(orders_draft(), o, "orders")
    return _findings(gate.run_gate(faults.rename_column(o, "o_totalprice", "o_total_price"), c, run_id="rename"), spark)


# ---------------------------------------------------------------------------
# fault injectors
# ---------------------------------------------------------------------------

def q_flt_inject_nulls_orders(spark, sf):
    return _rounded(faults.inject_nulls(_t(spark, sf, "orders"), "o_totalprice", 100, "o_orderkey"))


def q_flt_truncate_orders(spark, sf):
    return _rounded(faults.truncate_dataset(_t(spark, sf, "orders"), 19, "o_orderkey"))


def q_flt_unknown_category_orders(spark, sf):
    return _rounded(faults.unknown_category(_t(spark, sf, "orders"), "o_orderstatus", "X", "o_orderkey", 0))


# ---------------------------------------------------------------------------
# cleaning
# ---------------------------------------------------------------------------

def dirty_orders(spark, sf) -> DataFrame:
    """orders with a text price (' ' when key % 11 = 0, NULL when key % 7 = 0)
    and the status spelled out — every row kept."""
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    price = (F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 11 == 0, F.lit(" "))
             .otherwise(F.col("o_totalprice").cast("string")))
    return o.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), price.alias("TotalPrice"),
                    "o_orderdate", "o_orderpriority")


DIRTY_PLAN = CleaningPlan([
    Rename("TotalPrice", "total_price", "snake case"),
    Cast("total_price", "float64", "price arrives as text"),
    Impute("total_price", "median", "blank and missing prices"),
    Clip("total_price", "prices are capped for the report", min=2000.0, max=450000.0),
    StandardizeCategory("status", {"F": "finished", "O": "open", "P": "partial"}, "readable states"),
    DropColumn("o_orderdate", "not used downstream"),
])


def q_cln_dirty_orders(spark, sf):
    return _rounded(clean.execute_plan(dirty_orders(spark, sf), DIRTY_PLAN))


def q_cln_mode_impute_orders(spark, sf):
    d = dirty_orders(spark, sf).withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 13 == 0, F.lit(None))
                                          .otherwise(F.col("o_orderpriority")))
    plan = CleaningPlan([Impute("o_orderpriority", "mode", "fill missing priority"),
                         Cast("o_custkey", "str", "key as text")])
    return clean.execute_plan(d, plan).select("o_orderkey", "o_custkey", "o_orderpriority")


def q_cln_drop_duplicates_documents(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text", "lang")
    return clean.drop_duplicates(d, subset=["text"], order_by="doc_id").select("doc_id", "lang")


# ---------------------------------------------------------------------------
# calibration
# ---------------------------------------------------------------------------

def q_cal_incident_orders(spark, sf):
    return _rounded(calibrate.incident_deviations(_t(spark, sf, "orders"), "o_totalprice").select(
        F.col("factor").cast("bigint"), "median_dev_pct"))


# ---------------------------------------------------------------------------
# splits and metrics
# ---------------------------------------------------------------------------

def q_spl_split_churn(spark, sf):
    return stratified_split(_churn(spark, sf), "toxic", "doc_id").select("doc_id", "toxic", "split")


def q_spl_folds_churn(spark, sf):
    s = stratified_split(_churn(spark, sf), "toxic", "doc_id")
    tr = s.filter(F.col("split") == "train").drop("split")
    return stratified_folds(tr, "toxic", "doc_id", 5).select("doc_id", "toxic", F.col("fold").cast("bigint"))


def _scored(spark, sf):
    t = _churn(spark, sf)
    return t.select("doc_id", "lang", F.col("toxic").alias("label"),
                    ((F.col("n_chars") % 997) / F.lit(997.0)).alias("score"))


def q_evl_metrics_scores(spark, sf):
    m = evaluate.metrics(_scored(spark, sf))
    return _rounded(m.select(*[F.col(c).cast("bigint") for c in ("tn", "fp", "fn", "tp")],
                             *evaluate.METRICS))


def q_evl_metrics_by_lang(spark, sf):
    m = evaluate.metrics(_scored(spark, sf), group_by="lang")
    return _rounded(m.select("lang", *[F.col(c).cast("bigint") for c in ("tn", "fp", "fn", "tp")],
                             *evaluate.METRICS))


def q_gate_report_lineitem_x100(spark, sf):
    li = _t(spark, sf, "lineitem")
    c = _contract(lineitem_draft(), li, "lineitem")
    rep = gate.run_gate(faults.scale_change(li, "l_extendedprice", 100.0), c, run_id="x100")
    return rep.report_df(spark).select("passed", "errors", "warnings")


def q_gate_families_lineitem_x100(spark, sf):
    li = _t(spark, sf, "lineitem")
    c = _contract(lineitem_draft(), li, "lineitem")
    rep = gate.run_gate(faults.scale_change(li, "l_extendedprice", 100.0), c, run_id="x100")
    return gate.findings_per_family(rep.findings_df(spark)).select("check_family", F.col("findings").cast("bigint"))


def q_evl_winner_by_lang(spark, sf):
    m = evaluate.metrics(_scored(spark, sf), group_by="lang").withColumnRenamed("lang", "variant")
    winner = evaluate.select_winner(m, "roc_auc", ["de", "en", "es", "fr"])
    return _rounded(evaluate.comparison_table(m, winner))


def q_fea_transforms_churn(spark, sf):
    from quaystone.operators.features import FeatureBuilder
    from quaystone.plans.modeling import FeaturePlan, Ratio
    t = _churn(spark, sf)
    plan = FeaturePlan(target="toxic", use_features=["n_chars", "quality", "lang"],
                       derived=[Ratio("chars_per_quality", "n_chars", "quality")],
                       transforms={"quality": "minmax_scale", "chars_per_quality": "log1p"},
                       encoders={"lang": "ordinal"})
    fitted = FeatureBuilder(plan).fit(t)
    out = fitted.transform_columns(t)
    return _rounded(out.select("doc_id", "_f_n_chars", "_f_quality", "_f_chars_per_quality", "_f_lang"))


def q_clm_missing_evidence_churn(spark, sf):
    from quaystone.operators import claims
    stats = eda.eda_stats(_churn(spark, sf), target="toxic")
    d = _t(spark, sf, "documents")
    cl = (d.select(F.concat(F.lit("lang.target_rate_by_category."), "lang").alias("evidence_stat_key"))
          .unionByName(d.select(F.concat("source", F.lit(".unique_count")).alias("evidence_stat_key")))
          .distinct())
    return claims.missing_evidence(cl, stats)


def q_flt_scale_change_orders(spark, sf):
    return _rounded(faults.scale_change(_t(spark, sf, "orders"), "o_totalprice", 100.0))


def q_flt_flip_target_labels(spark, sf):
    return faults.flip_target_encoding(_t(spark, sf, "labels"), "toxic")


def q_cln_truthiness_clip_orders(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey")
    plan = CleaningPlan([Cast("o_orderpriority", "bool", "non-empty text is true"),
                         Cast("o_custkey", "bool", "non-zero key is true"),
                         Clip("o_totalprice", "bounded for reporting", min=10000.0)])
    return _rounded(clean.execute_plan(o, plan))


def q_gate_ranked_orders_rename(spark, sf):
    o = _t(spark, sf, "orders")
    c = _contract(orders_draft(), o, "orders")
    rep = gate.run_gate(faults.rename_column(o, "o_totalprice", "o_total_price"), c, run_id="rename")
    ranked = gate.rank_findings(rep.findings_df(spark))
    # a row a finding: numbered as they come out of the ranking
    return ranked.coalesce(1).select("check_id", "severity", (F.monotonically_increasing_id() + 1).alias("position"))


def q_gate_orders_drop_required(spark, sf):
    o = _t(spark, sf, "orders")
    c = _contract(orders_draft(), o, "orders")
    return _findings(gate.run_gate(faults.drop_column(o, "o_orderpriority"), c, run_id="drop"), spark)


def q_gate_orders_change_dtype(spark, sf):
    o = _t(spark, sf, "orders")
    c = _contract(orders_draft(), o, "orders")
    return _findings(gate.run_gate(faults.change_dtype(o, "o_totalprice", "str"), c, run_id="dtype"), spark)


def _lang_experiments(spark, sf) -> DataFrame:
    """Long metrics table (variant = lang, split = cv) over the scored table."""
    m = evaluate.metrics(_scored(spark, sf), group_by="lang").withColumnRenamed("lang", "variant")
    return evaluate.metrics_long(m, ["variant"]).withColumn("split", F.lit("cv"))


def q_evl_comparison_pivot_by_lang(spark, sf):
    long = _lang_experiments(spark, sf)
    wide = evaluate.comparison_from_long(long, "cv")
    winner = evaluate.select_winner(wide, "roc_auc", ["de", "en", "es", "fr"])
    return _rounded(evaluate.comparison_table(wide, winner))


def q_clm_metric_claims_by_lang(spark, sf):
    from quaystone.operators import claims
    long = _lang_experiments(spark, sf)
    exact = long.filter(F.col("metric") == "roc_auc").select("variant", "split", "metric", "value")
    overstated = long.filter(F.col("metric") == "f1").select("variant", "split", "metric",
                                                             (F.col("value") + F.lit(0.01)).alias("value"))
    unknown = long.filter(F.col("metric") == "accuracy").select("variant", F.lit("test").alias("split"), "metric",
                                                                "value")
    checked = claims.check_metric_claims(exact.unionByName(overstated).unionByName(unknown), long)
    return _rounded(checked.select("variant", "split", "metric", "value", "measured", "status"))


def q_clm_dependencies_churn(spark, sf):
    from quaystone.operators import claims
    t = _churn(spark, sf)
    c = _contract(churn_like_draft(), t, "churn")
    lang = next(col for col in c.columns if col.name == "lang")
    assumptions = spark.createDataFrame([(f"lang={k}",) for k in sorted(lang.observed.value_distribution or {})],
                                        "assumption string")
    deps = _t(spark, sf, "documents").select(F.concat(F.lit("lang="), "lang").alias("dependency")).distinct()
    return claims.supported_dependencies(deps, assumptions)


def q_run_status_orders_faults(spark, sf):
    from quaystone.operators import runs
    o = _t(spark, sf, "orders")
    c = _contract(orders_draft(), o, "orders")
    records = []
    for run_id, fault, cand in (("rename", "rename_column", faults.rename_column(o, "o_totalprice", "o_total_price")),
                                ("x1_10", "scale_change", faults.scale_change(o, "o_totalprice", 1.10)),
                                ("clean", None, o)):
        rep = gate.run_gate(cand, c, run_id=run_id, fault_injection=fault)
        facts = {"report": rep, "rows": cand.count(), "columns": len(cand.columns)}
        records.append(runs.run_record(spark, run_id=run_id, modeling_started=rep.passed, **facts))
        if run_id == "clean":  # passed the gate, then failed; and asked for validation only
            records.append(runs.run_record(spark, run_id="late", status="halted_error", failure_category="artifact_missing",
                                           modeling_started=True, degraded_stages=("planning",), **facts))
            records.append(runs.run_record(spark, run_id="only", validate_only=True, **facts))
    path = f"{_scratch(spark)}/runs"
    for record in records:
        runs.append_run(record, path)
    return runs.run_status(runs.read_runs(spark, path)).select(
        "run_id", "status", "failure_category", "rows", F.col("columns").cast("bigint").alias("columns"),
        "gate_passed", "gate_errors", "gate_warnings", "fault_injection", "modeling_started",
        "not_started_reason", "is_pass", "is_fail", "is_demo", "is_degraded", "headline")


def _scratch(spark) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}"


def q_cal_md5_draws_orders(spark, sf):
    """The calibration's estimator on draws that SQL can repeat; 50 iterations of two batch sizes."""
    o = _t(spark, sf, "orders")
    return _rounded(calibrate.calibrate(o, "o_totalprice", ["o_orderkey", "o_totalprice", "o_orderstatus"],
                                        rate_expr=(F.col("o_orderstatus") == "F").cast("int"), sizes=(100, 300), n_iter=50,
                                        draws=calibrate.md5_positions)
                    .select("statistic", F.col("batch_n").cast("bigint").alias("batch_n"), "p50", "p95", "p99", "max"))


def q_gate_churn_faulty_runs(spark, sf):
    """Findings of five faulty candidates, appended to a findings table and read from it."""
    from quaystone.operators import runs
    t = _churn(spark, sf)
    c = _contract(churn_like_draft(), t, "churn")
    third = F.col("doc_id") % 3 == 0
    candidates = {
        "no_target": t.drop("toxic"),
        "null_target": t.withColumn("toxic", F.when(~third, F.col("toxic"))),
        "odd_target": t.withColumn("toxic", F.when(third, F.col("doc_id") + 2).otherwise(F.col("toxic"))),
        "one_class": t.withColumn("toxic", F.lit(0).cast("bigint")).withColumn("lang", F.lit("en")),
        "negative": t.withColumn("n_chars", F.when(third, -F.col("n_chars")).otherwise(F.col("n_chars") * 10)),
    }
    root = _scratch(spark)
    for run_id, candidate in candidates.items():
        runs.write_findings(spark, gate.run_gate(candidate, c, run_id=run_id), root)
    found = runs.read_findings(spark, root)
    return _rounded(found.select(
        "run_id", "check_id", "check_family", "severity", "column", "observed_value", "hint"))


def q_cln_impute_and_cast_orders(spark, sf):
    holes = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"), "o_custkey")
    plan = CleaningPlan([Impute("o_totalprice", "mean", "unpriced"), Impute("o_orderpriority", "constant", "unset", "NONE"),
                         Cast("o_custkey", "float64", "as measured elsewhere")])
    return _rounded(clean.execute_plan(holes, plan))


def q_snk_snapshot_orders(spark, sf):
    """A table written, snapshot for a run and read back: nothing changes."""
    from quaystone.operators import runs
    root = _scratch(spark)
    write_table(_t(spark, sf, "orders"), f"{root}/clean")
    return _rounded(runs.snapshot(read_parquet(spark, f"{root}/clean"), root, "run-1"))


def q_src_csv_orders(spark, sf):
    """A CSV with quotes, line breaks, long numbers and NA marks, written from orders and read back with inferred types."""
    root = _scratch(spark)
    note = F.concat(F.lit('said "'), F.col("o_orderpriority"), F.lit('",\nthen '), F.col("o_orderstatus"))
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("9"), F.lpad(F.col("o_orderkey").cast("string"), 20, "0")).alias("long_number"), note.alias("note"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit("NA")).otherwise(F.concat(F.lit("C"), "o_custkey")).alias("customer"))
    write_table(o, f"{root}/orders", fmt="csv")
    return read_table(spark, f"{root}/orders", fmt="csv")


def q_evl_metrics_null_group(spark, sf):
    m = evaluate.metrics(_scored(spark, sf).withColumn("lang", F.when(F.col("lang") != "de", F.col("lang"))), group_by="lang")
    return _rounded(m.select("lang", *[F.col(c).cast("bigint") for c in ("tn", "fp", "fn", "tp")], *evaluate.METRICS))


def q_spl_null_labels_documents(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", F.when(F.col("lang") != "de", F.col("lang")).alias("lang"))
    return stratified_split(d, "lang", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {k[2:]: v for k, v in globals().items() if k.startswith("q_") and callable(v)}
    return own | catalog_edge.queries()


# ---------------------------------------------------------------------------
# oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

_FLOAT_COLS = {"l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"}


def _mean(c: str) -> str:
    """Mean of a float column from its exact decimal sum, rounded half-up to
    6 places in integer arithmetic (DuckDB divides decimals in double, which
    can land one ulp off an exact tie)."""
    if c in _FLOAT_COLS:
        s = f"(sum({c}::DECIMAL(38,10)) * 10000000000)::HUGEINT"
        n = f"count({c})::HUGEINT"
        return f"(((2 * {s} * 1000000 + {n} * 10000000000) // (2 * {n} * 10000000000))::DOUBLE / 1000000)"
    return f"avg({c})::double"


def _mean6(c: str) -> str:
    return _mean(c) if c in _FLOAT_COLS else f"round({_mean(c)}, 6)"


_LI_COLS = [("l_orderkey", True), ("l_partkey", True), ("l_suppkey", True), ("l_linenumber", True),
            ("l_quantity", True), ("l_extendedprice", True), ("l_discount", True), ("l_tax", True),
            ("l_returnflag", False), ("l_linestatus", False), ("l_shipdate", False)]


def _profile_sql() -> str:
    parts = []
    for c, num in _LI_COLS:
        blank = (f"count(*) FILTER (WHERE regexp_matches({c}, '^\\s*$'))"
                 if c in ("l_returnflag", "l_linestatus") else "0")
        if num:
            stats = (f"round(min({c})::double, 6) AS min, round(max({c})::double, 6) AS max, "
                     f"{_mean6(c)} AS mean, round(quantile_cont({c}, 0.5)::double, 6) AS median")
        else:
            stats = "NULL::double AS min, NULL::double AS max, NULL::double AS mean, NULL::double AS median"
        parts.append(f"SELECT '{c}' AS \"column\", {str(num).lower()} AS is_numeric, "
                     f"(count(*) - count({c}))::bigint AS null_count, count({c})::bigint AS non_null_count, "
                     f"count(DISTINCT {c})::bigint AS unique_count, ({blank})::bigint AS blank_string_count, "
                     f"{stats} FROM lineitem")
    return " UNION ALL ".join(parts)


def _observed_sql() -> str:
    parts = []
    for c, num in _LI_COLS:
        if c == "l_linestatus":
            continue
        if num:
            is_float = c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
            dp = (f"max(length(rtrim(split_part(cast(cast({c} AS decimal(38,10)) AS varchar), '.', 2), '0')))"
                  if is_float else "0")
            parts.append(
                f"SELECT '{c}', (count(*) - count({c}))::bigint, count(DISTINCT {c})::bigint, "
                f"round(min({c})::double, 6), round(max({c})::double, 6), {_mean6(c)}, "
                f"round(quantile_cont({c}, 0.5)::double, 6), round(quantile_cont({c}, 0.05)::double, 6), "
                f"round(quantile_cont({c}, 0.95)::double, 6), round(stddev_samp({c})::double, 6), ({dp})::double "
                f"FROM lineitem")
        else:
            parts.append(f"SELECT '{c}', (count(*) - count({c}))::bigint, count(DISTINCT {c})::bigint, "
                         f"NULL::double, NULL::double, NULL::double, NULL::double, NULL::double, NULL::double, "
                         f"NULL::double, NULL::double FROM lineitem")
    return ("SELECT * FROM (" + " UNION ALL ".join(parts) + ") t(\"column\", null_count, unique_count, min, max, "
            "mean, median, p05, p95, std, decimal_places_max)")


_CHURN = ("(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic::bigint AS toxic "
          "FROM documents d JOIN labels l USING (doc_id))")


def _eda_sql() -> str:
    c = _CHURN
    num = []
    for col in ("doc_id", "n_chars", "quality"):
        for stat, expr in (("count", f"count({col})"), ("mean", f"avg({col})"),
                           ("median", f"quantile_cont({col}, 0.5)"),
                           ("std", f"coalesce(stddev_samp({col}), 0)"), ("min", f"min({col})"),
                           ("max", f"max({col})")):
            num.append(f"SELECT '{col}.{stat}' AS stat_key, '{col}' AS \"column\", '{stat}' AS stat, "
                       f"NULL::varchar AS category, round(({expr})::double, 6) AS value FROM {c}")
    cat = []
    for col in ("lang", "source"):
        cat.append(f"SELECT '{col}.unique_count', '{col}', 'unique_count', NULL::varchar, "
                   f"round(count(DISTINCT {col})::double, 6) FROM {c}")
        cat.append(f"SELECT '{col}.target_rate_by_category.' || {col}, '{col}', 'target_rate_by_category', "
                   f"{col}, round(avg(toxic)::double, 6) FROM {c} WHERE {col} IS NOT NULL GROUP BY {col}")
    head = [f"SELECT 'dataset.row_count' AS stat_key, 'dataset' AS \"column\", 'row_count' AS stat, "
            f"NULL::varchar AS category, count(*)::double AS value FROM {c}",
            "SELECT 'dataset.column_count', 'dataset', 'column_count', NULL::varchar, 6::double",
            f"SELECT 'toxic.positive_rate', 'toxic', 'positive_rate', NULL::varchar, round(avg(toxic)::double, 6) FROM {c}",
            f"SELECT 'toxic.positive_count', 'toxic', 'positive_count', NULL::varchar, sum(toxic)::double FROM {c}",
            f"SELECT 'toxic.negative_count', 'toxic', 'negative_count', NULL::varchar, (count(*) - sum(toxic))::double FROM {c}"]
    return " UNION ALL ".join(head + num + cat)


def _corr_sql() -> str:
    cols = sorted(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax"])
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}__vs__{b}' AS pair, '{a}' AS col_a, '{b}' AS col_b, "
                         f"round(greatest(-1, least(1, covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))))::double, 6) AS value "
                         f"FROM lineitem")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE value IS NOT NULL AND NOT isnan(value)"


def _metrics_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    gp = f"PARTITION BY {group} " if group else ""
    jg = f"USING ({group})" if group else "ON true"
    scored = (f"(SELECT {g}toxic AS label, (n_chars % 997) / 997.0 AS score FROM {_CHURN})")
    return f"""
WITH s AS {scored},
c AS (SELECT {g}count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn,
             count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
             count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn,
             count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp FROM s {('GROUP BY ' + group) if group else ''}),
b AS (SELECT {g}score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::double AS pos,
             sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::double AS neg FROM s GROUP BY {g}score),
w AS (SELECT {g}pos, neg,
             sum(pos) OVER ({gp}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
             sum(neg) OVER ({gp}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn,
             sum(pos + neg) OVER ({gp}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ct,
             sum(pos) OVER ({gp}) AS P_, sum(neg) OVER ({gp}) AS N_ FROM b),
r AS (SELECT {g}sum(pos * (N_ - cn + 0.5 * neg)) / (max(P_) * max(N_)) AS roc_auc,
             sum(pos * cp / ct) / max(P_) AS pr_auc FROM w {('GROUP BY ' + group) if group else ''})
SELECT {g}tn::bigint AS tn, fp::bigint AS fp, fn::bigint AS fn, tp::bigint AS tp,
       round(roc_auc::double, 6) AS roc_auc, round(pr_auc::double, 6) AS pr_auc,
       round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)::double, 6) AS f1,
       round(coalesce(1.0 * tp / nullif(tp + fp, 0), 0)::double, 6) AS precision,
       round(coalesce(1.0 * tp / nullif(tp + fn, 0), 0)::double, 6) AS recall,
       round(coalesce(1.0 * (tp + tn) / nullif(tp + tn + fp + fn, 0), 0)::double, 6) AS accuracy
FROM c JOIN r {jg}"""


def _gate_churn_sql(candidate: str, findings: list[str]) -> str:
    return f"WITH base AS {_CHURN}, cand AS ({candidate}) " + " UNION ALL ".join(findings)


_F = "SELECT '{id}' AS check_id, '{fam}' AS check_family, '{sev}' AS severity, {col} AS \"column\", {val} AS observed_value"


def _finding(id, fam, sev, col, val, where=None, src=None):
    col = "NULL::varchar" if col is None else f"'{col}'"
    q = _F.format(id=id, fam=fam, sev=sev, col=col, val=f"round(({val})::double, 6)" if val != "NULL" else "NULL::double")
    if src:
        q += f" FROM {src}"
    if where:
        q += f" WHERE {where}" if src else f" FROM (SELECT 1) WHERE {where}"
    return q


def _integrity(changed_where: str, src: str) -> str:
    return _finding("INTEGRITY_SHA256_MATCH", "integrity", "ERROR", None, "NULL",
                    where=f"EXISTS (SELECT 1 FROM {src} WHERE {changed_where})")


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["pro_columns_lineitem"] = _profile_sql()
    sql["pro_top_values_orders"] = """
SELECT "column", value, n::bigint AS count, rank::bigint AS rank FROM (
  SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank
  FROM (SELECT "column", value, count(*) AS n
        FROM (SELECT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
              UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders) GROUP BY "column", value))
WHERE rank <= 10"""
    sql["pro_summary_documents"] = """
SELECT count(*)::bigint AS row_count, 4::bigint AS column_count,
       (count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)))::bigint
       AS duplicate_row_count FROM documents"""
    sql["pro_target_distribution_labels"] = (
        "SELECT coalesce(CAST(toxic AS varchar), 'null') AS value, count(*)::bigint AS count FROM labels GROUP BY 1")
    sql["pro_preview_orders"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, "
                                 "o_orderdate, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 20")
    sql["flt_low_cardinality_lineitem"] = """
SELECT * FROM (SELECT 'l_returnflag' AS "column", 8::bigint AS position, count(DISTINCT l_returnflag)::bigint AS unique_count FROM lineitem)
WHERE unique_count BETWEEN 2 AND 10"""
    sql["flt_widest_spread_lineitem"] = (
        "SELECT arg_max(c, s) AS \"column\", round(max(s)::double, 6) AS std FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS c, stddev_samp({c}) AS s FROM lineitem" for c, num in _LI_COLS if num) + ")")
    sql["eda_stats_churn"] = _eda_sql()
    sql["eda_correlations_lineitem"] = _corr_sql()
    sql["eda_histogram_orders"] = """
WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
bins AS (SELECT range::bigint AS bin FROM range(1, 31)),
c AS (SELECT least(floor((o_totalprice - lo) / (hi - lo) * 30)::bigint + 1, 30) AS bin, count(*) AS n
      FROM orders, mm GROUP BY 1)
SELECT bins.bin, round(lo + (bins.bin - 1) * (hi - lo) / 30, 6) AS lower, round(lo + bins.bin * (hi - lo) / 30, 6) AS upper,
       coalesce(n, 0)::bigint AS count FROM bins LEFT JOIN c USING (bin), mm"""
    sql["eda_target_rate_lang"] = (f"SELECT lang AS category, round(avg(toxic)::double, 6) AS rate FROM {_CHURN} "
                                   "WHERE lang IS NOT NULL GROUP BY lang")
    sql["con_observed_lineitem"] = _observed_sql()
    sql["con_value_distribution_lineitem"] = """
SELECT 'l_returnflag' AS "column", l_returnflag AS value,
       round(count(*)::double / (SELECT count(l_returnflag) FROM lineitem), 6) AS share
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag"""
    sql["con_target_lineitem"] = """
SELECT coalesce(l_linestatus, 'null') AS value, count(*)::bigint AS count,
       round((SELECT count(*) FILTER (WHERE l_linestatus = 'O')::double / count(*) FROM lineitem), 6) AS positive_rate
FROM lineitem GROUP BY 1"""
    sql["con_md5_buckets_orders"] = """
SELECT substr(md5(concat_ws('|', coalesce(CAST(o_orderkey AS varchar), '\\N'), coalesce(CAST(o_custkey AS varchar), '\\N'),
       coalesce(o_orderstatus, '\\N'), coalesce(CAST(o_totalprice AS varchar), '\\N'),
       coalesce(CAST(o_orderdate AS varchar), '\\N'), coalesce(o_orderpriority, '\\N'))), 1, 1) AS bucket,
       count(*)::bigint AS rows FROM orders GROUP BY 1"""

    pk = ("(SELECT sum(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))")
    sql["gate_lineitem_scale_x100"] = " UNION ALL ".join([
        _finding("CONSTRAINTS_PRIMARY_KEY_UNIQUE", "constraints", "ERROR", "l_orderkey,l_linenumber", pk,
                 where=f"{pk} > 0"),
        _finding("SCALE_DRIFT_MEDIAN", "scale_drift", "ERROR", "l_extendedprice",
                 "(SELECT quantile_cont(l_extendedprice * 100, 0.5) FROM lineitem)",
                 where="abs((SELECT quantile_cont(l_extendedprice * 100, 0.5) / quantile_cont(l_extendedprice, 0.5) FROM lineitem) - 1) > 0.25"),
        _integrity("l_extendedprice * 100 <> l_extendedprice", "lineitem"),
    ])
    sql["gate_orders_scale_x1_10"] = _integrity("o_totalprice * 1.10 <> o_totalprice", "orders")
    cand_flip = "SELECT doc_id, lang, source, n_chars, quality, 1 - toxic AS toxic FROM base"
    sql["gate_churn_flip_target"] = _gate_churn_sql(cand_flip, [
        _finding("TARGET_POSITIVE_RATE_DRIFT", "target", "ERROR", "toxic",
                 "(SELECT avg(CASE WHEN toxic = (SELECT max(toxic) FROM cand) THEN 1.0 ELSE 0.0 END) FROM cand)",
                 where="abs((SELECT avg(CASE WHEN toxic = (SELECT max(toxic) FROM cand) THEN 1.0 ELSE 0.0 END) FROM cand)"
                       " - (SELECT avg(CASE WHEN toxic = (SELECT max(toxic) FROM base) THEN 1.0 ELSE 0.0 END) FROM base)) > 0.05"),
        _integrity("true", "cand"),
    ])
    cand_nulls = ("SELECT doc_id, lang, source, CASE WHEN row_number() OVER (ORDER BY doc_id) <= 25 THEN NULL "
                  "ELSE n_chars END AS n_chars, quality, toxic FROM base")
    sql["gate_churn_inject_nulls"] = _gate_churn_sql(cand_nulls, [
        _finding("CONSTRAINTS_NULLABLE", "constraints", "ERROR", "n_chars",
                 "(SELECT count(*) - count(n_chars) FROM cand)", where="(SELECT count(*) - count(n_chars) FROM cand) > 0"),
        _finding("SCALE_DRIFT_MEDIAN", "scale_drift", "ERROR", "n_chars",
                 "(SELECT quantile_cont(n_chars, 0.5) FROM cand)",
                 where="abs((SELECT quantile_cont(n_chars, 0.5) FROM cand) / (SELECT quantile_cont(n_chars, 0.5) FROM base) - 1) > 0.25"),
        _integrity("true", "cand"),
    ])
    cand_cat = ("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) = 1 THEN 'xx' ELSE lang END AS lang, "
                "source, n_chars, quality, toxic FROM base")
    sql["gate_churn_unknown_category"] = _gate_churn_sql(cand_cat, [
        _finding("CONSTRAINTS_CLOSED_DOMAIN", "constraints", "ERROR", "lang",
                 "(SELECT count(DISTINCT lang) FROM cand WHERE lang NOT IN ('de', 'en', 'es', 'fr'))",
                 where="(SELECT count(*) FROM cand WHERE lang NOT IN ('de', 'en', 'es', 'fr')) > 0"),
        _integrity("true", "cand"),
    ])
    cand_trunc = "SELECT * FROM base ORDER BY doc_id LIMIT 19"
    rate = "(SELECT avg(CASE WHEN toxic = (SELECT max(toxic) FROM {t}) THEN 1.0 ELSE 0.0 END) FROM {t})"
    sql["gate_churn_truncate"] = _gate_churn_sql(cand_trunc, [
        _finding("TARGET_AT_LEAST_TWO_CLASSES", "target", "ERROR", "toxic", "(SELECT count(DISTINCT toxic) FROM cand)",
                 where="(SELECT count(DISTINCT toxic) FROM cand) < 2"),
        _finding("TARGET_POSITIVE_RATE_DRIFT", "target", "ERROR", "toxic", rate.format(t="cand"),
                 where=f"abs({rate.format(t='cand')} - {rate.format(t='base')}) > 0.05"),
        _finding("SCALE_DRIFT_MEDIAN", "scale_drift", "ERROR", "n_chars", "(SELECT quantile_cont(n_chars, 0.5) FROM cand)",
                 where="abs((SELECT quantile_cont(n_chars, 0.5) FROM cand) / (SELECT quantile_cont(n_chars, 0.5) FROM base) - 1) > 0.25"),
        _finding("SCALE_DRIFT_ROW_COUNT", "scale_drift", "WARN", None, "(SELECT count(*) FROM cand)",
                 where="(SELECT count(*) FROM cand) <> (SELECT count(*) FROM base)"),
        _integrity("true", "cand"),
        _finding("MODELING_MIN_ROWS", "modeling", "ERROR", None, "(SELECT count(*) FROM cand)",
                 where="(SELECT count(*) FROM cand) < 20"),
        _finding("MODELING_CONSTANT_REQUIRED_FEATURE", "modeling", "WARN", "lang",
                 "(SELECT count(DISTINCT lang) FROM cand)", where="(SELECT count(DISTINCT lang) FROM cand) <= 1"),
        _finding("MODELING_CONSTANT_REQUIRED_FEATURE", "modeling", "WARN", "n_chars",
                 "(SELECT count(DISTINCT n_chars) FROM cand)", where="(SELECT count(DISTINCT n_chars) FROM cand) <= 1"),
    ])
    sql["gate_orders_rename"] = " UNION ALL ".join([
        _finding("SCHEMA_MISSING_COLUMN", "schema", "ERROR", "o_totalprice", "NULL"),
        _finding("SCHEMA_UNKNOWN_COLUMN", "schema", "WARN", "o_total_price", "NULL"),
        _finding("SCHEMA_COLUMN_ORDER", "schema", "WARN", None, "NULL"),
        _finding("CONSTRAINTS_PRIMARY_KEY_UNIQUE", "constraints", "ERROR", "o_orderkey",
                 "(SELECT sum(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1))",
                 where="EXISTS (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)"),
        _finding("INTEGRITY_SHA256_MATCH", "integrity", "ERROR", None, "NULL"),
    ])
    sql["flt_inject_nulls_orders"] = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= 100 "
        "THEN NULL ELSE round(o_totalprice, 6) END AS o_totalprice, o_orderdate, o_orderpriority FROM orders")
    sql["flt_truncate_orders"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, "
                                  "o_orderdate, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 19")
    sql["flt_unknown_category_orders"] = (
        "SELECT o_orderkey, o_custkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) = 1 THEN 'X' "
        "ELSE o_orderstatus END AS o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderdate, o_orderpriority FROM orders")
    dirty = ("(SELECT o_orderkey, o_custkey, o_orderstatus AS status, CASE WHEN o_orderkey % 7 = 0 THEN NULL "
             "WHEN o_orderkey % 11 = 0 THEN ' ' ELSE CAST(o_totalprice AS varchar) END AS total_price, o_orderpriority FROM orders)")
    sql["cln_dirty_orders"] = f"""
WITH d AS {dirty}, p AS (SELECT *, TRY_CAST(trim(total_price) AS double) AS tp FROM d),
m AS (SELECT quantile_cont(tp, 0.5) AS med FROM p)
SELECT o_orderkey, o_custkey,
       CASE status WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status,
       round(least(greatest(coalesce(tp, med), 2000.0), 450000.0), 6) AS total_price, o_orderpriority
FROM p, m"""
    sql["cln_mode_impute_orders"] = """
WITH d AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS pr FROM orders),
m AS (SELECT pr FROM d WHERE pr IS NOT NULL GROUP BY pr ORDER BY count(*) DESC, pr LIMIT 1)
SELECT o_orderkey, CAST(o_custkey AS varchar) AS o_custkey, coalesce(d.pr, m.pr) AS o_orderpriority FROM d, m"""
    sql["cln_drop_duplicates_documents"] = ("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER "
                                            "(PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
    sql["cal_incident_orders"] = ("SELECT f::bigint AS factor, round(abs(m * f - m) / m * 100, 6) AS median_dev_pct "
                                  "FROM (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM orders), "
                                  "(VALUES (2), (3), (10), (100)) v(f)")
    split = (f"(SELECT doc_id, toxic, CASE WHEN row_number() OVER (PARTITION BY toxic ORDER BY md5('42|' || doc_id), doc_id) "
             f"<= floor(0.2 * count(*) OVER (PARTITION BY toxic) + 0.5) THEN 'test' ELSE 'train' END AS split FROM {_CHURN})")
    sql["spl_split_churn"] = f"SELECT doc_id, toxic, split FROM {split}"
    sql["spl_folds_churn"] = (f"SELECT doc_id, toxic, ((row_number() OVER (PARTITION BY toxic ORDER BY md5('43|' || doc_id), doc_id) - 1) % 5)::bigint AS fold "
                              f"FROM {split} WHERE split = 'train'")
    x100 = sql["gate_lineitem_scale_x100"]
    sql["gate_report_lineitem_x100"] = (
        f"SELECT count(*) FILTER (WHERE severity = 'ERROR') = 0 AS passed, "
        f"count(*) FILTER (WHERE severity = 'ERROR')::bigint AS errors, "
        f"count(*) FILTER (WHERE severity = 'WARN')::bigint AS warnings FROM ({x100})")
    sql["gate_families_lineitem_x100"] = (f"SELECT check_family, count(*)::bigint AS findings FROM ({x100}) "
                                          f"GROUP BY check_family")
    by_lang = _metrics_sql("lang")
    sql["evl_winner_by_lang"] = f"""
WITH m AS ({by_lang}),
w AS (SELECT lang FROM m ORDER BY roc_auc DESC, CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END LIMIT 1)
SELECT m.lang AS variant, roc_auc, pr_auc, f1, precision, recall, accuracy, m.lang = (SELECT lang FROM w) AS is_winner FROM m"""
    sql["fea_transforms_churn"] = f"""
WITH t AS {_CHURN},
d AS (SELECT *, n_chars::double / CASE WHEN quality = 0 THEN 1 ELSE quality END AS cpq FROM t),
s AS (SELECT avg(n_chars) AS mu, stddev_pop(n_chars) AS sd, min(quality) AS qlo, max(quality) AS qhi FROM d),
labels AS (SELECT lang, (row_number() OVER (ORDER BY lang) - 1)::double AS i FROM (SELECT DISTINCT lang FROM d))
SELECT doc_id, round((n_chars - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS _f_n_chars,
       round(CASE WHEN qhi = qlo THEN 0 ELSE (quality - qlo) / (qhi - qlo) END, 6) AS _f_quality,
       round(ln(1 + cpq), 6) AS _f_chars_per_quality, round(labels.i, 6) AS _f_lang
FROM d JOIN labels USING (lang), s"""
    sql["clm_missing_evidence_churn"] = f"""
WITH stats AS (SELECT 'lang.target_rate_by_category.' || lang AS k FROM {_CHURN} GROUP BY lang),
cl AS (SELECT DISTINCT 'lang.target_rate_by_category.' || lang AS evidence_stat_key FROM documents
       UNION SELECT DISTINCT source || '.unique_count' FROM documents)
SELECT evidence_stat_key FROM cl WHERE evidence_stat_key NOT IN (SELECT k FROM stats)
  AND evidence_stat_key NOT IN ('lang.unique_count', 'source.unique_count')"""
    sql["flt_scale_change_orders"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice * 100, 6) AS o_totalprice, "
                                      "o_orderdate, o_orderpriority FROM orders")
    sql["flt_flip_target_labels"] = "SELECT doc_id, quality, 1 - toxic AS toxic FROM labels"
    sql["cln_truthiness_clip_orders"] = ("SELECT o_orderkey, length(o_orderpriority) > 0 AS o_orderpriority, "
                                         "round(greatest(o_totalprice, 10000.0), 6) AS o_totalprice, "
                                         "o_custkey <> 0 AS o_custkey FROM orders")
    order = ["SCHEMA_MISSING_COLUMN", "SCHEMA_UNKNOWN_COLUMN", "SCHEMA_COLUMN_ORDER", "SCHEMA_DTYPE_COMPATIBLE",
             "TARGET_COLUMN_PRESENT", "TARGET_NO_NULLS", "TARGET_CLOSED_DOMAIN", "TARGET_AT_LEAST_TWO_CLASSES",
             "TARGET_POSITIVE_RATE_DRIFT", "CONSTRAINTS_NULLABLE", "CONSTRAINTS_BUSINESS_RANGE",
             "CONSTRAINTS_CLOSED_DOMAIN", "CONSTRAINTS_PRIMARY_KEY_UNIQUE", "SCALE_DRIFT_MEDIAN",
             "SCALE_DRIFT_ROW_COUNT", "INTEGRITY_SHA256_MATCH", "MODELING_MIN_ROWS", "MODELING_MIN_FEATURES",
             "MODELING_CONSTANT_REQUIRED_FEATURE"]
    gate_pos = "CASE check_id " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(order)) + " END"
    sql["gate_ranked_orders_rename"] = (
        "SELECT check_id, severity, row_number() OVER (ORDER BY CASE severity WHEN 'ERROR' THEN 0 "
        "WHEN 'WARN' THEN 1 WHEN 'INFO' THEN 2 ELSE 3 END, CASE check_family WHEN 'scale_drift' THEN 0 ELSE 1 END, "
        f"{gate_pos})::bigint AS position FROM ({sql['gate_orders_rename']})")
    pk = _finding("CONSTRAINTS_PRIMARY_KEY_UNIQUE", "constraints", "ERROR", "o_orderkey",
                  "(SELECT sum(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1))",
                  where="EXISTS (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)")
    sql["gate_orders_drop_required"] = " UNION ALL ".join([
        _finding("SCHEMA_MISSING_COLUMN", "schema", "ERROR", "o_orderpriority", "NULL"),
        _finding("SCHEMA_COLUMN_ORDER", "schema", "WARN", None, "NULL"),
        pk,
        _finding("INTEGRITY_SHA256_MATCH", "integrity", "ERROR", None, "NULL"),
    ])
    sql["gate_orders_change_dtype"] = " UNION ALL ".join([
        _finding("SCHEMA_DTYPE_COMPATIBLE", "schema", "ERROR", "o_totalprice", "NULL"),
        pk,
        _finding("INTEGRITY_SHA256_MATCH", "integrity", "ERROR", None, "NULL"),
    ])
    by_lang_raw = _metrics_sql("lang")
    sql["evl_comparison_pivot_by_lang"] = sql["evl_winner_by_lang"]
    sql["clm_metric_claims_by_lang"] = f"""
WITH m AS ({by_lang_raw}),
l AS (SELECT lang AS variant, 'cv' AS split, metric, value FROM m
      UNPIVOT (value FOR metric IN (roc_auc, pr_auc, f1, precision, recall, accuracy))),
c AS (SELECT variant, split, metric, value FROM l WHERE metric = 'roc_auc'
      UNION ALL SELECT variant, split, metric, value + 0.01 FROM l WHERE metric = 'f1'
      UNION ALL SELECT variant, 'test', metric, value FROM l WHERE metric = 'accuracy')
SELECT c.variant, c.split, c.metric, round(c.value, 6) AS value, round(l.value, 6) AS measured,
       CASE WHEN l.value IS NULL THEN 'unknown' WHEN l.value = c.value THEN 'ok' ELSE 'mismatch' END AS status
FROM c LEFT JOIN l USING (variant, split, metric)"""
    sql["clm_dependencies_churn"] = f"""
SELECT DISTINCT 'lang=' || lang AS dependency FROM documents
WHERE lang IN (SELECT DISTINCT lang FROM {_CHURN} WHERE lang IS NOT NULL)"""
    # what each run did, and what the reference's status rules say of it
    counted = " UNION ALL ".join(
        f"SELECT '{rid}' AS run_id, count(*) FILTER (severity = 'ERROR')::bigint AS gate_errors, "
        f"count(*) FILTER (severity = 'WARN')::bigint AS gate_warnings FROM ({q})"
        for rid, q in (("rename", sql["gate_orders_rename"]), ("x1_10", sql["gate_orders_scale_x1_10"])))
    sql["run_status_orders_faults"] = f"""
WITH gated AS ({counted} UNION ALL SELECT unnest(['clean', 'late', 'only']), 0, 0),
told(run_id, fault_injection, later, solo, stages) AS (VALUES
  ('rename', 'rename_column', NULL, false, 0), ('x1_10', 'scale_change', NULL, false, 0), ('clean', NULL, NULL, false, 0),
  ('late', NULL, 'artifact_missing', false, 1), ('only', NULL, NULL, true, 0)),
ended AS (
  SELECT *, CASE WHEN gate_errors > 0 THEN 'validation_failed' ELSE later END AS failure_category,
         gate_errors = 0 AND NOT solo AS modeling_started
  FROM gated JOIN told USING (run_id))
SELECT run_id, coalesce(map {{'validation_failed': 'halted_validation', 'artifact_missing': 'halted_error'}}[failure_category], 'completed') AS status,
       failure_category, (SELECT count(*) FROM orders)::bigint AS rows,
       (SELECT count(*) FROM duckdb_columns() WHERE table_name = 'orders')::bigint AS columns,
       gate_errors = 0 AS gate_passed, gate_errors, gate_warnings, fault_injection, modeling_started,
       CASE WHEN solo THEN 'only validation was asked for' WHEN NOT modeling_started THEN 'the gate found errors' END AS not_started_reason,
       failure_category IS NULL AS is_pass, failure_category IS NOT NULL AS is_fail, fault_injection IS NOT NULL AS is_demo,
       stages > 0 AS is_degraded, coalesce('failed: ' || failure_category, 'completed') AS headline
FROM ended"""
    sql["cal_md5_draws_orders"] = """
WITH pop AS (SELECT row_number() OVER (ORDER BY o_orderkey, o_totalprice, o_orderstatus) - 1 AS pos, o_totalprice AS v,
                    (o_orderstatus = 'F')::int AS r FROM orders),
st AS (SELECT count(*) AS n, avg(r) AS rate, quantile_cont(v, 0.5) AS med FROM pop),
draws AS (SELECT size, iter, CAST('0x' || substr(md5('42|' || size || '|' || iter || '|' || k), 1, 13) AS BIGINT) % n AS pos
          FROM st, unnest([100, 300]) AS s(size), unnest(range(0, 50)) AS i(iter), unnest(range(0, size)) AS t(k)),
batches AS (SELECT size, iter, quantile_cont(v, 0.5) AS med, avg(r) AS rate FROM draws JOIN pop USING (pos) GROUP BY size, iter),
devs AS (SELECT size, 'median_dev_pct' AS statistic, abs(b.med - st.med) / st.med * 100 AS d FROM batches b, st
         UNION ALL SELECT size, 'rate_dev_pp', abs(b.rate - st.rate) * 100 FROM batches b, st)
SELECT statistic, size::bigint AS batch_n, round(quantile_cont(d, 0.5), 6) AS p50, round(quantile_cont(d, 0.95), 6) AS p95,
       round(quantile_cont(d, 0.99), 6) AS p99, round(max(d), 6) AS max FROM devs GROUP BY statistic, size"""
    sql["gate_churn_faulty_runs"] = f"""
WITH base AS {_CHURN},
cand AS (
  SELECT 'no_target' AS run_id, doc_id, lang, n_chars, NULL::bigint AS toxic FROM base
  UNION ALL SELECT 'null_target', doc_id, lang, n_chars, CASE WHEN doc_id % 3 <> 0 THEN toxic END FROM base
  UNION ALL SELECT 'odd_target', doc_id, lang, n_chars, CASE WHEN doc_id % 3 = 0 THEN doc_id + 2 ELSE toxic END FROM base
  UNION ALL SELECT 'one_class', doc_id, 'en', n_chars, 0 FROM base
  UNION ALL SELECT 'negative', doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN -n_chars ELSE n_chars * 10 END, toxic FROM base),
was AS (SELECT quantile_cont(n_chars, 0.5) AS med, avg((toxic = (SELECT max(toxic) FROM base))::int) AS rate FROM base),
tops AS (SELECT run_id, max(toxic) AS top FROM cand GROUP BY run_id),
facts AS (
  SELECT run_id, count(*) FILTER (toxic IS NULL) AS nulls, count(DISTINCT toxic) AS classes,
         count(DISTINCT toxic) FILTER (toxic NOT IN (0, 1)) AS odd, count(*) FILTER (n_chars < 0) AS below,
         avg(coalesce((toxic = top)::int, 0)) AS rate, quantile_cont(n_chars, 0.5) AS med, count(DISTINCT lang) AS langs
  FROM cand JOIN tops USING (run_id) GROUP BY run_id),
found AS (
  SELECT run_id, 'TARGET_COLUMN_PRESENT' AS check_id, 'target' AS check_family, 'ERROR' AS severity, 'toxic' AS "column", NULL::double AS v
  FROM facts WHERE run_id = 'no_target'
  UNION ALL SELECT run_id, 'TARGET_NO_NULLS', 'target', 'ERROR', 'toxic', nulls FROM facts WHERE nulls > 0 AND run_id <> 'no_target'
  UNION ALL SELECT run_id, 'TARGET_CLOSED_DOMAIN', 'target', 'ERROR', 'toxic', odd FROM facts WHERE odd > 0
  UNION ALL SELECT run_id, 'TARGET_AT_LEAST_TWO_CLASSES', 'target', 'ERROR', 'toxic', classes FROM facts WHERE classes < 2 AND run_id <> 'no_target'
  UNION ALL SELECT run_id, 'TARGET_POSITIVE_RATE_DRIFT', 'target', 'ERROR', 'toxic', f.rate FROM facts f, was
  WHERE abs(f.rate - was.rate) > 0.05 AND run_id <> 'no_target'
  UNION ALL SELECT run_id, 'CONSTRAINTS_BUSINESS_RANGE', 'constraints', 'ERROR', 'n_chars', below FROM facts WHERE below > 0
  UNION ALL SELECT run_id, 'SCALE_DRIFT_MEDIAN', 'scale_drift', 'ERROR', 'n_chars', f.med FROM facts f, was WHERE abs(f.med / was.med - 1) > 0.25
  UNION ALL SELECT run_id, 'MODELING_CONSTANT_REQUIRED_FEATURE', 'modeling', 'WARN', 'lang', langs FROM facts WHERE langs <= 1
  -- no candidate is the contracted table, and without the target the columns are others
  UNION ALL SELECT run_id, 'INTEGRITY_SHA256_MATCH', 'integrity', 'ERROR', NULL, NULL FROM facts
  UNION ALL SELECT run_id, 'SCHEMA_COLUMN_ORDER', 'schema', 'WARN', NULL, NULL FROM facts WHERE run_id = 'no_target')
SELECT run_id, check_id, check_family, severity, "column", round(v, 6) AS observed_value,
       CASE WHEN check_id = 'SCALE_DRIFT_MEDIAN' THEN (SELECT min(h) FROM unnest([0.001, 0.01, 0.1, 10.0, 100.0, 1000.0]) AS t(h), was
         WHERE abs(v / was.med / h - 1) < 0.05)::double END AS hint
FROM found"""
    sql["cln_impute_and_cast_orders"] = """
WITH h AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS p,
                  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS q, o_custkey FROM orders)
SELECT o_orderkey, round(coalesce(p, (SELECT avg(p) FROM h)), 6) AS o_totalprice, coalesce(q, 'NONE') AS o_orderpriority,
       o_custkey::double AS o_custkey FROM h"""
    sql["snk_snapshot_orders"] = "SELECT * REPLACE (round(o_totalprice, 6) AS o_totalprice) FROM orders"
    sql["src_csv_orders"] = """
SELECT o_orderkey, '9' || lpad(o_orderkey::varchar, 20, '0') AS long_number,
       'said "' || o_orderpriority || '",' || chr(10) || 'then ' || o_orderstatus AS note,
       CASE WHEN o_orderkey % 4 <> 0 THEN 'C' || o_custkey END AS customer FROM orders"""
    sql["evl_metrics_null_group"] = _metrics_sql("lang").replace(
        "WITH s AS (SELECT lang,", "WITH s AS (SELECT nullif(lang, 'de') AS lang,").replace("USING (lang)", "ON c.lang IS NOT DISTINCT FROM r.lang").replace(
        "SELECT lang, tn::bigint", "SELECT c.lang, tn::bigint")
    sql["spl_null_labels_documents"] = """
WITH d AS (SELECT doc_id, nullif(lang, 'de') AS lang FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) - 1 AS k, count(*) OVER (PARTITION BY lang) AS n FROM d)
SELECT doc_id, lang, CASE WHEN k < floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM r"""
    sql["evl_metrics_scores"] = _metrics_sql(None)
    sql["evl_metrics_by_lang"] = _metrics_sql("lang")
    return sql | catalog_edge.oracle_sql()
