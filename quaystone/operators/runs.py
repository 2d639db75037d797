"""Run layer: snapshot hand-off, gated publish, run records, status.

A run validates exactly the snapshot it later trains on: the candidate is
written once under the run's folder and every later stage reads that copy.
Publishing is gated: with zero gate errors the snapshot goes to the
published table, otherwise to quarantine — and a run record is appended
either way, with the reason when downstream work did not start.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.operators.gate import FINDINGS_SCHEMA, REPORT_SCHEMA, GateReport
from quaystone.plans.store import PLANS_SCHEMA, StoredPlanError, plans_table, stored_plans
from quaystone.session import checkpoint_dir

RUNS_SCHEMA = ("run_id string, status string, failure_category string, rows long, columns int, gate_passed boolean, "
               "gate_errors long, gate_warnings long, fault_injection string, validate_only boolean, modeling_started boolean, "
               "not_started_reason string, degraded_stages array<string>, best_model string, best_metric string, "
               "best_value double, recorded_at string")

# How a run can end (or not have ended yet).
HALTED = ("halted_validation", "halted_agent_failure", "halted_error")
STATUSES = ("pending", "running", "completed", *HALTED)

# Why modelling did not start, by the run's status.
NOT_STARTED = {
    "halted_validation": "the gate found errors",
    "halted_agent_failure": "a planning stage failed before modelling",
    "halted_error": "an error stopped the run before modelling",
}


def snapshot(df: DataFrame, root: str, run_id: str, name: str = "candidate") -> DataFrame:
    """Write the exact candidate under ``root/run_id/name`` and return the
    re-read copy: the only table later stages may use."""
    path = f"{root.rstrip('/')}/{run_id}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass
class PublishOutcome:
    published: bool
    path: str
    reason: str | None


def gated_publish(df: DataFrame, report: GateReport, published_path: str, quarantine_path: str) -> PublishOutcome:
    if report.passed:
        df.write.mode("overwrite").parquet(published_path)
        return PublishOutcome(True, published_path, None)
    df.write.mode("overwrite").parquet(quarantine_path)
    ids = sorted({f.check_id for f in report.findings if f.severity == "ERROR"})
    return PublishOutcome(False, quarantine_path, f"gate failed with {report.errors} error(s): {', '.join(ids)}")


def not_started(status: str, validate_only: bool) -> str:
    """The reason a run without modelling records; every such run has one."""
    if validate_only:
        return "only validation was asked for"
    return NOT_STARTED.get(status, "the run has not passed the gate")


def run_record(spark: SparkSession, *, run_id: str, report: GateReport | None, rows: int | None, columns: int | None,
               status: str | None = None, validate_only: bool = False, modeling_started: bool = False,
               failure_category: str | None = None, degraded_stages: tuple[str, ...] = (), best_model: str | None = None,
               best_metric: str | None = None, best_value: float | None = None) -> DataFrame:
    """One record. Without a status, a report with errors halted the run and one without completed it."""
    if status is None:
        status = "running" if report is None else "completed" if report.passed else "halted_validation"
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}; known: {STATUSES}")
    if status == "halted_validation" and failure_category is None:
        failure_category = "validation_failed"
    gate = (report.passed, report.errors, report.warnings, report.fault_injection) if report else (None,) * 4
    row = (run_id, status, failure_category, rows, columns, *gate, validate_only, modeling_started,
           None if modeling_started else not_started(status, validate_only), list(degraded_stages), best_model, best_metric,
           best_value, datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    return spark.createDataFrame([row], RUNS_SCHEMA)


def write_keyed(df: DataFrame, path: str) -> None:
    """Write rows keyed by run_id: a run that is written again replaces its own rows and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def append_run(record: DataFrame, runs_path: str) -> None:
    """Add a run's record; written twice, it is there once."""
    write_keyed(record, runs_path)


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    """All run records; run ids stay text."""
    return spark.read.schema(RUNS_SCHEMA).parquet(runs_path).select(*T.StructType.fromDDL(RUNS_SCHEMA).names)


def run_status(runs: DataFrame) -> DataFrame:
    """Flags and a headline for every record, from its status alone: passing the
    gate is not completing the run."""
    is_pass, is_fail = F.col("status") == "completed", F.col("status").isin(*HALTED)
    headline = (F.when(is_fail, F.concat(F.lit("failed: "), F.coalesce("failure_category", "status")))
                .when(is_pass, F.lit("completed"))
                .when(F.col("status") == "running", F.lit("still running"))
                .when(F.col("status") == "pending", F.lit("recorded, not started"))
                .otherwise(F.concat(F.lit("status: "), F.coalesce("status", F.lit("unknown")))))
    return runs.select("*", F.coalesce(is_pass, F.lit(False)).alias("is_pass"), F.coalesce(is_fail, F.lit(False)).alias("is_fail"),
                       F.col("fault_injection").isNotNull().alias("is_demo"),
                       (F.size(F.coalesce("degraded_stages", F.array().cast("array<string>"))) > 0).alias("is_degraded"),
                       headline.alias("headline"))


def verified_winner(experiments: DataFrame, winner: str | None, primary_metric: str | None) -> float:
    """The winner's primary metric on the test split; an error if the winner, the metric or its one value is missing."""
    if not winner or not primary_metric:
        raise ValueError("the experiments name no winner or no primary metric")
    rows = experiments.where((F.col("variant") == winner) & (F.col("split") == "test")
                             & (F.col("metric") == primary_metric)).select("value").limit(2).collect()
    if len(rows) != 1 or rows[0]["value"] is None:
        raise ValueError(f"the experiments have no single test {primary_metric} for {winner!r}")
    return float(rows[0]["value"])


def required_outputs_present(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, present, non_empty) for every output a completed run must leave."""
    rows = []
    for p in paths:
        try:
            df = spark.read.parquet(p)
            rows.append((p, True, len(df.limit(1).collect()) > 0))
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            rows.append((p, False, False))
    return spark.createDataFrame(rows, "path string, present boolean, non_empty boolean")


UNEXPECTED_SCHEMA = "run_id string, column string, value string, count long"


def write_findings(spark: SparkSession, report: GateReport, root: str) -> None:
    """Findings, every undeclared value with its count, and last the report row, below ``root``.

    All are keyed by run id and carry the attempt that wrote them. The report row
    commits: readers take the rows of its attempt only, so a run that is written
    again, or whose writing broke off, never shows rows of another attempt. The
    undeclared values are written from the executors, however many there are.
    """
    attempt = F.lit(uuid.uuid4().hex).alias("attempt")
    write_keyed(report.findings_df(spark).select("*", attempt), f"{root}/findings")
    if report.unexpected is not None:
        values = report.unexpected.select(F.lit(report.run_id).alias("run_id"), "column", "value", "count", attempt)
        write_keyed(values, f"{root}/unexpected")
    write_keyed(report.report_df(spark).select("*", attempt), f"{root}/reports")


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{REPORT_SCHEMA}, attempt string").parquet(f"{root}/reports")


def _committed(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    names = T.StructType.fromDDL(schema).names
    try:
        rows = spark.read.schema(f"{schema}, attempt string").parquet(f"{root}/{table}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.join(read_reports(spark, root).select("run_id", "attempt"), ["run_id", "attempt"], "left_semi").select(*names)


def read_findings(spark: SparkSession, root: str) -> DataFrame:
    """The findings of every run, as ``GateReport.findings_df`` has them."""
    return _committed(spark, root, "findings", FINDINGS_SCHEMA)


def read_unexpected(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, column, value, count): all undeclared values of every run."""
    return _committed(spark, root, "unexpected", UNEXPECTED_SCHEMA)


def write_contract(spark: SparkSession, contract, root: str) -> str:
    """The contract document under ``root/<dataset>/<version>``; returns the path."""
    from quaystone.sources.tables import write_text
    path = f"{root}/{contract.dataset_name}/{contract.contract_version}"
    write_text(spark, contract.to_json(), path)
    return path


@dataclass
class ReplayResult:
    contract_fingerprint: str
    findings: list
    winner: str | None
    cv: list


def replay(raw: DataFrame, cleaning_plan, draft, feature_plan=None, experiment_plan=None, *, key: str,
           order_by=None, run_id: str = "replay", fault=None) -> ReplayResult:
    """The deterministic chain from stored plans: clean → contract → (fault)
    → gate → features/CV when the gate passes. Same inputs → same
    fingerprint, findings and metrics."""
    from quaystone.operators.clean import execute_plan
    from quaystone.operators.gate import run_gate
    from quaystone.operators.measure import build_contract
    from quaystone.operators.train import run_experiments
    checkpoint_dir(raw.sparkSession)
    clean_df = execute_plan(raw, cleaning_plan, order_by=order_by).checkpoint(eager=True)
    contract = build_contract(draft, clean_df, contract_version="replay", run_id=run_id, created_by="replay",
                              dataset_name="replay", created_at="1970-01-01T00:00:00Z")
    candidate = fault(clean_df) if fault else clean_df
    report = run_gate(candidate, contract, run_id=run_id)
    winner, cv = None, []
    if report.passed and feature_plan is not None and experiment_plan is not None:
        res = run_experiments(candidate, feature_plan, experiment_plan, key)
        winner = res.winner
        cv = sorted((r["variant"], r["metric"], r["split"], r["value"]) for r in res.experiments.collect())
    return ReplayResult(contract.integrity.fingerprint,
                        sorted((f.check_id, f.severity, f.column) for f in report.findings), winner, cv)


def write_plans(spark: SparkSession, run_id: str, plans: list, path: str) -> None:
    """Store the plans of a run (cleaning, contract draft, feature, experiment); written again, they are replaced."""
    write_keyed(plans_table(spark, run_id, plans), path)


def replay_stored(raw: DataFrame, plans_path: str, plans_run: str, *, key: str, order_by=None, run_id: str = "replay",
                  fault=None) -> ReplayResult:
    """``replay`` from the plan table: the plans are read, checked against their fingerprints and parsed.

    A run without a cleaning plan or contract draft can't be replayed; without a
    feature or an experiment plan the replay ends at the gate.
    """
    plans = stored_plans(raw.sparkSession.read.schema(PLANS_SCHEMA).parquet(plans_path), plans_run)
    lacking = sorted({"cleaning", "contract"} - set(plans))
    if lacking:
        raise StoredPlanError(f"run {plans_run!r} has no stored plan for: {lacking}")
    return replay(raw, plans["cleaning"], plans["contract"], plans.get("feature"), plans.get("experiment"), key=key,
                  order_by=order_by, run_id=run_id, fault=fault)
