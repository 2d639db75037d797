"""Plans as rows: every plan of a run as a JSON document with its fingerprint, to be replayed later.

A plan table has a row per plan: ``run_id``, ``kind`` (cleaning, contract, feature,
experiment), ``fingerprint`` (SHA-256 of the document) and ``document``. Documents
are written in one canonical form, so equal plans have equal fingerprints.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.plans.cleaning import CleaningPlan
from quaystone.plans.contract import ContractDraft
from quaystone.plans.modeling import ExperimentPlan, FeaturePlan, Ratio, Variant

PLANS_SCHEMA = "run_id string, kind string, fingerprint string, document string"


class StoredPlanError(ValueError):
    pass


def _canonical(value) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def _feature(document: dict) -> FeaturePlan:
    return FeaturePlan(**document | {"derived": [Ratio(**d) for d in document["derived"]]})


def _experiment(document: dict) -> ExperimentPlan:
    return ExperimentPlan(**document | {"variants": [Variant(**v) for v in document["variants"]]})


# kind -> (class, to a JSON value, from a JSON value)
KINDS = {
    "cleaning": (CleaningPlan, lambda p: json.loads(p.to_json()), lambda d: CleaningPlan.from_json(json.dumps(d))),
    "contract": (ContractDraft, lambda p: p.model_dump(mode="json"), ContractDraft.model_validate),
    "feature": (FeaturePlan, asdict, _feature),
    "experiment": (ExperimentPlan, asdict, _experiment),
}


def plan_document(plan) -> tuple[str, str]:
    """(kind, canonical document) of a plan."""
    for kind, (cls, write, _) in KINDS.items():
        if isinstance(plan, cls):
            return kind, _canonical(write(plan))
    raise StoredPlanError(f"{type(plan).__name__} is no plan")


def plan_fingerprint(plan) -> str:
    return hashlib.sha256(plan_document(plan)[1].encode()).hexdigest()


def parse_plan(kind: str, document: str):
    """The plan that a document stands for."""
    if kind not in KINDS:
        raise StoredPlanError(f"unknown kind of plan {kind!r}; known: {sorted(KINDS)}")
    try:
        return KINDS[kind][2](json.loads(document))
    except (ValueError, TypeError, KeyError) as exc:
        raise StoredPlanError(f"the stored {kind} plan can't be read: {exc}") from exc


def plans_table(spark: SparkSession, run_id: str, plans: list) -> DataFrame:
    """A row per plan."""
    rows = [(run_id, *plan_document(p)) for p in plans]
    return spark.createDataFrame([(r, kind, hashlib.sha256(d.encode()).hexdigest(), d) for r, kind, d in rows], PLANS_SCHEMA)


def stored_plans(table: DataFrame, run_id: str) -> dict:
    """kind -> plan of one run; a document that does not match its fingerprint, or a kind stored twice, is an error."""
    rows = table.where(F.col("run_id") == run_id).collect()  # a row a plan
    out: dict = {}
    for r in rows:
        if hashlib.sha256(r["document"].encode()).hexdigest() != r["fingerprint"]:
            raise StoredPlanError(f"the {r['kind']} plan of run {run_id!r} is not the one that was stored")
        if r["kind"] in out:
            raise StoredPlanError(f"run {run_id!r} has more than one {r['kind']} plan")
        out[r["kind"]] = parse_plan(r["kind"], r["document"])
    return out
