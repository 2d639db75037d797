"""Feature and experiment plans (closed vocabularies) and their argument rules."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Literal

from quaystone.plans.contract import DatasetContract, Enforcement

TransformKind = Literal["log1p", "standard_scale", "minmax_scale"]
EncoderKind = Literal["onehot", "ordinal"]
EstimatorKind = Literal["logistic_regression", "random_forest", "gradient_boosting"]

# What a plan may set for each estimator: (kind, least, most) or (kind, choices).
# The forest's depth ends at 30, the deepest tree that Spark ML grows; a deeper plan is refused.
ALLOWED_PARAMS = {
    "logistic_regression": {"C": (float, 0.0, 100.0), "max_iter": (int, 10, 10000), "class_weight": (str, ("balanced",))},
    "random_forest": {"n_estimators": (int, 10, 1000), "max_depth": (int, 1, 30), "min_samples_leaf": (int, 1, 100),
                      "class_weight": (str, ("balanced", "balanced_subsample"))},
    "gradient_boosting": {"n_estimators": (int, 10, 1000), "learning_rate": (float, 0.0001, 1.0), "max_depth": (int, 1, 10)},
}
FORBIDDEN_PARAMS = {"random_state", "n_jobs", "verbose"}
MIN_FOLDS, MAX_FOLDS = 2, 10
PRIMARY_METRICS = ("roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy")


@dataclass(frozen=True)
class Ratio:
    name: str
    numerator: str
    denominator: str


@dataclass
class FeaturePlan:
    target: str
    use_features: list[str]
    derived: list[Ratio] = field(default_factory=list)
    transforms: dict[str, TransformKind] = field(default_factory=dict)
    encoders: dict[str, EncoderKind] = field(default_factory=dict)
    advisory_overrides: dict[str, str] = field(default_factory=dict)  # column → justification

    def feature_names(self) -> list[str]:
        return list(self.use_features) + [d.name for d in self.derived]


def check_feature_plan(plan: FeaturePlan, contract: DatasetContract) -> list[str]:
    errors: list[str] = []
    declared = {c.name for c in contract.columns}
    hard = {e.name for e in contract.excluded_features if e.enforcement == Enforcement.HARD}
    advisory = {e.name for e in contract.excluded_features if e.enforcement == Enforcement.ADVISORY}
    if plan.target != contract.target.name:
        errors.append(f"target {plan.target!r} is not the contract's target {contract.target.name!r}")
    for f in plan.use_features:
        if f == contract.target.name:
            errors.append("the target cannot be a feature")
        elif f not in declared:
            errors.append(f"feature {f!r} is not declared in the contract")
        elif f in hard:
            errors.append(f"feature {f!r} is hard-excluded")
        elif f in advisory and not str(plan.advisory_overrides.get(f, "")).strip():
            errors.append(f"feature {f!r} is advisory-excluded; a justified override is required")
    for name in plan.advisory_overrides:
        if name not in advisory:
            errors.append(f"override names {name!r}, which is not advisory-excluded")
    missing = [r for r in contract.required_features if r not in plan.use_features]
    if missing:
        errors.append(f"required features missing from the plan: {missing}")
    known = set(plan.use_features)
    for d in plan.derived:
        for part in (d.numerator, d.denominator):
            if part not in known:
                errors.append(f"derived {d.name!r} refers to unknown feature {part!r}")
        known.add(d.name)
    for col in list(plan.transforms) + list(plan.encoders):
        if col not in known:
            errors.append(f"transform/encoder names unknown feature {col!r}")
    return errors


@dataclass(frozen=True)
class Variant:
    name: str
    estimator: EstimatorKind
    params: dict = field(default_factory=dict)


@dataclass
class ExperimentPlan:
    variants: list[Variant]
    cv_folds: int = 5
    primary_metric: str = "roc_auc"


def check_experiment_plan(plan: ExperimentPlan) -> list[str]:
    errors: list[str] = []
    if len(plan.variants) < 2:
        errors.append("at least two variants are required")
    names = [v.name for v in plan.variants]
    if len(set(names)) != len(names):
        errors.append("variant names must be unique")
    if not MIN_FOLDS <= plan.cv_folds <= MAX_FOLDS:
        errors.append(f"cv_folds must be within {MIN_FOLDS}..{MAX_FOLDS}")
    if plan.primary_metric not in PRIMARY_METRICS:
        errors.append(f"unknown primary metric {plan.primary_metric!r}")
    for v in plan.variants:
        if v.estimator not in ALLOWED_PARAMS:
            errors.append(f"{v.name}: unknown estimator {v.estimator!r}")
            continue
        errors += [f"{v.name}: {problem}" for k, val in v.params.items() if (problem := _param_problem(v.estimator, k, val))]
    return errors


def _param_problem(estimator: str, name: str, value) -> str | None:
    if name in FORBIDDEN_PARAMS:
        return f"parameter {name!r} may not be set by a plan"
    if name not in ALLOWED_PARAMS[estimator]:
        return f"parameter {name!r} is not allowed for {estimator}"
    kind, *limits = ALLOWED_PARAMS[estimator][name]
    if value is None and (kind is str or name == "max_depth"):
        return None  # unset
    if isinstance(value, bool) or not isinstance(value, (int, float) if kind is float else kind):
        return f"parameter {name!r} has the wrong type"
    if kind is str:
        return None if value in limits[0] else f"parameter {name!r} must be one of {limits[0]}"
    least, most = limits
    inside = least <= value <= most and not (name == "C" and value <= 0)
    return None if inside else f"parameter {name!r} must lie within {least}..{most}"
