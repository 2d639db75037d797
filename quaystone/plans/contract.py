"""Contract documents: the draft (declarations only) and the contract
(declarations + measured facts).

``observed`` is what was measured; ``constraints`` is what is enforced, each
with a stated reason. A missing constraint means *no check*: nothing is
ever inferred from a measurement. These are small driver-side documents;
measuring and checking happen in Spark (``operators.measure``, ``operators.gate``).

Every rule is built by ``_rule`` from its own fields and the one text type that
may not be blank; what documents say about each other's names is checked in one
pass by ``naming_problems``.
"""

from __future__ import annotations

from collections import Counter
from enum import Enum
from typing import Annotated, Any, Literal, Optional

from pydantic import BaseModel, ConfigDict, Field, StringConstraints, create_model, model_validator

# A reason must say something; surrounding space is dropped.
Reason = Annotated[str, StringConstraints(strip_whitespace=True, min_length=1)]
Count = Annotated[int, Field(ge=0)]
Share = Annotated[float, Field(ge=0, le=1)]
Tolerance = Annotated[float, Field(gt=0, le=1)]
Digest = Annotated[str, StringConstraints(pattern=r"^((rows|files)-v1:)?[0-9a-f]{64}$")]


def _choice(name: str, *values: str) -> type[Enum]:
    return Enum(name, {v.upper(): v for v in values}, type=str, module=__name__)


# The closed vocabularies of the document format.
ExclusionType = _choice("ExclusionType", "identifier", "target_leakage", "redundancy_collinearity", "modeling_simplicity",
                        "ethical_sensitive")
Enforcement = _choice("Enforcement", "hard", "advisory")
Severity = _choice("Severity", "ERROR", "WARN")
SemanticType = _choice("SemanticType", "identifier", "monetary", "categorical", "binary", "numeric", "temporal", "text", "other")
# The factors by which a unit change moves a median.
DEFAULT_RATIO_HINTS = [0.001, 0.01, 0.1, 10, 100, 1000]


class _Document(BaseModel):
    """Unknown keys are refused everywhere."""
    model_config = ConfigDict(extra="forbid")


def _rule(title: str, /, *, why: str = "justification", base: type[BaseModel] = _Document, **fields: Any) -> type[BaseModel]:
    """A constraint: its own fields (type, or (type, default)) and why it holds."""
    shape = {k: v if isinstance(v, tuple) else (v, ...) for k, v in fields.items()}
    return create_model(title, __base__=base, __module__=__name__, **shape, **{why: (Reason, ...)})


class _Interval(_Document):
    min: Optional[float] = None
    max: Optional[float] = None

    @model_validator(mode="after")
    def _bounded(self):
        given = [b for b in (self.min, self.max) if b is not None]
        if not given:
            raise ValueError("a range without bounds checks nothing")
        if given != sorted(given):
            raise ValueError("the lower bound lies above the upper one")
        return self


Dtype = _rule("Dtype", expected=str)
Nullable = _rule("Nullable", value=bool)
Unit = _rule("Unit", why="evidence", value=str, confidence=(Optional[Literal["high", "medium", "low"]], None))
Range = _rule("Range", base=_Interval)
Domain = _rule("Domain", values=Annotated[list[Annotated[str, Field(coerce_numbers_to_str=True)]], Field(min_length=1)],
               severity=(Severity, Severity.ERROR))
MedianDrift = _rule("MedianDrift", median_rel_tolerance=Tolerance, severity=(Severity, Severity.ERROR))
Unique = _rule("Unique", value=bool)
RateDrift = _rule("RateDrift", positive_rate_tolerance_abs=Tolerance)
Exclusion = _rule("Exclusion", name=str, exclusion_type=ExclusionType, enforcement=Enforcement)


class ColumnConstraints(_Document):
    dtype: Optional[Dtype] = None
    nullable: Optional[Nullable] = None
    unit: Optional[Unit] = None
    business_range: Optional[Range] = None
    closed_domain: Optional[Domain] = None
    scale_drift: Optional[MedianDrift] = None


class TargetConstraints(_Document):
    dtype: Optional[Dtype] = None
    closed_domain: Optional[Domain] = None
    nullable: Optional[Nullable] = None


class ColumnDraft(ColumnConstraints):
    name: str
    semantic_type: SemanticType = SemanticType.OTHER
    nullable: Nullable  # a draft says for every column whether it may be null


Task = Literal["binary_classification"]


class TargetDraft(_Document):
    name: str
    task_type: Task = "binary_classification"
    dtype: Dtype
    closed_domain: Domain
    nullable: Nullable
    drift: Optional[RateDrift] = None


class KeyDraft(_Document):
    columns: list[str]
    unique: Unique


def naming_problems(names: list[str], target: str, required: list[str], excluded: list, key: list[str],
                    order: list[str] | None = None) -> list[str]:
    """Everything wrong with what a document says about column names."""
    known = set(names)
    refused = {e.name for e in excluded if e.enforcement == Enforcement.HARD}
    found = {
        "columns declared more than once": {n for n, c in Counter(names).items() if c > 1},
        "the target is declared as a column too": known & {target},
        "required but never declared": set(required) - known,
        "excluded but never declared": {e.name for e in excluded} - known,
        "required and hard-excluded at once": refused & set(required),
        "in the key but never declared": set(key) - known - {target},
        "in column_order or declared, but not both": set() if order is None else set(order) ^ (known | {target}),
    }
    return [f"{what}: {sorted(which)}" for what, which in found.items() if which]


class _Named(_Document):
    """Shared by draft and contract: the names agree with each other."""

    @model_validator(mode="after")
    def _names_agree(self):
        integrity = getattr(self, "integrity", None)
        wrong = naming_problems([c.name for c in self.columns], self.target.name, self.required_features,
                                self.excluded_features, self.primary_key.columns, integrity and integrity.column_order)
        if wrong:
            raise ValueError("; ".join(wrong))
        return self


class ContractDraft(_Named):
    target: TargetDraft
    columns: list[ColumnDraft]
    required_features: list[str] = Field(default_factory=list)
    excluded_features: list[Exclusion] = Field(default_factory=list)
    primary_key: KeyDraft
    assumptions: list[str] = Field(default_factory=list)


class ColumnObserved(_Document):
    dtype: str
    null_count: Count
    unique_count: Count
    min: Optional[float] = None
    max: Optional[float] = None
    mean: Optional[float] = None
    median: Optional[float] = None
    p05: Optional[float] = None
    p95: Optional[float] = None
    std: Optional[float] = None
    decimal_places_max: Optional[Count] = None
    value_distribution: Optional[dict[str, float]] = None


class TargetObserved(_Document):
    positive_rate: Share
    class_counts: dict[str, int]


class ColumnContract(_Document):
    name: str
    semantic_type: SemanticType
    observed: ColumnObserved
    constraints: ColumnConstraints


class TargetContract(_Document):
    name: str
    task_type: Task = "binary_classification"
    constraints: TargetConstraints
    observed: TargetObserved
    drift: Optional[RateDrift] = None


class KeyConstraints(_Document):
    unique: Unique


class Key(_Document):
    columns: list[str]
    constraints: KeyConstraints


class Integrity(_Document):
    fingerprint: Digest
    row_count: Count
    column_count: Count
    column_order: list[str]

    @model_validator(mode="after")
    def _counted(self):
        if not len(set(self.column_order)) == len(self.column_order) == self.column_count:
            raise ValueError("column_order must name column_count different columns")
        return self


class ValidationPolicy(_Document):
    on_unknown_column: Literal["warn", "error", "ignore"] = "warn"
    on_missing_column: Literal["warn", "error"] = "error"
    on_integrity_mismatch: Literal["warn", "error"] = "error"
    scale_change_ratio_hints: list[float] = Field(default_factory=DEFAULT_RATIO_HINTS.copy)


class DatasetContract(_Named):
    contract_version: str
    created_at: str
    created_by: str
    run_id: str
    dataset_name: str
    source_documentation_url: str = ""
    target: TargetContract
    required_features: list[str] = Field(default_factory=list)
    excluded_features: list[Exclusion] = Field(default_factory=list)
    primary_key: Key
    columns: list[ColumnContract]
    integrity: Integrity
    assumptions: list[str] = Field(default_factory=list)
    validation_policy: ValidationPolicy = Field(default_factory=ValidationPolicy)

    def column(self, name: str) -> ColumnContract:
        return {c.name: c for c in self.columns}[name]

    def to_json(self) -> str:
        return self.model_dump_json(indent=2)

    @classmethod
    def from_json(cls, text: str) -> DatasetContract:
        return cls.model_validate_json(text)
