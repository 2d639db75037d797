"""Contract measurement: draft + table → contract with measured facts.

Constraints are copied from the draft unchanged; every ``observed`` number
and the integrity block come from Spark aggregates over the table (a fixed
number of jobs for any column count — see ``operators.stats``).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.functions.columns import is_numeric_type, value_text
from quaystone.functions.fingerprint import fingerprint_aggs, fingerprint_from_row
from quaystone.functions.staging import staged
from quaystone.operators.stats import low_card_value_counts, measure
from quaystone.plans.contract import ContractDraft, DatasetContract, ValidationPolicy

# Fixed value — value distributions are recorded only up to this many
# distinct values.
MAX_DISTRIBUTION_CARDINALITY = 50

class ContractBuildError(ValueError):
    """The draft and the table cannot be reconciled."""


def target_class_counts(df: DataFrame, target: str) -> DataFrame:
    """(value, count) of the target including NULL (rendered as 'null')."""
    dt = df.schema[target].dataType
    return (df.groupBy(F.coalesce(value_text(target, dt), F.lit("null")).alias("value"))
            .agg(F.count(F.lit(1)).alias("count")))


def measure_positive_rate(df: DataFrame, target: str, domain_values: list[str] | None) -> float:
    """Positive share with NULLs in the denominator: a numeric target counts
    rows equal to its maximum; a text target counts rows equal to the last
    declared domain value."""
    t = F.col(target)
    label = domain_values[-1] if domain_values else None
    if is_numeric_type(df.schema[target].dataType):
        # count per value first (partial aggregation keeps this a tiny
        # shuffle), then read the count at the maximum
        grouped = df.groupBy(t.alias("v")).agg(F.count(F.lit(1)).alias("n"))
        row = grouped.agg(F.sum("n").alias("rows"), F.max("v").alias("mx"),
                          F.max_by("n", "v").alias("n_at_max")).collect()[0]
        rows = row["rows"] or 0
        if not rows or row["mx"] is None:
            return 0.0
        return float(row["n_at_max"]) / float(rows)
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(t.cast("string") == F.lit(label)).alias("pos")).collect()[0]
    return float(row["pos"]) / float(row["rows"]) if row["rows"] else 0.0


def target_facts(df: DataFrame, target: str, domain_values: list[str] | None) -> dict:
    """The target's observed block from ONE grouped query (partial aggregation
    first): counts by text value ('null' included) and the positive rate by the
    rule of ``measure_positive_rate``. The document lists every class, so a row
    a class comes to the driver."""
    dt = df.schema[target].dataType
    value = F.coalesce(value_text("v", dt), F.lit("null"))
    last = F.lit(domain_values[-1] if domain_values else None)
    classes = df.groupBy(F.col(target).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    if is_numeric_type(dt):
        positive = F.max_by("n", "v")
    else:
        positive = F.sum(F.when(F.col("v").cast("string") == last, F.col("n")))
    by_text = classes.groupBy(value.alias("value")).agg(F.sum("n").alias("n"))
    share = classes.agg((F.coalesce(positive, F.lit(0)) / F.sum("n")).alias("share"))
    rows = by_text.crossJoin(F.broadcast(share)).collect()  # one row on the right
    return {"class_counts": {r["value"]: int(r["n"]) for r in rows},
            "positive_rate": float(rows[0]["share"]) if rows else 0.0}


def coverage_gaps(draft: ContractDraft, columns: list[str]) -> list[str]:
    """What the draft and the table do not have in common."""
    drafted = {draft.target.name: "target"} | {c.name: "column" for c in draft.columns}
    gaps = [f"{kind} {name!r} is drafted, but the table has none" for name, kind in drafted.items() if name not in columns]
    return gaps + [f"table column {name!r} is not drafted" for name in columns if name not in drafted]


def build_contract(draft: ContractDraft, df: DataFrame, *, validation_policy: ValidationPolicy | None = None,
                   created_at: str | None = None, **header: str) -> DatasetContract:
    """Measure ``df`` and combine with the draft.

    ``header``: contract_version, run_id, created_by, dataset_name and, if there
    is one, source_documentation_url. The document is the draft's own dump with
    the measured facts put beside each declaration.
    """
    gaps = coverage_gaps(draft, df.columns)
    if gaps:
        raise ContractBuildError("; ".join(gaps))
    with staged(df) as data:  # a small input is kept between the few passes
        columns, integrity = measured_columns(data, [c for c in df.columns if c != draft.target.name])
        observed_target = target_facts(data, draft.target.name, draft.target.closed_domain.values)

    document = draft.model_dump(mode="json")
    rules = {c.pop("name"): c for c in document["columns"]}
    document["columns"] = [{"name": name, "semantic_type": rules[name].pop("semantic_type"), "observed": facts,
                            "constraints": rules[name]} for name, facts in columns.items()]
    target = document["target"]
    target["constraints"] = {k: target.pop(k) for k in ("dtype", "closed_domain", "nullable")}
    target["observed"] = observed_target
    key = document["primary_key"]
    key["constraints"] = {"unique": key.pop("unique")}
    stamp = created_at or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return DatasetContract.model_validate(
        header | document | {"created_at": stamp, "integrity": integrity,
                             "validation_policy": validation_policy or ValidationPolicy()})


def measured_columns(df: DataFrame, features: list[str]) -> tuple[dict[str, dict], dict]:
    """(observed block of every feature, in table order; integrity block)."""
    facts = measure(df, features, quantile_probs=(0.05, 0.5, 0.95), decimal_places=True, extra_aggs=_fp_aggs(df))
    shares: dict[str, dict[str, float]] = {}
    listed = low_card_value_counts(df, facts, MAX_DISTRIBUTION_CARDINALITY)
    if listed is not None:  # at most 50 rows per qualifying column
        for r in listed.orderBy("column", F.desc("count"), "value").collect():
            shares.setdefault(r["column"], {})[r["value"]] = r["count"] / facts.columns[r["column"]].non_null_count
    out = {}
    for name in features:
        f = facts.columns[name]
        out[name] = {"dtype": f.dtype, "null_count": f.null_count, "unique_count": f.unique_count or 0}
        if f.is_numeric:
            out[name] |= {k: getattr(f, k) for k in ("min", "max", "mean", "std")}
            out[name] |= {k: f.quantiles.get(q) for k, q in (("p05", 0.05), ("median", 0.5), ("p95", 0.95))}
            out[name]["decimal_places_max"] = f.decimal_places
        else:
            out[name]["value_distribution"] = shares.get(name)
    return out, {"fingerprint": fingerprint_from_row(df, facts.extra), "row_count": facts.row_count,
                 "column_count": len(df.columns), "column_order": list(df.columns)}


def _fp_aggs(df: DataFrame) -> dict:
    rows, total, xor = fingerprint_aggs(df)
    return {"_fp_rows": rows, "_fp_sum": total, "_fp_xor": xor}


def observed_table(contract: DatasetContract, spark) -> DataFrame:
    """The contract's observed block as a long DataFrame (one row per column)."""
    schema = T.StructType([
        T.StructField("column", T.StringType()), T.StructField("dtype", T.StringType()),
        T.StructField("null_count", T.LongType()), T.StructField("unique_count", T.LongType()),
        T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType()),
        T.StructField("mean", T.DoubleType()), T.StructField("median", T.DoubleType()),
        T.StructField("p05", T.DoubleType()), T.StructField("p95", T.DoubleType()),
        T.StructField("std", T.DoubleType()), T.StructField("decimal_places_max", T.LongType()),
    ])
    rows = [(c.name, c.observed.dtype, c.observed.null_count, c.observed.unique_count,
             c.observed.min, c.observed.max, c.observed.mean, c.observed.median,
             c.observed.p05, c.observed.p95, c.observed.std, c.observed.decimal_places_max)
            for c in contract.columns]
    return spark.createDataFrame(rows, schema)
