"""Contract drafts for the bundled TPC-H-style tables (used by the registered
queries, the bench and the tests). Each is a plain declaration: what is
enforced and why; nothing here is measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.plans.contract import ContractDraft


def lineitem_draft() -> ContractDraft:
    return ContractDraft.model_validate({
        "target": {
            "name": "l_linestatus",
            "dtype": {"expected": "str", "justification": "status flag text"},
            "closed_domain": {"values": ["F", "O"], "justification": "two line states by definition"},
            "nullable": {"value": False, "justification": "every line has a state"},
        },
        "columns": [
            {"name": "l_orderkey", "semantic_type": "identifier",
             "dtype": {"expected": "int64", "justification": "surrogate key"},
             "nullable": {"value": False, "justification": "a line belongs to an order"}},
            {"name": "l_partkey", "semantic_type": "identifier",
             "nullable": {"value": False, "justification": "a line names a part"}},
            {"name": "l_suppkey", "semantic_type": "identifier",
             "nullable": {"value": False, "justification": "a line names a supplier"}},
            {"name": "l_linenumber", "semantic_type": "numeric",
             "dtype": {"expected": "int32", "justification": "line position within an order"},
             "nullable": {"value": False, "justification": "part of the line key"}},
            {"name": "l_quantity", "semantic_type": "numeric",
             "nullable": {"value": False, "justification": "quantity always recorded"},
             "business_range": {"min": 0, "justification": "quantities are not negative"}},
            {"name": "l_extendedprice", "semantic_type": "monetary",
             "dtype": {"expected": "float64", "justification": "price in currency units"},
             "nullable": {"value": False, "justification": "price always recorded"},
             "unit": {"value": "currency", "evidence": "extended price = quantity x part price"},
             "business_range": {"min": 0, "justification": "prices are not negative"},
             "scale_drift": {"median_rel_tolerance": 0.25,
                             "justification": "a unit change would move the median by orders of magnitude"}},
            {"name": "l_discount", "semantic_type": "numeric",
             "nullable": {"value": False, "justification": "discount always recorded"},
             "business_range": {"min": 0, "max": 1, "justification": "a discount is a fraction"}},
            {"name": "l_tax", "semantic_type": "numeric",
             "nullable": {"value": False, "justification": "tax always recorded"},
             "business_range": {"min": 0, "max": 1, "justification": "a tax rate is a fraction"}},
            {"name": "l_returnflag", "semantic_type": "categorical",
             "nullable": {"value": False, "justification": "flag always set"},
             "closed_domain": {"values": ["A", "N", "R"], "justification": "three return states"}},
            {"name": "l_shipdate", "semantic_type": "temporal",
             "nullable": {"value": False, "justification": "ship date always recorded"}},
        ],
        "required_features": ["l_quantity", "l_extendedprice", "l_returnflag"],
        "excluded_features": [
            {"name": "l_orderkey", "exclusion_type": "identifier", "enforcement": "hard",
             "justification": "a key carries no generalisable signal"},
        ],
        "primary_key": {"columns": ["l_orderkey", "l_linenumber"],
                        "unique": {"value": True, "justification": "one row per order line"}},
        "assumptions": ["prices are in one currency"],
    })


def orders_draft() -> ContractDraft:
    return ContractDraft.model_validate({
        "target": {
            "name": "o_orderstatus",
            "dtype": {"expected": "str", "justification": "status text"},
            "closed_domain": {"values": ["F", "O", "P"], "justification": "three order states"},
            "nullable": {"value": False, "justification": "every order has a state"},
        },
        "columns": [
            {"name": "o_orderkey", "semantic_type": "identifier",
             "nullable": {"value": False, "justification": "key"}},
            {"name": "o_custkey", "semantic_type": "identifier",
             "nullable": {"value": False, "justification": "an order has a customer"}},
            {"name": "o_totalprice", "semantic_type": "monetary",
             "dtype": {"expected": "float64", "justification": "currency amount"},
             "nullable": {"value": False, "justification": "always priced"},
             "business_range": {"min": 0, "justification": "prices are not negative"},
             "scale_drift": {"median_rel_tolerance": 0.25, "justification": "unit changes must be caught"}},
            {"name": "o_orderdate", "semantic_type": "temporal",
             "nullable": {"value": False, "justification": "always dated"}},
            {"name": "o_orderpriority", "semantic_type": "categorical",
             "nullable": {"value": False, "justification": "always prioritised"},
             "closed_domain": {"values": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
                               "justification": "five priority levels"}},
        ],
        "required_features": ["o_totalprice", "o_orderpriority"],
        "excluded_features": [
            {"name": "o_orderkey", "exclusion_type": "identifier", "enforcement": "hard",
             "justification": "key"},
        ],
        "primary_key": {"columns": ["o_orderkey"],
                        "unique": {"value": True, "justification": "one row per order"}},
    })


def churn_like(documents: DataFrame, labels: DataFrame, target: str = "toxic") -> DataFrame:
    """documents ⋈ labels: a binary-target modelling table (text dropped)."""
    return (documents.select("doc_id", "lang", "source", "n_chars")
            .join(labels.select("doc_id", "quality", "toxic"), "doc_id")
            .select("doc_id", "lang", "source", "n_chars", "quality",
                    F.col(target).cast("bigint").alias(target)))


def churn_like_draft(target: str = "toxic") -> ContractDraft:
    other = "quality" if target == "toxic" else "toxic"
    return ContractDraft.model_validate({
        "target": {
            "name": target,
            "dtype": {"expected": "int64", "justification": "binary label"},
            "closed_domain": {"values": ["0", "1"], "justification": "binary label"},
            "nullable": {"value": False, "justification": "a row without a label is unusable"},
            "drift": {"positive_rate_tolerance_abs": 0.05, "justification": "label balance must hold"},
        },
        "columns": [
            {"name": "doc_id", "semantic_type": "identifier",
             "nullable": {"value": False, "justification": "key"}},
            {"name": "lang", "semantic_type": "categorical",
             "nullable": {"value": False, "justification": "always detected"},
             "closed_domain": {"values": ["de", "en", "es", "fr"], "justification": "four languages"}},
            {"name": "source", "semantic_type": "categorical",
             "nullable": {"value": False, "justification": "always known"}},
            {"name": "n_chars", "semantic_type": "numeric",
             "dtype": {"expected": "int64", "justification": "character count"},
             "nullable": {"value": False, "justification": "always measured"},
             "business_range": {"min": 0, "justification": "a length is not negative"},
             "scale_drift": {"median_rel_tolerance": 0.25, "justification": "unit changes must be caught"}},
            {"name": other, "semantic_type": "binary",
             "nullable": {"value": False, "justification": "second label"}},
        ],
        "required_features": ["lang", "n_chars"],
        "excluded_features": [
            {"name": "doc_id", "exclusion_type": "identifier", "enforcement": "hard",
             "justification": "a key carries no signal"},
            {"name": other, "exclusion_type": "target_leakage", "enforcement": "advisory",
             "justification": "labelled in the same pass as the target"},
        ],
        "primary_key": {"columns": ["doc_id"],
                        "unique": {"value": True, "justification": "one row per document"}},
    })
