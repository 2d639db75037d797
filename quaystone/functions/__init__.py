"""Reusable column expressions, exact distributed quantiles, fingerprints and
ordered row indexes."""

from quaystone.functions.columns import (  # noqa: F401
    BLANK_TEXT,
    NA_TOKENS,
    NUMERIC_TEXT,
    dtype_family,
    dtype_name,
    field_types,
    is_blank,
    is_numeric_type,
    is_text_type,
    na_tokens_to_null,
    nan_to_null,
    numeric_or_null,
    safe_ratio,
    truthy,
    value_text,
)
