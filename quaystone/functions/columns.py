"""Column-level expressions shared by every stage.

All helpers return ``pyspark.sql.Column`` expressions built from built-in
functions, so they stay inside whole-stage codegen (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values — missing-value tokens that a header CSV read must turn into
# NULL (the usual pandas default set). A blank or whitespace-only cell is NOT
# in the set: it survives as text.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Text a plain decimal or scientific number may take; anything else is not
# numeric (Spark alone would also accept '1d' or '1f').
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Unicode-aware "empty after strip()" test.
BLANK_TEXT = r"(?U)^\s*$"


# ---------------------------------------------------------------------------
# dtype names and families
# ---------------------------------------------------------------------------

def dtype_name(dt: T.DataType) -> str:
    """A stable dtype label for a Spark type, in the vocabulary contracts use."""
    if isinstance(dt, T.LongType):
        return "int64"
    if isinstance(dt, T.IntegerType):
        return "int32"
    if isinstance(dt, T.ShortType):
        return "int16"
    if isinstance(dt, T.ByteType):
        return "int8"
    if isinstance(dt, T.DoubleType):
        return "float64"
    if isinstance(dt, T.FloatType):
        return "float32"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, T.StringType):
        return "str"
    return dt.simpleString()


# Fixed values — the four compatible dtype families; any other name is its
# own family.
_FAMILIES = {
    "integer": {"int8", "int16", "int32", "int64", "Int8", "Int16", "Int32", "Int64",
                "uint8", "uint16", "uint32", "uint64", "tinyint", "smallint", "int",
                "bigint"},
    "floating": {"float16", "float32", "float64", "Float32", "Float64", "float", "double"},
    "boolean": {"bool", "boolean"},
    "text": {"object", "str", "string"},
}


def dtype_family(name: str) -> str:
    name = name.strip()
    for family, members in _FAMILIES.items():
        if name in members:
            return family
    return name


def is_numeric_type(dt: T.DataType) -> bool:
    """Numeric and not boolean (booleans are never treated as numbers)."""
    return isinstance(dt, T.NumericType)


def is_text_type(dt: T.DataType) -> bool:
    return isinstance(dt, T.StringType)


def field_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


# ---------------------------------------------------------------------------
# null model
# ---------------------------------------------------------------------------

def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN → NULL on every float/double column, once, at scan time."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).cast(f.dataType).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def na_tokens_to_null(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Missing-value tokens in text columns → NULL (blank text is kept)."""
    tokens = NA_TOKENS if tokens is None else tokens
    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            exprs.append(F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c).alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


# ---------------------------------------------------------------------------
# value coercions
# ---------------------------------------------------------------------------

def numeric_or_null(col: str, dt: T.DataType) -> Column:
    """A double view of a column: numbers as is, numeric text parsed, anything
    else NULL (the "coerce" rule of the range and drift checks)."""
    c = F.col(col)
    if isinstance(dt, T.BooleanType):
        return c.cast("int").cast("double")
    if is_numeric_type(dt):
        d = c.cast("double")
        return F.nanvl(d, F.lit(None).cast("double"))
    if isinstance(dt, T.StringType):
        parsed = F.when(c.rlike(NUMERIC_TEXT), F.trim(c).try_cast("double"))
        return F.nanvl(parsed, F.lit(None).cast("double"))
    return F.lit(None).cast("double")


def value_text(col: str | Column, dt: T.DataType) -> Column:
    """Text form of a value as a Python ``str(value)`` prints it: integers
    plainly, doubles with all the digits that tell them apart, a ``.0`` when
    integral, in fixed notation from 1e-4 up to 1e16 and as ``1.5e-05`` beyond,
    booleans as ``True``/``False``."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dt, T.BooleanType):
        return F.when(c.isNull(), F.lit(None).cast("string")).when(c, F.lit("True")).otherwise(F.lit("False"))
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        # the engine's own text has the round-trip digits, but writes 1.5E-5 and 1.23E7
        s, size = c.cast("string"), F.abs(c.cast("double"))
        power = F.regexp_extract(s, r"E(-?\d+)$", 1).try_cast("int")
        digits = F.regexp_replace(F.regexp_extract(s, r"^(.*)E", 1), r"\.0$", "")
        sign = F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+"))
        far = F.concat(digits, sign, F.format_string("%02d", F.abs(power)))
        moved = F.regexp_replace(F.regexp_replace(s.try_cast("decimal(38,21)").cast("string"), "0+$", ""), r"\.$", ".0")
        return F.when(power.isNull(), s).when((size >= F.lit(1e-4)) & (size < F.lit(1e16)), moved).otherwise(far)
    return c.cast("string")


def is_blank(col: str) -> Column:
    """Non-null text that is empty or whitespace only."""
    c = F.col(col)
    return c.isNotNull() & c.rlike(BLANK_TEXT)


def truthy(col: str, dt: T.DataType) -> Column:
    """Python truthiness as a boolean column: numbers ≠ 0, non-empty text
    (so the text 'False' is true). NULL stays NULL."""
    c = F.col(col)
    if isinstance(dt, T.BooleanType):
        return c
    if is_numeric_type(dt):
        return c != F.lit(0)
    return F.length(c.cast("string")) > F.lit(0)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den with zero denominators replaced by 1 (NULL stays NULL)."""
    return num.cast("double") / F.when(den == F.lit(0), F.lit(1.0)).otherwise(den.cast("double"))
