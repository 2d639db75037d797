"""The shared measurement engine behind profile, EDA and contract measurement.

Whatever the number of columns, measuring a table costs a fixed number of
distributed jobs:

* one scan with every per-column aggregate (counts, blanks, min/max/mean/std,
  decimal places) in a single ``agg``;
* one ``unpivot`` → ``groupBy(column, value).count()`` shuffle that yields
  exact distinct counts *and* the value counts of low-cardinality columns
  (map-side partial aggregation makes a hot value cost one row per task);
* the exact-quantile selection of ``functions.quantiles`` (2–3 small scans).

Results come back as one small record per column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.functions.columns import (
    dtype_name,
    is_blank,
    is_numeric_type,
    numeric_or_null,
    value_text,
)
from quaystone.functions.quantiles import exact_quantiles, first_pass_aggs
from quaystone.functions.staging import staged


EXACT_MEAN_TYPE = "decimal(38,10)"
# Non-numeric columns whose HyperLogLog estimate is at most this many
# distinct values get their (value, count) list from the exact distinct pass
# (bounded: twice the largest cardinality any caller lists), so no second
# value-count pass is needed for top values or value distributions.
VALUE_LIST_CANDIDATE_MAX = 100


@dataclass
class ColumnFacts:
    name: str
    dtype: str
    spark_type: T.DataType
    is_numeric: bool
    null_count: int
    non_null_count: int
    unique_count: int | None = None
    blank_count: int = 0
    min: float | None = None
    max: float | None = None
    mean: float | None = None
    std: float | None = None          # sample std, None when < 2 values
    std_pop: float | None = None
    quantiles: dict[float, float | None] = field(default_factory=dict)
    decimal_places: int | None = None
    value_counts: dict[str, int] | None = None   # only for low-cardinality non-numeric columns


@dataclass
class TableFacts:
    row_count: int
    columns: dict[str, ColumnFacts]
    order: list[str]
    extra: dict = field(default_factory=dict)


# Fractional parts up to this long are recognised by arithmetic, longer ones in the value's text.
PLACES_BY_ARITHMETIC = 8


def _decimal_places_expr(col: str, dt: T.DataType):
    """Longest fractional part actually present (fixed-notation values only,
    trailing zeros stripped).

    A double has at most p places when it is the double nearest to some whole
    number over 10**p, which one correctly rounded division tells exactly while
    the whole number is below 2**53. Only values beyond that are written out.
    """
    c = F.col(col)
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        d = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
        size = F.abs(d)
        fixed = (d == F.lit(0.0)) | ((size >= F.lit(1e-4)) & (size < F.lit(1e16)))
        frac = F.regexp_extract(value_text(d, T.DoubleType()), r"\.(\d+)$", 1)
        places = F.length(F.regexp_replace(frac, "0+$", ""))
        for p in range(PLACES_BY_ARITHMETIC, -1, -1):
            ten = F.lit(float(10 ** p))
            places = F.when((size < F.lit(2.0 ** 52 / 10 ** p)) & (F.rint(d * ten) / ten == d), F.lit(p)).otherwise(places)
        return F.max(F.when(fixed, places))
    if isinstance(dt, T.IntegralType):
        return F.max(F.when(c.isNotNull(), F.lit(0)))
    return F.lit(None).cast("int")


def measure(df: DataFrame, columns: list[str] | None = None, *,
            quantile_probs: tuple[float, ...] = (0.5,),
            distinct: bool = True, exact_distinct: bool = True,
            decimal_places: bool = False, extra_aggs: dict | None = None) -> TableFacts:
    """Measure ``columns`` (default: all) of ``df`` — see ``_measure``. A small
    input is kept between the passes (``functions.staging``)."""
    with staged(df) as data:
        return _measure(data, columns, quantile_probs=quantile_probs, distinct=distinct,
                        exact_distinct=exact_distinct, decimal_places=decimal_places, extra_aggs=extra_aggs)


def _measure(df: DataFrame, columns: list[str] | None = None, *,
            quantile_probs: tuple[float, ...] = (0.5,),
            distinct: bool = True, exact_distinct: bool = True,
            decimal_places: bool = False, extra_aggs: dict | None = None) -> TableFacts:
    """Measure ``columns`` (default: all) of ``df``.

    ``exact_distinct=False`` swaps the exact distinct pass for
    ``approx_count_distinct`` (no value counts then).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = list(df.columns) if columns is None else [c for c in columns if c in types]
    numeric = [c for c in columns if is_numeric_type(types[c])]

    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        dt = types[c]
        x = numeric_or_null(c, dt) if c in numeric else F.col(c)
        aggs.append(F.count(x).alias(f"nn{i}"))
        if isinstance(dt, T.StringType):
            aggs.append(F.count_if(is_blank(c)).alias(f"bl{i}"))
        if c in numeric:
            aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                     F.avg(x).alias(f"av{i}"), F.stddev_samp(x).alias(f"sd{i}"),
                     F.stddev_pop(x).alias(f"sp{i}")]
            if isinstance(dt, (T.DoubleType, T.FloatType)):
                # decimal-exact mean: summing in decimal makes the result
                # independent of summation order (falls back to the double
                # mean if any value does not fit decimal(38,10))
                d = x.try_cast(EXACT_MEAN_TYPE)
                aggs += [F.avg(d).cast("double").alias(f"ax{i}"), F.count(d).alias(f"ac{i}")]
            if decimal_places:
                aggs.append(_decimal_places_expr(c, dt).alias(f"dp{i}"))
        if distinct and not exact_distinct:
            aggs.append(F.approx_count_distinct(x).alias(f"ad{i}"))
        elif distinct and c not in numeric:
            aggs.append(F.approx_count_distinct(x).alias(f"hd{i}"))
    extra_aggs = dict(extra_aggs or {})
    q_exprs = {c: numeric_or_null(c, types[c]) for c in numeric}
    if numeric and quantile_probs:
        # the quantile selection's first pass rides along in this scan
        aggs += first_pass_aggs({f"_qs_q{i}": q_exprs[c] for i, c in enumerate(numeric)}, list(quantile_probs))
    row = df.agg(*aggs, *[e.alias(k) for k, e in extra_aggs.items()]).collect()[0]
    n = int(row["__rows"])

    facts: dict[str, ColumnFacts] = {}
    for i, c in enumerate(columns):
        dt = types[c]
        nn = int(row[f"nn{i}"])
        cf = ColumnFacts(name=c, dtype=dtype_name(dt), spark_type=dt, is_numeric=c in numeric,
                         null_count=n - nn, non_null_count=nn,
                         blank_count=int(row[f"bl{i}"]) if isinstance(dt, T.StringType) else 0)
        if c in numeric:
            cf.min, cf.max, cf.mean = row[f"mn{i}"], row[f"mx{i}"], row[f"av{i}"]
            if f"ax{i}" in row.asDict() and row[f"ac{i}"] == nn and nn > 0:
                cf.mean = row[f"ax{i}"]
            cf.std, cf.std_pop = row[f"sd{i}"], row[f"sp{i}"]
            if cf.std is not None and nn < 2:
                cf.std = None
            if decimal_places:
                dp = row[f"dp{i}"]
                cf.decimal_places = int(dp) if dp is not None else None
            cf.min = float(cf.min) if cf.min is not None else None
            cf.max = float(cf.max) if cf.max is not None else None
            cf.mean = float(cf.mean) if cf.mean is not None else None
        if distinct and not exact_distinct:
            cf.unique_count = int(row[f"ad{i}"])
        facts[c] = cf

    if distinct and exact_distinct and columns:
        listed = {c for i, c in enumerate(columns)
                  if c not in numeric and int(row[f"hd{i}"]) <= VALUE_LIST_CANDIDATE_MAX}
        got = {}
        for r in distinct_counts(df, columns, listed).collect():
            got[r["column"]] = int(r["u"])
            if r["column"] in listed:
                facts[r["column"]].value_counts = {v["value"]: int(v["count"]) for v in r["vals"]}
        for c in columns:
            facts[c].unique_count = got.get(c, 0)
            if c in listed and facts[c].value_counts is None:
                facts[c].value_counts = {}

    if numeric and quantile_probs:
        q = exact_quantiles(df, numeric, list(quantile_probs), exprs=q_exprs, first=row)
        for c in numeric:
            facts[c].quantiles = {p: q[(c, p)] for p in quantile_probs}

    extra = {k: row[k] for k in extra_aggs}
    return TableFacts(row_count=n, columns=facts, order=columns, extra=extra)


def low_card_value_counts(df: DataFrame, facts: TableFacts, max_distinct: int,
                          non_numeric_only: bool = True) -> DataFrame | None:
    """(column, value, count) for the columns with 0 < distinct ≤ max_distinct."""
    cols = [c for c in facts.order
            if (not non_numeric_only or not facts.columns[c].is_numeric)
            and facts.columns[c].unique_count is not None
            and 0 < facts.columns[c].unique_count <= max_distinct]
    if not cols:
        return None
    if all(facts.columns[c].value_counts is not None for c in cols):
        # ≤ max_distinct rows per column, already measured by the distinct pass
        rows = [(c, v, n) for c in cols for v, n in facts.columns[c].value_counts.items()]
        return df.sparkSession.createDataFrame(rows, "column string, value string, count bigint")
    return value_count_table(df, cols)


def unpivot_text(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Long form (keep…, column, value) of ``columns`` as text, NULLs dropped."""
    types = {f.name: f.dataType for f in df.schema.fields}
    keep = keep or []
    entries = [F.struct(F.lit(c).alias("column"), value_text(c, types[c]).alias("value"))
               for c in columns]
    return (df.select(*keep, F.explode(F.array(*entries)).alias("_e"))
            .select(*keep, F.col("_e.column").alias("column"), F.col("_e.value").alias("value"))
            .filter(F.col("value").isNotNull()))


def typed_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(place, l, d, t): every non-null value of every column, in one unpivot over one scan.

    ``place`` is the column's number in ``columns`` as text; integers are in l,
    other numbers in d (NaN is missing), everything else is text in t. Numbers
    are never turned into text just to be counted.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    none = {k: F.lit(None).cast(k) for k in ("bigint", "double", "string")}
    cells = []
    for i, c in enumerate(columns):
        whole = isinstance(types[c], T.IntegralType)
        number = is_numeric_type(types[c]) and not whole
        cells += [F.lit(str(i)), F.col(c).cast("bigint") if whole else none["bigint"],
                  F.nanvl(F.col(c).cast("double"), none["double"]) if number else none["double"],
                  none["string"] if whole or number else value_text(c, types[c])]
    return (df.select(F.stack(F.lit(len(columns)), *cells).alias("place", "l", "d", "t"))
            .where("l is not null or d is not null or t is not null"))


def distinct_counts(df: DataFrame, columns: list[str], listed: set[str] | None = None) -> DataFrame:
    """(column, u, vals) exact non-null distinct counts: one scan, one grouping
    by (column, typed value), then a count per column. For the text columns in
    ``listed`` (known to be low-cardinality), ``vals`` also holds every
    (value, count) pair; it is empty otherwise."""
    places = [str(columns.index(c)) for c in sorted(listed or ())]
    counts = typed_values(df, columns).groupBy("place", "l", "d", "t").agg(F.count(F.lit(1)).alias("count"))
    # collect_list skips NULLs: only listed columns (bounded) contribute
    keep = F.col("place").isin(places) if places else F.lit(False)
    pair = F.when(keep, F.struct(F.col("t").alias("value"), "count"))
    out = counts.groupBy("place").agg(F.count(F.lit(1)).alias("u"), F.collect_list(pair).alias("vals"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("place").cast("int") + 1)
    return out.select(name.alias("column"), "u", "vals")


def value_count_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) for every non-null value of every column."""
    return unpivot_text(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
