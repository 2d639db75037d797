"""Reading tables and contracts; writing results.

Scan rules: NaN → NULL on float columns once, at scan; CSV missing-value
tokens → NULL while blank text survives; CSV column types inferred per
column by trying long → double → boolean → string over the whole column
(one aggregate scan), never by sampling.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.functions.columns import NA_TOKENS, NUMERIC_TEXT, na_tokens_to_null, nan_to_null

_INT_TEXT = r"^\s*[+-]?\d+\s*$"
_BOOL_TEXT = r"^(True|False|true|false|TRUE|FALSE)$"


def balance(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-split scan over every task slot.

    A scan with fewer splits than the cluster has task slots (e.g. one small
    file holding a single row group) would run every later pass on a few
    cores. Such an input is small by definition, so it is spread round-robin
    right after the scan. Column pruning and filter pushdown still reach the
    parquet scan (Catalyst pushes both below a round-robin repartition). A
    scan of a large table already has far more splits than slots, and this
    is a no-op for it.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def read_parquet(spark: SparkSession, path: str, balanced: bool = True) -> DataFrame:
    df = nan_to_null(spark.read.parquet(path))
    return balance(df) if balanced else df


CORRUPT = "_corrupt_record"


def _csv_reader(spark: SparkSession, multi_line: bool, mode: str):
    # "" inside quotes is one quote
    return (spark.read.option("header", True).option("mode", mode).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("nullValue", "\u0000__never__").option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def csv_files(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(files to be split by lines, files to be read whole) below ``path``.

    A quoted field that goes on over a line break leaves the number of quotes of
    its first line odd. One pass over the lines (split like any text) finds the
    files with such a line, and those with a line of white space alone, which the
    line reader would drop. Stray quotes only send a file to the slower reader.
    Files without lines are in neither list. One row a file reaches the driver.
    """
    line = F.col("value")
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    blank = (line != "") & (F.regexp_replace(line, r"[\x00-\x20]", "") == "")
    found = (spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("f"))
             .agg(F.max(odd | blank).alias("whole")).orderBy("f").collect())
    return [unquote(r["f"]) for r in found if not r["whole"]], [unquote(r["f"]) for r in found if r["whole"]]


def _read_csv_text(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """All columns as text. Files without open lines are split into tasks; only the others are read whole, one task each.

    In PERMISSIVE mode the column ``CORRUPT`` has the text of every record with
    too few or too many fields.
    """
    split, whole = csv_files(spark, path)
    parts = [(path, False)]
    if whole:
        # a folder with partition columns keeps them by being read as one
        mixed = split and spark.read.text(path).columns == ["value"]
        parts = [(split, False), (whole, True)] if mixed else [(path, True)]
    tables = []
    for paths, multi_line in parts:
        reader = _csv_reader(spark, multi_line, mode)
        table = reader.csv(paths)
        if mode == "PERMISSIVE":
            fields = [T.StructField(c, T.StringType()) for c in table.columns]
            table = (reader.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
                     .option("columnNameOfCorruptRecord", CORRUPT)
                     .option("columnPruning", False)  # a record is judged by all its fields, whichever are asked for
                     .csv(paths))
        tables.append(table)
    if len({tuple(t.columns) for t in tables}) > 1:
        raise ValueError(f"the files of {path} differ in their headers")
    return reduce(DataFrame.union, tables)


def _typed(text: DataFrame, schema, na_tokens: list[str] | None) -> DataFrame:
    return _counted_typed(text.withColumn(CORRUPT, F.lit(None).cast("string")), schema, na_tokens)[0]


def _counted_typed(raw: DataFrame, schema, na_tokens: list[str] | None) -> tuple[DataFrame, dict[str, int]]:
    """The well-formed records with their types, and how many records there are and are malformed, from the inference's scan."""
    names = [c for c in raw.columns if c != CORRUPT]
    flagged = raw.withColumn(CORRUPT, F.col(CORRUPT).isNotNull())  # a flag: a record that is an NA token stays malformed
    text = na_tokens_to_null(flagged, NA_TOKENS if na_tokens is None else na_tokens)
    # always true, and keeps a field in every scan: Spark refuses queries on the corrupt records alone
    asked = F.coalesce(F.length(text[names[0]]), F.lit(0)) >= 0 if names else F.lit(True)
    good = text.where(~F.col(CORRUPT) & asked).drop(CORRUPT)
    counts = [F.count(F.lit(1)).alias("records"), F.count_if(CORRUPT).alias("malformed")]
    if schema is None:
        whole = ~F.col(CORRUPT)
        row = text.agg(*counts, *_type_aggs({c: F.when(whole, F.col(c)) for c in names})).first() if names else None
        typed = good.select(*_narrowed(names, row)) if names else good
        return typed, {"records": row["records"], "malformed": row["malformed"]} if names else {"records": 0, "malformed": 0}
    # a value that does not fit the schema is an error, never a silent NULL
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if [f.name for f in wanted.fields] != names:
        raise ValueError(f"the schema names {[f.name for f in wanted.fields]}, the header {names}")
    row = text.agg(*counts, F.count(text[names[0]])).first()  # with a field: a query on CORRUPT alone is refused
    return nan_to_null(good.select(*[
        (F.col(f.name) if f.dataType == T.StringType() else F.trim(f.name).cast(f.dataType)).alias(f.name)
        for f in wanted.fields])), {"records": row["records"], "malformed": row["malformed"]}


def is_csv(path: str, fmt: str | None = None) -> bool:
    return (fmt or ("csv" if path.lower().endswith(".csv") else "parquet")) == "csv"


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema=None, na_tokens: list[str] | None = None) -> DataFrame:
    """Read a table; ``fmt`` defaults from the path suffix (csv or parquet). A malformed CSV record is an error."""
    if is_csv(path, fmt):
        return _typed(_read_csv_text(spark, path, "FAILFAST"), schema, na_tokens)
    if fmt in (None, "parquet"):
        return read_parquet(spark, path)
    return nan_to_null(spark.read.format(fmt).load(path))


def read_counted(spark: SparkSession, path: str, schema=None, na_tokens: list[str] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """A CSV table's well-formed records, and the numbers of all ``records`` and of ``malformed`` ones.

    Malformed records (too few or too many fields) are in the counts only, which
    the scan that infers the types makes.
    """
    return _counted_typed(_read_csv_text(spark, path, "PERMISSIVE"), schema, na_tokens)


def _type_aggs(columns: dict[str, Column]) -> list[Column]:
    """Per column how many values are no whole number, no long, no number, no boolean, and how many there are."""
    aggs = []
    for i, x in enumerate(columns.values()):
        aggs += [F.count_if(x.isNotNull() & ~x.rlike(_INT_TEXT)).alias(f"ni{i}"),
                 F.count_if(x.isNotNull() & F.trim(x).try_cast("bigint").isNull()).alias(f"lost{i}"),
                 F.count_if(x.isNotNull() & ~x.rlike(NUMERIC_TEXT)).alias(f"nd{i}"),
                 F.count_if(x.isNotNull() & ~x.rlike(_BOOL_TEXT)).alias(f"nb{i}"),
                 F.count(x).alias(f"nn{i}")]
    return aggs


def _narrowed(columns: list[str], row) -> list[Column]:
    """Each column in its narrowest type, by the counts of ``_type_aggs``."""
    exprs = []
    for i, c in enumerate(columns):
        x = F.col(c)
        if row[f"nn{i}"] == 0:
            exprs.append(x)
        elif row[f"ni{i}"] == 0:
            exprs.append(F.trim(x).try_cast("bigint").alias(c) if row[f"lost{i}"] == 0 else x)
        elif row[f"nd{i}"] == 0:
            exprs.append(F.trim(x).try_cast("double").alias(c))
        elif row[f"nb{i}"] == 0:
            exprs.append((F.lower(x) == F.lit("true")).alias(c))
        else:
            exprs.append(x)
    return exprs


def infer_types(df: DataFrame) -> DataFrame:
    """Give all-text columns their narrowest type that loses no value: long, double, boolean, else text.

    A column of whole numbers of which one is too long for a long stays text,
    as a double would change its digits.
    """
    text_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not text_cols:
        return df
    row = df.agg(*_type_aggs({c: F.col(c) for c in text_cols})).first()
    typed = dict(zip(text_cols, _narrowed(text_cols, row), strict=True))
    return df.select(*[typed.get(f.name, F.col(f.name)) for f in df.schema.fields])


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [read_parquet(spark, f"{sf_dir}/{n}.parquet") for n in names]


def read_contract_text(spark: SparkSession, path: str) -> str | None:
    """The contract document's text, read through Spark (works on any
    Hadoop-compatible store); ``None`` when it does not exist. Any other
    problem, and a folder with several documents, is an error."""
    try:
        rows = spark.read.text(path, wholetext=True).limit(2).collect()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if len(rows) > 1:
        raise ValueError(f"{path} holds more than one document")
    return rows[0]["value"] if rows else ""


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).option("quote", '"').option("escape", '"')
    w.save(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Write one small document (a contract, a plan) as a single text file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


CONTRACTS_SCHEMA = ("path string, status string, error string, dataset_name string, "
                    "contract_version string, document string")


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """A folder of contract documents as a table, one row per document:
    status ∈ {ok, empty, invalid_json, invalid_schema}. Each document is
    validated on the executors (one small document per row)."""

    def check(batches):
        import json as _json

        import pandas as pd
        from pydantic import ValidationError

        from quaystone.plans.contract import DatasetContract
        for pdf in batches:
            out = []
            for p, text in zip(pdf["path"], pdf["value"]):
                row = {"path": p, "status": "ok", "error": None, "dataset_name": None,
                       "contract_version": None, "document": text}
                if text is None or not text.strip():
                    row["status"] = "empty"
                else:
                    try:
                        doc = _json.loads(text)
                        c = DatasetContract.model_validate(doc)
                        row["dataset_name"], row["contract_version"] = c.dataset_name, c.contract_version
                    except _json.JSONDecodeError as exc:
                        row["status"], row["error"] = "invalid_json", str(exc)
                    except ValidationError as exc:
                        row["status"], row["error"] = "invalid_schema", str(exc)
                out.append(row)
            yield pd.DataFrame(out, columns=["path", "status", "error", "dataset_name", "contract_version",
                                             "document"])

    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return raw.mapInPandas(check, CONTRACTS_SCHEMA)
