"""Leakage-safe features.

``FeatureBuilder(plan).fit(train)`` is a Spark ML estimator: it measures what a
transform needs (exact medians, modes, means, population std, min/max, category
codes) on the training side only, with Spark aggregates. Its model adds a
``features`` vector, can stand in a ``Pipeline`` and is saved and loaded with it.

Categories are encoded through a dictionary table (column, value, code), ranked
by a range partitioning and joined to the rows: broadcast when its counted size
is small, else shuffled. Neither the driver nor the plan ever holds the categories.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import asdict

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.functions.columns import is_numeric_type, safe_ratio
from quaystone.functions.ordering import with_row_index
from quaystone.functions.quantiles import exact_quantiles, first_pass_aggs
from quaystone.operators.splits import stratified_folds, stratified_split
from quaystone.plans.modeling import FeaturePlan, Ratio
from quaystone.session import checkpoint_dir

BROADCAST_CATEGORIES = 500_000  # a column's dictionary up to this counted size is broadcast
CATEGORIES_SCHEMA = "column string, value string, code long"
DEFAULT_TRANSFORM = "standard_scale"


class FeatureBuildError(ValueError):
    pass


def add_derived(df: DataFrame, plan: FeaturePlan) -> DataFrame:
    """Ratios in plan order (a later ratio may use an earlier one)."""
    out = df
    for d in plan.derived:
        out = out.withColumn(d.name, safe_ratio(F.col(d.numerator), F.col(d.denominator)))
    return out


def feature_table(df: DataFrame, plan: FeaturePlan, contract=None) -> DataFrame:
    """Planned features in plan order, target last (raw, pre-encoding)."""
    if contract is not None:
        from quaystone.plans.contract import Enforcement
        hard = {e.name for e in contract.excluded_features if e.enforcement == Enforcement.HARD}
        bad = [f for f in plan.use_features if f in hard or f == contract.target.name]
        if bad:
            raise FeatureBuildError(f"features refused at build time: {bad}")
    with_d = add_derived(df, plan)
    return with_d.select(*plan.feature_names(), plan.target)


def write_feature_table(df: DataFrame, plan: FeaturePlan, path: str, contract=None) -> DataFrame:
    """Write the feature table (columns in plan order, target last) and return the copy read back in that order."""
    table = feature_table(df, plan, contract)
    table.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(table.schema).parquet(path)


def feature_groups(plan: FeaturePlan, schema: T.StructType) -> dict[str, str]:
    """What happens to each feature: its encoder or transform, for other numbers the default scaling."""
    types = {f.name: f.dataType for f in schema.fields}
    fallback = {name: DEFAULT_TRANSFORM for name, dt in types.items() if is_numeric_type(dt)}
    groups = {name: (fallback | plan.transforms | plan.encoders).get(name) for name in plan.feature_names()}
    homeless = {name: types[name].simpleString() if name in types else "absent"
                for name, group in groups.items() if group is None or name not in types}
    if homeless:
        raise FeatureBuildError(f"these features are absent, or text that the plan gives no encoder: {homeless}")
    return groups


# ---------------------------------------------------------------------------
# the category dictionary
# ---------------------------------------------------------------------------

def category_dictionary(data: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, str], dict[str, int]]:
    """((column, value, code), fill per column, categories per column).

    One shuffle counts every value of every column. The fill is a column's most
    frequent value (the smallest on ties; a column without values has the empty
    text, its only category). Codes count from 0 in the order of the values:
    numbers by size, text by UTF-16 code units. One row a column reaches the driver.
    """
    types = {f.name: f.dataType for f in data.schema.fields}

    def entry(c: str):
        text = F.col(c).cast("string")
        number = F.col(c).cast("double") if is_numeric_type(types[c]) else F.lit(None).cast("double")
        return F.struct(F.lit(c).alias("column"), text.alias("value"), number.alias("number"))
    counts = (data.select(F.explode(F.array(*[entry(c) for c in columns])).alias("e")).select("e.*")
              .where("value is not null").groupBy("column", "value", "number").agg(F.count(F.lit(1)).alias("n")))
    checkpoint_dir(data.sparkSession)
    counts = counts.checkpoint(eager=True)
    # the place of a value among its column's: two aggregates that are partly done before the shuffle
    place = F.struct("number", F.encode("value", "UTF-16BE").alias("text"))
    found = counts.groupBy("column").agg(F.count(F.lit(1)).alias("size"),
                                         F.min_by("value", F.struct(-F.col("n"), place)).alias("fill")).collect()
    fills = {c: "" for c in columns} | {r["column"]: r["fill"] for r in found}
    sizes = {c: 1 for c in columns} | {r["column"]: int(r["size"]) for r in found}
    placed = counts.select("column", "value", "number", F.encode("value", "UTF-16BE").alias("text"))
    if sum(sizes.values()) <= BROADCAST_CATEGORIES:  # counted: few enough for a task a column
        code = F.row_number().over(Window.partitionBy("column").orderBy("number", "text")) - 1
        ranked = placed.withColumn("code", code)
    else:
        ranked = with_row_index(placed, ["number", "text"], "code", partition_by="column", group_count=len(columns))
    empty = [(c, "", 0) for c in columns if c not in {r["column"] for r in found}]
    out = ranked.select("column", "value", F.col("code").cast("long").alias("code"))
    return out.unionByName(data.sparkSession.createDataFrame(empty, CATEGORIES_SCHEMA)), fills, sizes


def encode_column(df: DataFrame, dictionary: DataFrame, column: str, size: int, name: str,
                  limit: int = BROADCAST_CATEGORIES) -> DataFrame:
    """Adds ``name``: the code of the column's value as a long, null where the dictionary has no such value."""
    codes = dictionary.where(F.col("column") == column).select(F.col("value").alias("_c_value"), F.col("code").alias(name))
    codes = F.broadcast(codes) if size <= limit else codes
    return df.join(codes, F.col(column).cast("string") == F.col("_c_value"), "left").drop("_c_value")


# ---------------------------------------------------------------------------
# estimator and model
# ---------------------------------------------------------------------------

class FittedFeatures(Model, MLReadable, MLWritable):
    """Adds ``features`` (and the columns it is made of). A category that the fit did not see has
    the code -1, one-hot encoded all zeros."""

    def __init__(self, plan: FeaturePlan, *, numeric_fill: dict | None = None, category_fill: dict | None = None,
                 scale: dict | None = None, sizes: dict | None = None, categories: DataFrame | None = None):
        super().__init__()
        self.plan = plan
        self.numeric_fill = numeric_fill or {}
        self.category_fill = category_fill or {}
        self.scale = {c: tuple(v) for c, v in (scale or {}).items()}  # column -> (kind, a, b)
        self.sizes = sizes or {}  # categories of every encoded column
        self.categories = categories  # (column, value, code)
        self._encoder = None

    def _names(self, encoder: str) -> list[str]:
        return [c for c in self.sizes if self.plan.encoders[c] == encoder]

    def transform_columns(self, df: DataFrame) -> DataFrame:
        """The transformed features as plain columns: ``_f_<name>`` (numbers and ordinal codes) and ``_i_<name>``
        (one-hot codes), before one-hot encoding and vector assembly."""
        out = add_derived(df, self.plan)
        for c, v in self.numeric_fill.items():
            out = out.withColumn(c, F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(v)))
        for c, v in self.category_fill.items():
            out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(v)))
        for c, (kind, a, b) in self.scale.items():
            x = F.col(c).cast("double")
            if kind == "log1p":
                expr = F.log1p(x)
            elif kind == "standard":
                expr = (x - F.lit(a)) / F.lit(b if b else 1.0)
            else:  # minmax
                expr = F.when(F.lit(b - a) == 0, F.lit(0.0)).otherwise((x - F.lit(a)) / F.lit(b - a if b != a else 1.0))
            out = out.withColumn(f"_f_{c}", expr)
        for c, n in self.sizes.items():
            out = encode_column(out, self.categories, c, n, "_c_code")
            if self.plan.encoders[c] == "ordinal":
                out = out.withColumn(f"_f_{c}", F.coalesce(F.col("_c_code").cast("double"), F.lit(-1.0))).drop("_c_code")
            else:
                # the slot behind the last category is for values not seen; the encoder drops exactly that one
                code = F.coalesce(F.col("_c_code"), F.lit(n)).cast("double")
                out = out.withColumn(f"_i_{c}", code.alias(f"_i_{c}", metadata=_nominal(n + 1))).drop("_c_code")
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.transform_columns(df)
        onehot = self._names("onehot")
        if onehot:
            if self._encoder is None:
                # its sizes come from the columns' metadata: no job
                self._encoder = OneHotEncoder(inputCols=[f"_i_{c}" for c in onehot], outputCols=[f"_o_{c}" for c in onehot],
                                              dropLast=True, handleInvalid="error").fit(out.limit(0))
            out = self._encoder.transform(out)
        inputs = [f"_o_{c}" if c in onehot else f"_f_{c}" for c in self.plan.feature_names()]
        return VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep").transform(out)

    def write(self) -> MLWriter:
        return _FeaturesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FeaturesReader()


def _nominal(n: int) -> dict:
    return {"ml_attr": {"type": "nominal", "num_vals": n}}


class _FeaturesWriter(MLWriter):
    def __init__(self, instance: FittedFeatures):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        f = self.instance
        fitted = {"plan": asdict(f.plan), "numeric_fill": f.numeric_fill, "category_fill": f.category_fill,
                  "scale": {c: list(v) for c, v in f.scale.items()}, "sizes": f.sizes}
        DefaultParamsWriter.saveMetadata(f, path, self.sparkSession, extraMetadata={"fitted": fitted})
        if f.sizes:
            f.categories.write.parquet(f"{path}/categories")


class _FeaturesReader(MLReader):
    def load(self, path: str) -> FittedFeatures:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        fitted = dict(metadata["fitted"])
        plan = fitted.pop("plan")
        plan["derived"] = [Ratio(**d) for d in plan["derived"]]
        categories = self.sparkSession.read.schema(CATEGORIES_SCHEMA).parquet(f"{path}/categories") if fitted["sizes"] else None
        out = FittedFeatures(FeaturePlan(**plan), categories=categories, **fitted)
        out._resetUid(metadata["uid"])
        return out


class FeatureBuilder(Estimator):
    """Plan → fitted preprocessing; see feature_groups for what happens to each feature."""

    def __init__(self, plan: FeaturePlan):
        super().__init__()
        self.plan = plan

    def _fit(self, train: DataFrame) -> FittedFeatures:
        """A fixed number of passes over the training side whatever the feature
        count: one aggregate scan for every numeric feature (counts, moments,
        min/max and the exact-quantile first pass), the exact-median selection,
        and one ``groupBy(column, value)`` over all categorical features."""
        data = add_derived(train, self.plan)
        groups = feature_groups(self.plan, data.schema)
        encoded = [c for c in groups if c in self.plan.encoders]
        kinds = {c: g for c, g in groups.items() if c not in encoded}
        fitted = FittedFeatures(self.plan)
        if kinds:
            self._fit_numeric(data, kinds, fitted)
        if encoded:
            dictionary, fitted.category_fill, fitted.sizes = category_dictionary(data, encoded)
            path = f"{checkpoint_dir(train.sparkSession).rstrip('/')}/categories-{uuid.uuid4().hex}"
            dictionary.write.parquet(path)
            fitted.categories = train.sparkSession.read.schema(CATEGORIES_SCHEMA).parquet(path)
        return fitted

    @staticmethod
    def _fit_numeric(data: DataFrame, kinds: dict[str, str], fitted: FittedFeatures) -> None:
        """Exact medians (the fill values) and the scaling statistics of the
        median-filled columns. The filled column's moments are the raw
        column's moments merged with ``k`` copies of the median (the same
        pairwise merge Spark uses for partial ``stddev`` buffers), so no
        second scan over the filled data is needed."""
        columns = list(kinds)
        exprs = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, c in enumerate(columns):
            x = exprs[c]
            aggs += [F.avg(x).alias(f"av{i}"), F.stddev_pop(x).alias(f"sp{i}"),
                     F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
        aggs += first_pass_aggs({f"_qs_q{i}": exprs[c] for i, c in enumerate(columns)}, [0.5])
        row = data.agg(*aggs).collect()[0]
        med = exact_quantiles(data, columns, [0.5], exprs=exprs, first=row)
        rows = int(row["_rows"])
        for i, c in enumerate(columns):
            m = med[(c, 0.5)]
            fill = m if m is not None else 0.0
            fitted.numeric_fill[c] = fill
            n_a = int(row[f"n__qs_q{i}"])
            k = rows - n_a
            if kinds[c] == "log1p":
                fitted.scale[c] = ("log1p", 0.0, 0.0)
                continue
            if n_a == 0:
                mean, std, lo, hi = fill, 0.0, fill, fill
            else:
                mean_a, std_a = float(row[f"av{i}"]), float(row[f"sp{i}"] or 0.0)
                delta = fill - mean_a
                mean = mean_a + delta * k / rows if k else mean_a
                m2 = std_a * std_a * n_a + (delta * delta * n_a * k / rows if k else 0.0)
                std = math.sqrt(m2 / rows) if k else std_a
                lo, hi = float(row[f"mn{i}"]), float(row[f"mx{i}"])
                if k:
                    lo, hi = min(lo, fill), max(hi, fill)
            fitted.scale[c] = ("standard", mean, std) if kinds[c] == "standard_scale" else ("minmax", lo, hi)


__all__ = ["FeatureBuildError", "FeatureBuilder", "FittedFeatures", "add_derived", "category_dictionary", "encode_column",
           "feature_groups", "feature_table", "stratified_folds", "stratified_split", "write_feature_table"]
