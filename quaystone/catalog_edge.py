"""Registered queries on what well-kept tables lack: NaN, missing and unseen
categories, malformed records, rows without labels, lists too long to show and
sinks that are written twice. Each makes its holes in a whole given table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.functions import sketches
from quaystone.functions.columns import numeric_or_null
from quaystone.operators import calibrate, clean, eda, evaluate, gate, logs, measure, profile, runs
from quaystone.operators.features import FeatureBuilder, write_feature_table
from quaystone.operators.splits import stratified_split
from quaystone.plans.cleaning import Cast, CleaningPlan, Impute
from quaystone.plans.examples import churn_like, orders_draft
from quaystone.plans.modeling import FeaturePlan, Ratio
from quaystone.session import checkpoint_dir
from quaystone.sources.tables import read_parquet

NAN = float("nan")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/orders.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/documents.parquet")


def _scratch(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f.name).cast("double"), 6).alias(f.name) if f.dataType.simpleString() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def _nan_where(hole: Column, value: str) -> Column:
    return F.when(hole, F.lit(NAN)).otherwise(F.col(value).cast("double")).alias(value)


def _contract(df: DataFrame):
    return measure.build_contract(orders_draft(), df, contract_version="1.0.0", run_id="edge", created_by="edge",
                                  dataset_name="orders", created_at="2026-01-01T00:00:00Z")


# ---------------------------------------------------------------------------
# NaN is missing
# ---------------------------------------------------------------------------

def _holes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _orders(spark, sf).select(k, "o_custkey", _nan_where(k % 5 == 0, "o_totalprice"),
                                     F.when(k % 3 == 0, (F.col("o_totalprice") % 97).cast("double")).alias("part"),
                                     F.lit(7.5).alias("constant"))


def q_eda_correlations_nan_orders(spark, sf):
    return _rounded(eda.correlations(_holes(spark, sf)))


def q_eda_histogram_nan_orders(spark, sf):
    return _rounded(eda.histogram(_holes(spark, sf), "o_totalprice")).select(F.col("bin").cast("bigint"), "lower", "upper", "count")


def q_cln_impute_nan_orders(spark, sf):
    plan = CleaningPlan([Impute("o_totalprice", "mean", "unpriced"), Impute("part", "median", "unparted")])
    return _rounded(clean.execute_plan(_holes(spark, sf).drop("constant", "o_custkey"), plan))


def q_cln_cast_int64_orders(spark, sf):
    text = _orders(spark, sf).select("o_orderkey", F.concat(F.lit(" "), F.floor("o_totalprice").cast("string")).alias("price"))
    return clean.execute_plan(text, CleaningPlan([Cast("price", "int64", "whole units")]))


# ---------------------------------------------------------------------------
# categories and splits
# ---------------------------------------------------------------------------

def _kinds(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("n_chars") % 7 != 0, F.concat("source", F.lit("-"), "lang"))
    return _documents(spark, sf).select("doc_id", "lang", kind.alias("kind"), kind.alias("kind2"), F.lit(0).alias("y"))


def q_fea_unseen_categories_documents(spark, sf):
    """Encoders fitted without one language: its categories are unseen, missing ones become the most frequent."""
    t = _kinds(spark, sf)
    plan = FeaturePlan(target="y", use_features=["kind", "kind2"], encoders={"kind": "ordinal", "kind2": "onehot"})
    fitted = FeatureBuilder(plan).fit(t.where("lang <> 'fr'"))
    out = fitted.transform_columns(t)
    n = fitted.sizes["kind2"]
    return out.select("doc_id", F.col("_f_kind").cast("bigint").alias("ordinal"),
                      F.when(F.col("_i_kind2") < n, F.col("_i_kind2")).cast("bigint").alias("hot"), F.lit(n).cast("bigint").alias("width"))


def q_fea_table_churn(spark, sf):
    labels = read_parquet(spark, f"{sf}/labels.parquet")
    t = churn_like(_documents(spark, sf), labels)
    plan = FeaturePlan(target="toxic", use_features=["lang", "n_chars"], derived=[Ratio("chars_by_quality", "n_chars", "quality")])
    table = write_feature_table(t, plan, f"{_scratch(spark)}/features")
    return _rounded(table.select("*", F.lit(",".join(table.columns)).alias("order")))


def q_spl_many_classes_orders(spark, sf):
    """A class per customer, some without one."""
    o = _orders(spark, sf).select("o_orderkey", F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey")).alias("o_custkey"))
    return stratified_split(o, "o_custkey", "o_orderkey")


def q_fea_impute_median_orders(spark, sf):
    """Numbers filled with the training side's median, then scaled with its mean and population spread."""
    k = F.col("o_orderkey")
    t = _orders(spark, sf).select(k, F.col("o_orderstatus"), _nan_where(k % 5 == 0, "o_totalprice"), F.lit(0).alias("y"))
    fitted = FeatureBuilder(FeaturePlan(target="y", use_features=["o_totalprice"])).fit(t.where("o_orderstatus <> 'P'"))
    out = fitted.transform_columns(t)
    return _rounded(out.select("o_orderkey", F.col("o_totalprice").alias("filled"), F.col("_f_o_totalprice").alias("scaled")))


def q_flt_numeric_text_orders(spark, sf):
    """Text that is a number, in any of the forms that count as one, as a number; other text dropped."""
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    text = (F.when(k % 6 == 0, F.concat(F.lit(" "), price, F.lit(" "))).when(k % 6 == 1, F.concat(price, F.lit("e1")))
            .when(k % 6 == 2, F.concat(price, F.lit("d"))).when(k % 6 == 3, F.lit("NaN")).when(k % 6 == 4, F.concat(F.lit("+"), price)))
    t = _orders(spark, sf).select("o_orderkey", text.alias("price"))
    number = numeric_or_null("price", t.schema["price"].dataType)
    return _rounded(t.select("o_orderkey", number.alias("price")).where("price is not null"))


def q_flt_log_levels_orders(spark, sf):
    """A log of all orders, written as text, its lines classified and counted by level."""
    level = F.element_at(F.create_map(*[F.lit(x) for x in ("F", "INFO", "O", "WARN", "P", "ERROR")]), F.col("o_orderstatus"))
    line = F.concat(F.lit("2026-01-01 "), level, F.lit(" order "), F.col("o_orderkey").cast("string"),
                    F.when(F.col("o_orderkey") % 10 == 0, F.lit(" saw DEBUG ")).otherwise(F.lit("")))
    path = f"{_scratch(spark)}/log"
    _orders(spark, sf).select(line.alias("value")).write.text(path)
    return logs.level_counts(logs.read_log(spark, path))


# ---------------------------------------------------------------------------
# sketches
# ---------------------------------------------------------------------------

def q_pro_sketches_lineitem(spark, sf):
    """Distinct counts from sketches of the table's parts, written and merged; small ones are exact."""
    li = read_parquet(spark, f"{sf}/lineitem.parquet")
    root = _scratch(spark)
    for n, flag in enumerate(("R", "A", "N")):
        part = li.where(F.col("l_returnflag") == flag)
        sketches.sketch_columns(part, ["l_linestatus", "l_returnflag", "l_quantity"]).write.parquet(f"{root}/part={n}")
    merged = sketches.merge_sketches(spark.read.parquet(root).drop("part"))
    return sketches.distinct_estimates(merged).select("column", "distinct_estimate", "values")


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------

def q_gate_malformed_csv_orders(spark, sf):
    """A CSV of orders in which some records have a field too many, gated from its path."""
    o = _orders(spark, sf)
    root = _scratch(spark)
    contract = _contract(o)
    runs_path = f"{root}/contract"
    from quaystone.sources.tables import write_text
    write_text(spark, contract.to_json(), runs_path)
    names = ",".join(o.columns)
    body = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in o.columns])
    bad = F.when(F.col("o_orderkey") % 1000 == 1, F.concat(body, F.lit(",surplus"))).otherwise(body)
    lines = o.select(bad.alias("value"))
    # every file of a folder has the header
    per_file = lines.coalesce(4).mapInPandas(_with_header(names), "value string")
    per_file.write.text(f"{root}/orders.csv")
    report = gate.run_gate_paths(spark, f"{root}/orders.csv", runs_path, run_id="malformed")
    found = report.findings_df(spark).where("check_id in ('ARTIFACTS_CSV_LOADS', 'INTEGRITY_SHA256_MATCH', 'SCALE_DRIFT_ROW_COUNT')")
    return found.select("check_id", "severity", F.col("observed_value").cast("bigint").alias("observed_value"))


def _with_header(names: str):
    def run(batches):
        import pandas as pd
        first = True
        for batch in batches:
            if first:
                yield pd.DataFrame({"value": [names]})
                first = False
            yield batch
    return run


def q_snk_unexpected_values_orders(spark, sf):
    """Undeclared values beyond those a finding lists, written twice and read back from the sink."""
    o = _orders(spark, sf)
    odd = o.withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit("/"), (F.col("o_custkey") % 40).cast("string")))
    report = gate.run_gate(odd, _contract(o), run_id="odd")
    root = _scratch(spark)
    for _ in range(2):
        runs.write_findings(spark, report, root)
    return runs.read_unexpected(spark, root).select("run_id", "column", "value", "count")


def q_snk_runs_written_twice_orders(spark, sf):
    """Run records of two runs, one of them written twice, and the findings of its second attempt."""
    o = _orders(spark, sf)
    contract = _contract(o)
    root = _scratch(spark)
    for run_id, factor in (("007", 100.0), ("b", 10.0), ("007", 1.0)):
        report = gate.run_gate(o.withColumn("o_totalprice", F.col("o_totalprice") * F.lit(factor)), contract, run_id=run_id)
        runs.write_findings(spark, report, root)
        runs.append_run(runs.run_record(spark, run_id=run_id, report=report, rows=o.count(), columns=len(o.columns)), f"{root}/runs")
    errors = (runs.read_findings(spark, root).where("severity = 'ERROR' and check_id = 'SCALE_DRIFT_MEDIAN'")
              .groupBy("run_id").agg(F.count(F.lit(1)).alias("drifts")))
    return (runs.read_runs(spark, f"{root}/runs").join(errors, "run_id", "left")
            .select("run_id", "status", "rows", F.coalesce("drifts", F.lit(0)).cast("bigint").alias("drifts")))


def q_gate_publish_orders(spark, sf):
    """A clean and a corrupted candidate behind the gate: where their rows went and why."""
    o = _orders(spark, sf)
    contract = _contract(o)
    root = _scratch(spark)
    out = []
    for run_id, factor in (("clean", 1.0), ("x100", 100.0)):
        snap = runs.snapshot(o.withColumn("o_totalprice", F.col("o_totalprice") * F.lit(factor)), root, run_id)
        done = runs.gated_publish(snap, gate.run_gate(snap, contract, run_id=run_id), f"{root}/published/{run_id}", f"{root}/held/{run_id}")
        out.append(spark.read.parquet(done.path).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(run_id).alias("run_id"), F.lit(done.published).alias("published"), "rows",
            F.lit("SCALE_DRIFT_MEDIAN" in (done.reason or "")).alias("drift_named")))
    return out[0].unionByName(out[1])


def q_con_integrity_orders(spark, sf):
    facts = _contract(_orders(spark, sf)).integrity
    return spark.createDataFrame([(facts.row_count, facts.column_count, ",".join(facts.column_order))],
                                 "row_count long, column_count long, column_order string")


def q_pro_dtypes_lineitem(spark, sf):
    cols, _ = profile.profile_columns(read_parquet(spark, f"{sf}/lineitem.parquet"))
    return cols.select("column", "dtype", "is_numeric")


def q_evl_lookup_by_lang(spark, sf):
    """Single numbers of the long metrics table, looked up one by one."""
    t = churn_like(_documents(spark, sf), read_parquet(spark, f"{sf}/labels.parquet"))
    scored = t.select(F.col("lang").alias("variant"), F.col("toxic").alias("label"), ((F.col("n_chars") % 997) / F.lit(997.0)).alias("score"))
    table = evaluate.metrics(scored, group_by="variant")
    long = evaluate.metrics_long(table, ["variant"]).withColumn("split", F.lit("cv"))
    rows = [(lang, evaluate.lookup_metric(long, lang, "cv", "accuracy")) for lang in ("de", "en", "es", "fr")]
    return _rounded(spark.createDataFrame(rows, "variant string, accuracy double"))


# ---------------------------------------------------------------------------
# calibration
# ---------------------------------------------------------------------------

def q_cal_orders_totalprice(spark, sf):
    """The whole study: six batch sizes, 3,000 iterations, draws by a keyed permutation."""
    return _rounded(calibrate.calibrate(_orders(spark, sf), "o_totalprice", ["o_orderkey", "o_totalprice", "o_orderstatus"],
                                        rate_expr=(F.col("o_orderstatus") == "F").cast("int"))
                    .select("statistic", F.col("batch_n").cast("bigint").alias("batch_n"), "p50", "p95", "p99", "max"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k[2:]: v for k, v in globals().items() if k.startswith("q_") and callable(v)}


_HOLES = ("(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice, "
          "CASE WHEN o_orderkey % 3 = 0 THEN (o_totalprice % 97)::double END AS part FROM orders)")


def _correlations() -> str:
    cols = ["o_custkey", "o_orderkey", "o_totalprice", "part"]
    both = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    rows = [f"SELECT '{a}__vs__{b}' AS pair, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS value FROM h "
            f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in both]
    return f"WITH h AS {_HOLES} SELECT * FROM (" + " UNION ALL ".join(rows) + ") WHERE NOT isnan(value)"


def _mixed(x: str) -> str:
    a = f"((({x}) * 1103515245 + 12345) % 4294967296)"
    b = f"((xor({a}, {a} >> 15) * 1664525 + 1013904223) % 4294967296)"
    return f"xor({b}, {b} >> 13)"


def _draws() -> str:
    """The keyed permutation, one select a round; all batches of the study are smaller than orders or drawn by mixing."""
    steps = [f"""d0 AS (
  SELECT size, iter, s, k AS x, n FROM st, unnest({list(calibrate.BATCH_SIZES)}) AS a(size), unnest(range(0, {calibrate.N_ITER})) AS i(iter),
         unnest(range(0, size)) AS t(k), LATERAL (SELECT CAST('0x' || substr(md5('42|' || size || '|' || iter), 1, 8) AS BIGINT) AS s))"""]
    for r in range(calibrate.ROUNDS):
        key = f"({_mixed(f'(s + {r * calibrate.STEP_KEY}) % 4294967296')} % n)"
        steps.append(f"y{r} AS (SELECT size, iter, s, n, x, ({key} - x + n) % n AS y FROM d{r})")
        bit = _mixed(f"(greatest(x, y) + s + {r * calibrate.STEP_BIT}) % 4294967296")
        steps.append(f"d{r + 1} AS (SELECT size, iter, s, n, CASE WHEN {bit} >= 2147483648 THEN y ELSE x END AS x FROM y{r})")
    last = f"d{calibrate.ROUNDS}"
    plain = _mixed("(s + x * 2) % 4294967296")
    steps.append(f"draws AS (SELECT size, iter, x AS pos FROM {last} WHERE size < n "
                 f"UNION ALL SELECT size, iter, {plain} % n FROM d0 WHERE size >= n)")
    return ",\n".join(steps)


def oracle_sql() -> dict[str, str]:
    return {
        "eda_correlations_nan_orders": _correlations(),
        "eda_histogram_nan_orders": f"""
WITH h AS (SELECT o_totalprice AS x FROM {_HOLES} WHERE o_totalprice IS NOT NULL),
e AS (SELECT min(x) AS lo, max(x) AS hi FROM h),
c AS (SELECT least(floor((x - lo) / (hi - lo) * 30)::bigint + 1, 30) AS bin, count(*) AS n FROM h, e GROUP BY 1)
SELECT b AS bin, round(lo + (b - 1) * (hi - lo) / 30, 6) AS lower, round(lo + b * (hi - lo) / 30, 6) AS upper, coalesce(n, 0) AS count
FROM e, unnest(range(1, 31)) AS t(b) LEFT JOIN c ON c.bin = b""",
        "cln_impute_nan_orders": f"""
WITH h AS {_HOLES}
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM h)), 6) AS o_totalprice,
       round(coalesce(part, (SELECT quantile_cont(part, 0.5) FROM h)), 6) AS part FROM h""",
        "cln_cast_int64_orders": "SELECT o_orderkey, floor(o_totalprice)::bigint AS price FROM orders",
        "fea_unseen_categories_documents": """
WITH t AS (SELECT doc_id, lang, CASE WHEN n_chars % 7 <> 0 THEN source || '-' || lang END AS kind FROM documents),
seen AS (SELECT kind, count(*) AS n, row_number() OVER (ORDER BY kind) - 1 AS code FROM t WHERE lang <> 'fr' AND kind IS NOT NULL GROUP BY kind),
fill AS (SELECT kind AS f FROM seen ORDER BY n DESC, kind LIMIT 1)
SELECT doc_id, coalesce(code, -1)::bigint AS ordinal, code::bigint AS hot, (SELECT count(*) FROM seen) AS width
FROM t, fill LEFT JOIN seen ON seen.kind = coalesce(t.kind, f)""",
        "fea_table_churn": """
SELECT d.lang, d.n_chars, round(d.n_chars / CASE WHEN l.quality = 0 THEN 1 ELSE l.quality END, 6)::double AS chars_by_quality,
       l.toxic::bigint AS toxic, 'lang,n_chars,chars_by_quality,toxic' AS "order" FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
        "fea_impute_median_orders": """
WITH t AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS p FROM orders),
m AS (SELECT quantile_cont(p, 0.5) AS med FROM t WHERE o_orderstatus <> 'P'),
s AS (SELECT avg(coalesce(p, med)) AS mean, stddev_pop(coalesce(p, med)) AS sd FROM t, m WHERE o_orderstatus <> 'P')
SELECT o_orderkey, round(coalesce(p, med), 6) AS filled, round((coalesce(p, med) - mean) / sd, 6) AS scaled FROM t, m, s""",
        "flt_numeric_text_orders": """
SELECT o_orderkey, round((o_totalprice::decimal(18,2))::double * CASE WHEN o_orderkey % 6 = 1 THEN 10 ELSE 1 END, 6) AS price
FROM orders WHERE o_orderkey % 6 IN (0, 1, 4)""",
        "flt_log_levels_orders": """
SELECT CASE o_orderstatus WHEN 'F' THEN 'INFO' WHEN 'O' THEN 'WARNING' WHEN 'P' THEN 'ERROR' END AS level, count(*) AS lines
FROM orders GROUP BY o_orderstatus""",
        "gate_publish_orders": """
SELECT r AS run_id, p AS published, (SELECT count(*) FROM orders) AS rows, NOT p AS drift_named
FROM (VALUES ('clean', true), ('x100', false)) AS t(r, p)""",
        "con_integrity_orders": """
SELECT (SELECT count(*) FROM orders) AS row_count, count(*) AS column_count, string_agg(column_name, ',' ORDER BY column_index) AS column_order
FROM duckdb_columns() WHERE table_name = 'orders'""",
        "pro_dtypes_lineitem": """
SELECT column_name AS "column", CASE data_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'float64'
         WHEN 'VARCHAR' THEN 'str' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE data_type END AS dtype,
       data_type IN ('BIGINT', 'INTEGER', 'DOUBLE') AS is_numeric FROM duckdb_columns() WHERE table_name = 'lineitem'""",
        "evl_lookup_by_lang": """
SELECT d.lang AS variant, round(avg((((d.n_chars % 997) / 997.0 >= 0.5)::int = l.toxic)::int), 6) AS accuracy
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""",
        "spl_many_classes_orders": """
WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 11 <> 0 THEN o_custkey END AS o_custkey FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5('42|' || o_orderkey), o_orderkey) AS k,
             count(*) OVER (PARTITION BY o_custkey) AS n FROM o)
SELECT o_orderkey, o_custkey, CASE WHEN k <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM r""",
        "pro_sketches_lineitem": """
SELECT 'l_linestatus' AS "column", count(DISTINCT l_linestatus) AS distinct_estimate, count(l_linestatus) AS "values" FROM lineitem
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag), count(l_returnflag) FROM lineitem
UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity), count(l_quantity) FROM lineitem""",
        "gate_malformed_csv_orders": """
WITH bad AS (SELECT count(*) AS n, (SELECT count(*) FROM orders) AS total FROM orders WHERE o_orderkey % 1000 = 1)
SELECT 'ARTIFACTS_CSV_LOADS' AS check_id, 'ERROR' AS severity, n AS observed_value FROM bad
UNION ALL SELECT 'INTEGRITY_SHA256_MATCH', 'ERROR', NULL FROM bad
UNION ALL SELECT 'SCALE_DRIFT_ROW_COUNT', 'WARN', total - n FROM bad""",
        "snk_unexpected_values_orders": """
SELECT 'odd' AS run_id, 'o_orderpriority' AS "column", o_orderpriority || '/' || (o_custkey % 40) AS value, count(*) AS count
FROM orders GROUP BY value""",
        "snk_runs_written_twice_orders": """
SELECT r AS run_id, CASE WHEN d > 0 THEN 'halted_validation' ELSE 'completed' END AS status, (SELECT count(*) FROM orders) AS rows, d::bigint AS drifts
FROM (VALUES ('007', 0), ('b', 1)) AS t(r, d)""",
        "cal_orders_totalprice": f"""
WITH pop AS (SELECT row_number() OVER (ORDER BY o_orderkey, o_totalprice, o_orderstatus) - 1 AS pos, o_totalprice AS v,
                    (o_orderstatus = 'F')::int AS r FROM orders),
st AS (SELECT count(*) AS n, avg(r) AS rate, quantile_cont(v, 0.5) AS med FROM pop),
{_draws()},
batches AS (SELECT size, iter, quantile_cont(v, 0.5) AS med, avg(r) AS rate FROM draws JOIN pop USING (pos) GROUP BY size, iter),
devs AS (SELECT size, 'median_dev_pct' AS statistic, abs(b.med - st.med) / st.med * 100 AS d FROM batches b, st
         UNION ALL SELECT size, 'rate_dev_pp', abs(b.rate - st.rate) * 100 FROM batches b, st)
SELECT statistic, size::bigint AS batch_n, round(quantile_cont(d, 0.5), 6) AS p50, round(quantile_cont(d, 0.95), 6) AS p95,
       round(quantile_cont(d, 0.99), 6) AS p99, round(max(d), 6) AS max FROM devs GROUP BY statistic, size""",
    }
