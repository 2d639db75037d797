"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    align,
    collocate,
    decontaminate,
    exact,
    jaccard,
    license_scan,
    line_chunks,
    lm_score,
    mix,
    quality,
    shard,
    suffix_dedup,
    url_filter,
)
from .common import documents
from .oracles import OP12_SQL, OP13_SQL

PIECES = "/opt/tokenizers/piece_bpe_32k.model"  # the vocabulary file of op8 and op11
BYTES = "/opt/tokenizers/byte_bpe_50k.json"  # the other of op11
# host, path and verdict of the rules of op12
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the items."""
    found = decontaminate.contaminations(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_passages", F.round("question_overlap", 6).alias("question_overlap"),
                        F.round("answer_overlap", 6).alias("answer_overlap"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, documents(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
                         F.round("score", 9).alias("score"), "predicted")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its near copies."""
    return jaccard.jaccard_classes(documents(spark, sf_dir))


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt into 24 shards of equal row counts."""
    docs = documents(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    return shard.shard_rows(docs, 24).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that occur elsewhere too."""
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1 at 150 % of their words."""
    plan = mix.plan_mix(documents(spark, sf_dir))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 4).alias("target"),
                       (F.col("size") * F.col("copies")).alias("taken"))


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines removed from every document."""
    out = line_chunks.line_chunk_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines",
                      F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's marginal probability under the subword lattice, and that of a plain word model."""
    out = lm_score.lattice_scores(documents(spark, sf_dir), vocab_path=PIECES)
    return out.withColumn("base_score", F.round("base_score", 6)).withColumn("score", F.round("score", 6))


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block of lines that may be a license notice, with the license that explains it best."""
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text."""
    return exact.exact_dedup(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers linked where their bytes overlap."""
    texts, _ = align.alignment(documents(spark, sf_dir), path_a=BYTES, path_b=PIECES, keep=("doc_id",))
    return texts.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by four rules and by what its redirects and canonical links lead to."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(documents(spark, sf_dir, "pages"), rules, keep=("page_id",)).select(
        "page_id", "host", "path", "rule", "verdict", "blocked_by")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases of two to four words."""
    return collocate.collocations(documents(spark, sf_dir)).withColumnRenamed("grp", "lang")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline.py over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_quality": op2_quality,
        "op3_jaccard": op3_jaccard,
        "op4_shard": op4_shard,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_mix": op6_mix,
        "op7_line_chunks": op7_line_chunks,
        "op8_lattice": op8_lattice,
        "op9_license": op9_license,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_align": op11_align,
        "op12_url_filter": op12_url_filter,
        "op13_collocations": op13_collocations,
        "pipeline": pipeline,
    }


OP1_SQL = r"""
WITH low AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
tok AS (
  SELECT kind, id, text, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[a-z0-9]|[^\x00-\x7F])+') AS w
  FROM low),
stride AS (SELECT greatest(32, max(len(w))) AS s FROM tok WHERE kind = 'i'),
-- the last sentence of an item is its answer
cut AS (
  SELECT id AS item_id, w, regexp_extract(rtrim(rtrim(text), '.!?'), '^(.*[.!?])[^.!?]+$', 1, 's') AS q FROM tok WHERE kind = 'i'),
nq AS (
  SELECT item_id, w, CASE WHEN q <> '' THEN len(regexp_extract_all(lower(q), '(?:[a-z0-9]|[^\x00-\x7F])+'))
                          ELSE len(w) - greatest(1, len(w) // 4) END AS k FROM cut),
parts AS (SELECT item_id, 'q' AS part, w[1:k] AS p FROM nq UNION ALL SELECT item_id, 'a', w[k + 1:] FROM nq),
part_sh AS (
  SELECT item_id, part, unnest(CASE WHEN len(p) = 0 THEN [] WHEN len(p) < 5 THEN [array_to_string(p, ' ')]
    ELSE list_distinct(list_transform(range(1, len(p) - 3), lambda i: array_to_string(p[i:i + 4], ' '))) END) AS sh, len(p) AS n
  FROM parts),
part_n AS (SELECT item_id, part, count(*) AS total FROM part_sh GROUP BY ALL),
windows AS (
  SELECT id AS doc_id, b, w[b + 1:b + 2 * s] AS p
  FROM tok, stride, unnest(range(0, greatest(len(w) - s, 1), s)) AS t(b) WHERE kind = 'd' AND len(w) > 0),
grams AS (
  SELECT DISTINCT doc_id, b, unnest(flatten(list_transform([1, 2, 3, 4, 5], lambda n:
    CASE WHEN len(p) < n THEN [] ELSE list_transform(range(1, len(p) - n + 2), lambda i: array_to_string(p[i:i + n - 1], ' ')) END))) AS sh
  FROM windows),
hits AS (
  SELECT g.doc_id, g.b, s.item_id, s.part, count(DISTINCT s.sh) AS c FROM grams g JOIN part_sh s ON g.sh = s.sh GROUP BY ALL),
shares AS (SELECT doc_id, b, h.item_id, h.part, c / total AS share FROM hits h JOIN part_n n ON h.item_id = n.item_id AND h.part = n.part),
both_parts AS (
  SELECT doc_id, b, item_id, coalesce(max(share) FILTER (part = 'q'), 0) AS q, coalesce(max(share) FILTER (part = 'a'), 0) AS a
  FROM shares GROUP BY ALL),
need AS (SELECT item_id, count(*) FILTER (part = 'q') = 0 AS no_q, count(*) FILTER (part = 'a') = 0 AS no_a FROM part_n GROUP BY ALL)
SELECT doc_id, b.item_id, count(*) AS n_passages, round(max(CASE WHEN no_q THEN 1 ELSE q END), 6) AS question_overlap,
       round(max(CASE WHEN no_a THEN 1 ELSE a END), 6) AS answer_overlap
FROM both_parts b JOIN need n ON b.item_id = n.item_id
WHERE (no_q OR q >= 0.8) AND (no_a OR a >= 0.8) GROUP BY doc_id, b.item_id
"""

OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
tok AS (SELECT doc_id, n, unnest(s) AS t FROM sized),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS total, count(*) AS c
  FROM tok a JOIN tok b ON a.t = b.t AND a.doc_id <> b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * c >= 80 * (total - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.y, s.doc_id)) AS component_id
FROM sized s LEFT JOIN least_of l ON s.doc_id = l.x
"""

OP6_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, source_size, 2.0 * source_size AS most,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
levels(k, lvl) AS (
  SELECT 0, CAST(0 AS DOUBLE)
  UNION ALL
  SELECT k + 1, (SELECT (1.5 * sum(source_size) - sum(CASE WHEN most <= lvl * w THEN most ELSE 0 END))
                        / sum(CASE WHEN most > lvl * w THEN w END) FROM src)
  FROM levels WHERE k < 60),
top AS (SELECT max(lvl) AS lvl FROM levels),
rates AS (
  SELECT source, source_size, least(most, lvl * w) AS target,
         CASE WHEN source_size > 0 THEN least(most, lvl * w) / source_size ELSE 0 END AS rate
  FROM src, top)
SELECT s.doc_id, s.size, r.source_size, round(r.target, 4) AS target,
       s.size * CAST(floor(rate) + CASE WHEN
         CAST(CAST('0x' || substr(md5('23|' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
         / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
"""

OP7_SQL = r"""
WITH docs AS (
  SELECT DISTINCT doc_id, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
hashed AS (
  SELECT *, list_transform(lines, lambda l: CAST('0x' || substr(md5(l), 1, 8) AS BIGINT)) AS h FROM docs),
ended AS (
  SELECT *, list_filter(range(1, len(lines) + 1),
    lambda i: i = len(lines) OR (i >= 2 AND (h[i - 1] * 31 + h[i]) % 4 = 0)) AS ends FROM hashed),
chunks AS (
  SELECT doc_id, body, j, CASE WHEN j = 1 THEN 1 ELSE ends[j - 1] + 1 END AS a, ends[j] AS b, lines
  FROM ended, unnest(range(1, len(ends) + 1)) AS t(j)),
texts AS (
  SELECT doc_id, body, j, a, b - a + 1 AS n, array_to_string(lines[a:b], chr(10)) AS chunk FROM chunks),
marked AS (
  SELECT *, n >= 2 AND row_number() OVER (PARTITION BY chunk, n >= 2 ORDER BY doc_id NULLS LAST, a) > 1 AS gone FROM texts),
kept AS (
  SELECT doc_id, body, sum(n) AS n_lines, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks,
         coalesce(sum(n) FILTER (gone), 0) AS n_removed_lines,
         coalesce(string_agg(chunk, chr(10) ORDER BY j) FILTER (NOT gone), '') AS kept_text
  FROM marked GROUP BY doc_id, body)
SELECT d.doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_chunks AS BIGINT) AS n_chunks,
       CAST(n_removed_chunks AS BIGINT) AS n_removed_chunks, CAST(n_removed_lines AS BIGINT) AS n_removed_lines,
       sha256(kept_text) AS kept_sha256
FROM documents d JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND coalesce(d.text, '') = k.body
"""

OP10_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS sha FROM documents),
r AS (
  SELECT *, row_number() OVER w AS k, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY sha) AS size
  FROM n WINDOW w AS (PARTITION BY sha ORDER BY len DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, size AS group_size, k = 1 AS kept, sha AS text_sha256 FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1_SQL, "op3_jaccard": OP3_SQL, "op6_mix": OP6_SQL, "op7_line_chunks": OP7_SQL, "op10_exact_dedup": OP10_SQL,
            "op12_url_filter": OP12_SQL, "op13_collocations": OP13_SQL}
