"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.llm import (
    bin_packing,
    dual_tree,
    html_crf,
    line_dedup,
    mil_quality,
    mixing,
    simhash,
    suffix_dedup,
    surrogates,
    turn_repair,
    url_cascade,
    weighted_fingerprint,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_main_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


@query(
    "op2_line_dedup",
    r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(len(ls))) AS l, unnest(ls) AS line FROM s),
w AS (SELECT DISTINCT doc_id, l, unnest(regexp_extract_all(line, '[^ 	-
]+')) AS word FROM l),
n AS (SELECT doc_id, l, count(*) AS n FROM w GROUP BY ALL),
x AS (SELECT w.*, n.n FROM w JOIN n USING (doc_id, l)),
p AS (SELECT a.doc_id, a.l, a.n, b.doc_id AS d2, b.l AS l2, b.n AS n2, count(*) AS o FROM x a JOIN x b ON a.word = b.word
      AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.l < a.l)) AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n) GROUP BY ALL),
g AS (SELECT DISTINCT doc_id, l FROM p WHERE 10 * o >= 8 * (n + n2 - o)),
k AS (SELECT l.doc_id, count(*) AS n_lines, count(g.l) AS n_removed,
             coalesce(string_agg(l.line, chr(10) ORDER BY l.l) FILTER (g.l IS NULL), '') AS kept
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.l = g.l GROUP BY l.doc_id)
SELECT doc_id, n_lines::INT AS n_lines, n_removed::INT AS n_removed, sha256(kept) AS kept_sha256 FROM k
""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.stripped(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce(F.col("_row.text"), F.lit("")).cast("binary"), 256)
    return kept.select(F.col("_row.doc_id").alias("doc_id"), "n_lines", "n_removed", digest.alias("kept_sha256"))


@query("op3_weighted_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query("op4_dual_tree_top_k")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return dual_tree.top_k(vectors.where(F.col("vec_id") % 100 == 0), vectors)


@query(
    "op5_mix_sources",
    r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w FROM t),
o AS (SELECT *, coalesce(sum(3 * source_size) OVER p, 0) AS stopped, sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS weight_left,
             sum(source_size) OVER () AS total
      FROM w WINDOW p AS (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, w * (total - stopped) > 3 * source_size * weight_left AS above FROM o),
r AS (SELECT sum(source_size) - coalesce(sum(3 * source_size) FILTER (above), 0) AS r, sum(w) FILTER (NOT above) AS w FROM c),
g AS (SELECT source, source_size, CASE WHEN above THEN (3 * source_size)::DOUBLE ELSE (c.w * r.r)::DOUBLE / r.w END AS target FROM c, r),
s AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target * 16777216 / source_size)::BIGINT, 50331648) ELSE 0 END AS step,
             floor((('0x' || substr(md5('17:' || coalesce(source, '')), 1, 8))::BIGINT) / 256)::BIGINT AS start FROM g),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS pos FROM d)
SELECT p.doc_id, p.size::BIGINT AS size, s.source_size, s.target,
       (p.size * ((step * pos + start) // 16777216 - (step * (pos - 1) + start) // 16777216))::BIGINT AS taken
FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", (F.col("n_removed") > 0).alias("repeated"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op7_quality_attention")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_pack_sequences")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op9_surrogates")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.anonymised(table(spark, sf_dir, "documents"))
    return replaced.select(F.col("_row.doc_id").alias("doc_id"), "n_entities", F.col("_row.text").alias("text"))


@query("op10_simhash_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.withColumn("fingerprint", simhash.hexadecimal(F.col("fingerprint")))


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_repair.damaged(table(spark, sf_dir, "conversations"))
    return turn_repair.audits(turns, F.col("absent"))


@query(
    "op12_url_cascade",
    r"""
WITH r(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                       ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM u),
f AS (SELECT p.n, r.host || r.path AS rule, r.verdict FROM p JOIN r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
b AS (SELECT n, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict FROM f GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN b USING (n)
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_cascade.RULES, url_cascade.RULE_SCHEMA)
    judged = url_cascade.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select(F.col("_row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_of(table(spark, sf_dir, "embeddings"), 4)
