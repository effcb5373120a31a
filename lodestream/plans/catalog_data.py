"""Checked queries: reading, cleaning, splitting, validating, segmenting."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.functions import parse
from lodestream.functions.text import preview
from lodestream.operators import clean, logs, segment, split, validate
from lodestream.plans import views
from lodestream.plans.registry import query, table


@query(
    "clean_corpus",
    """
    SELECT doc_id AS cid, text FROM documents
    WHERE doc_id % 11 <> 0 AND doc_id % 17 <> 0 AND doc_id % 19 <> 0
    """,
)
def clean_corpus(spark, sf):
    """Ids as CSV hops leave them (missing, ``7.0``, junk), missing texts."""
    raw = views.corpus(spark, sf).selectExpr(
        "CASE WHEN cid % 11 = 0 THEN NULL WHEN cid % 17 = 0 THEN concat('x', cid) "
        "WHEN cid % 13 = 0 THEN concat(cid, '.0') ELSE string(cid) END AS cid",
        "CASE WHEN cid % 19 = 0 THEN NULL ELSE text END AS text",
    )
    return clean.clean_corpus(raw)


def _literal(col):
    """A text as a single-quoted list-literal item."""
    escaped = F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.concat(F.lit("'"), F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("'"))


@query(
    "parse_lists",
    """
    SELECT conv_id, turn, CAST(0 AS INT) AS pos, text AS item FROM conversations
    UNION ALL
    SELECT conv_id, turn, CAST(1 AS INT) AS pos, role AS item FROM conversations WHERE role <> 'assistant'
    """,
)
def parse_lists(spark, sf):
    """List literals with escapes next to plain texts."""
    item = F.concat(F.lit("["), _literal(F.col("text")), F.lit(", \""), F.col("role"), F.lit("\"]"))
    raw = table(spark, sf, "conversations").withColumn(
        "context", F.when(F.col("role") == "assistant", F.col("text")).otherwise(item)
    )
    lists = parse.with_text_list(raw.select("conv_id", "turn", "context"), "context")
    return lists.select("conv_id", "turn", F.posexplode("context").alias("pos", "item"))


@query(
    "parse_ids",
    """
    SELECT doc_id, unnest(CASE WHEN doc_id % 5 = 0 THEN [doc_id, doc_id + 1] WHEN doc_id % 5 = 1 THEN [doc_id]
                               ELSE [doc_id * 2] END) AS cid,
           CASE WHEN doc_id % 5 IN (0, 1) THEN doc_id ELSE doc_id * 2 END AS first_cid
    FROM documents WHERE doc_id % 5 < 3
    """,
)
def parse_ids(spark, sf):
    """Scalar and list ids; text without an id gives no row."""
    raw = table(spark, sf, "documents").selectExpr(
        "doc_id",
        "CASE doc_id % 5 WHEN 0 THEN concat('[', doc_id, ', ', doc_id + 1, ']') WHEN 1 THEN string(doc_id) "
        "WHEN 2 THEN concat('[', doc_id * 2, ']') WHEN 3 THEN '[]' ELSE source END AS id_text",
    )
    parsed = raw.select(
        "doc_id", F.explode(parse.id_list(F.col("id_text"))).alias("cid"), parse.first_id(F.col("id_text")).alias("first_cid")
    )
    return parsed


@query(
    "dedup_first",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1
    """,
)
def dedup_first(spark, sf):
    """P5 on the orders of each customer."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return clean.first_per_key(rows, "o_custkey", "o_orderkey")


@query(
    "last_row_per_key",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r = 1
    """,
)
def last_row_per_key(spark, sf):
    """P6."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return clean.last_per_key(rows, "o_custkey", "o_orderkey")


@query(
    "quality_filter",
    """
    SELECT doc_id AS cid, text FROM (
      SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r
      FROM documents WHERE length(text) BETWEEN 10 AND 5000) WHERE r = 1
    """,
)
def quality_filter(spark, sf):
    """D1."""
    return clean.quality_filter(views.corpus(spark, sf)).select("cid", "text")


@query(
    "positive_pairs",
    f"WITH train AS ({views.TRAIN_SQL}) SELECT qid, trim(question) AS query, trim(reply) AS positive FROM train",
)
def positive_pairs(spark, sf):
    """One row per context, blank contexts dropped."""
    train = views.train_pairs(spark, sf).select("qid", "question", F.array(F.lit("  "), "reply").alias("context"))
    return clean.positive_pairs(train)


@query(
    "skipped_rows",
    """
    SELECT count(*) AS rows_in, count(*) FILTER (WHERE role = 'system') AS rows_skipped FROM conversations
    """,
)
def skipped_rows(spark, sf):
    """G1: rows that give no pair."""
    rows = table(spark, sf, "conversations").withColumn(
        "context", F.when(F.col("role") == "system", F.array(F.lit(" "))).otherwise(F.array("text"))
    )
    return clean.skipped_rows(rows)


_SPLIT_SQL = """
    SELECT doc_id, CASE
      WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT < 3006477107 THEN 'train'
      WHEN ('0x' || substr(md5('43:' || doc_id), 1, 8))::BIGINT < 1431655765 THEN 'test' ELSE 'val' END AS split
    FROM documents
"""


@query("hash_split", _SPLIT_SQL)
def hash_split(spark, sf):
    """T6."""
    return split.hash_split(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query("split_sizes", f"SELECT split, count(*) AS n FROM ({_SPLIT_SQL}) GROUP BY split")
def split_sizes(spark, sf):
    """A18."""
    return split.split_sizes(split.hash_split(table(spark, sf, "documents").select("doc_id"), "doc_id"))


@query(
    "exact_split",
    """
    WITH r AS (SELECT doc_id, count(*) OVER () AS n,
        row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT, doc_id) - 1 AS pos FROM documents),
    s AS (SELECT *, CAST(ceil(round(n * 0.3, 9)) AS BIGINT) AS held FROM r)
    SELECT doc_id, CASE WHEN pos < n - held THEN 'train'
      WHEN pos < n - CAST(ceil(round(held / 3.0, 9)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
    FROM s
    """,
)
def exact_split(spark, sf):
    """T6 with exact sizes."""
    return split.exact_split(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(
    "seeded_sample",
    """
    SELECT o_orderkey, o_custkey FROM orders
    ORDER BY ('0x' || substr(md5('42:' || o_orderkey), 1, 8))::BIGINT, o_orderkey LIMIT 1000
    """,
)
def seeded_sample(spark, sf):
    """T4: a sampling operator; 1000 is its n."""
    return split.seeded_sample(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 1000)


@query(
    "shuffled_batches",
    """
    SELECT doc_id, CAST(floor((row_number() OVER (
      ORDER BY ('0x' || substr(md5('42:1:' || doc_id), 1, 8))::BIGINT, doc_id) - 1) / 64) AS BIGINT) AS batch_id
    FROM documents
    """,
)
def shuffled_batches(spark, sf):
    """Batches of 64 in the order of epoch 1."""
    return split.with_batches(table(spark, sf, "documents").select("doc_id"), "doc_id", 64, epoch=1)


@query("first_rows", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 500")
def first_rows(spark, sf):
    """First n rows by input order; the limit is the operator."""
    return split.first_rows(table(spark, sf, "events").select("event_id", "value"), "event_id", 500)


@query(
    "null_counts",
    """
    WITH d AS (SELECT d.doc_id, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT 'text' AS "column", count(*) FILTER (WHERE text IS NULL) AS nulls FROM d
    UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM d
    UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM d
    """,
)
def null_counts(spark, sf):
    """A14."""
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return validate.null_counts(joined, ["text", "quality", "toxic"])


@query("duplicate_keys", "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicates FROM lineitem")
def duplicate_keys(spark, sf):
    """A15."""
    return validate.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "validation_verdict",
    f"""
    WITH train AS ({views.TRAIN_SQL}),
    t AS (SELECT 'train' AS table_name, count(*) AS row_count,
            count(*) FILTER (WHERE question IS NULL) + count(*) FILTER (WHERE cid % 7 = 0) AS null_values, true AS valid FROM train
          UNION ALL SELECT 'corpus', count(*), count(*) FILTER (WHERE text IS NULL),
            count(*) FILTER (WHERE text IS NULL OR doc_id IS NULL) = 0 FROM documents)
    SELECT * FROM t
    UNION ALL SELECT 'all', CAST(sum(row_count) AS BIGINT), CAST(sum(null_values) AS BIGINT), bool_and(valid) FROM t
    """,
)
def validation_verdict(spark, sf):
    """A16 with P7 and P8; some contexts are null, which only warns."""
    train = views.train_pairs(spark, sf).select(
        "question", F.when(F.col("cid") % 7 != 0, F.array("reply")).alias("context"), F.array("cid").alias("cid"), "qid"
    )
    return validate.validation_verdict(train, views.corpus(spark, sf).select("cid", "text"))


_UNITS_SQL = r"""
    w AS (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b FROM (
            SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM (
              SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda t: length(t) > 0) AS words FROM documents))),
    s AS (SELECT a AS word, count(*) AS n FROM w GROUP BY 1),
    p AS (SELECT a, b, count(*) AS n FROM w WHERE b IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5),
    units AS (SELECT a || ' ' || b AS pair, p.n AS n,
        (p.n - 5.0) * (SELECT sum(n) FROM s) / (s1.n * s2.n) AS score
      FROM p JOIN s s1 ON s1.word = a JOIN s s2 ON s2.word = b
      WHERE (p.n - 5.0) * (SELECT sum(n) FROM s) / (s1.n * s2.n) > 10)
"""


@query("learned_units", f"WITH {_UNITS_SQL} SELECT pair, n, round(score, 6) AS score FROM units")
def learned_units(spark, sf):
    """F5, first pass."""
    return segment.learn_units(views.corpus(spark, sf)).select("pair", "n", F.round("score", 6).alias("score"))


@query(
    "segmented_text",
    f"""
    WITH {_UNITS_SQL},
    g AS (SELECT doc_id, i, a || CASE WHEN b IS NULL THEN '' WHEN pair IS NULL THEN ' ' ELSE chr(1) END AS piece
          FROM w LEFT JOIN units ON pair = a || ' ' || b)
    SELECT doc_id AS cid, coalesce(replace(regexp_replace(string_agg(piece, '' ORDER BY i),
             '([^ ' || chr(1) || ']+)' || chr(1) || '([^ ' || chr(1) || ']+)', '\\1_\\2', 'g'), chr(1), ' '), '') AS text
    FROM documents LEFT JOIN g USING (doc_id) GROUP BY doc_id
    """.replace("\\\\", "\\"),
)
def segmented_text(spark, sf):
    """F5, second pass, over whole texts."""
    docs = views.corpus(spark, sf).select("cid", "text")
    return segment.segment(docs, segment.learn_units(docs), "cid")


@query(
    "segment_lists",
    f"""
    WITH {_UNITS_SQL},
    parts AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
                list_filter(string_split_regex(text, '\\s+'), lambda t: length(t) > 0) AS words FROM conversations),
    x AS (SELECT conv_id, pos, i, words[i] AS a, words[i + 1] AS b FROM (
            SELECT conv_id, pos, words, unnest(range(1, len(words) + 1)) AS i FROM parts)),
    g AS (SELECT conv_id, pos, i, a || CASE WHEN b IS NULL THEN '' WHEN pair IS NULL THEN ' ' ELSE chr(1) END AS piece
          FROM x LEFT JOIN units ON pair = a || ' ' || b),
    t AS (SELECT conv_id, pos, coalesce(replace(regexp_replace(string_agg(piece, '' ORDER BY i),
             '([^ ' || chr(1) || ']+)' || chr(1) || '([^ ' || chr(1) || ']+)', '\\1_\\2', 'g'), chr(1), ' '), '') AS text
          FROM parts LEFT JOIN g USING (conv_id, pos) GROUP BY conv_id, pos)
    SELECT conv_id, string_agg(text, ' | ' ORDER BY pos) AS texts FROM t GROUP BY conv_id
    """.replace("\\\\", "\\"),
)
def segment_lists(spark, sf):
    """every turn of a conversation, with the units of the corpus."""
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    lists = turns.select("conv_id", F.col("t.text").alias("texts"))
    done = segment.segment_lists(lists, segment.learn_units(views.corpus(spark, sf)), "conv_id", "texts")
    return done.withColumn("texts", F.array_join("texts", " | "))


@query(
    "loose_settings",
    """
    SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS INT), -1) AS k,
           coalesce(try_cast(json_extract_string(props, '$.missing') AS DOUBLE), 0.5) AS missing,
           event_id % 3 = 0 AS flag
    FROM events
    """,
)
def loose_settings(spark, sf):
    """F8: lenient numbers and flags with defaults, from JSON text."""
    return table(spark, sf, "events").select(
        "event_id",
        parse.safe_int(F.get_json_object("props", "$.k"), -1).alias("k"),
        parse.safe_float(F.get_json_object("props", "$.missing"), 0.5).alias("missing"),
        parse.safe_bool(F.when(F.col("event_id") % 3 == 0, "Yes").otherwise(F.col("event_type"))).alias("flag"),
    )


@query(
    "text_previews",
    """
    SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview FROM documents
    """,
)
def text_previews(spark, sf):
    """F7."""
    return table(spark, sf, "documents").select("doc_id", preview(F.col("text")).alias("preview"))


@query(
    "embedding_metadata",
    """
    SELECT count(*) AS num_documents, CAST(max(len(embedding)) AS INT) AS embedding_dim FROM embeddings
    """,
)
def embedding_metadata(spark, sf):
    """What is stored next to the vectors."""
    return views.vectors(spark, sf).agg(
        F.count("*").alias("num_documents"), F.max(F.size("embedding")).alias("embedding_dim")
    )


_LINES_SQL = """
    SELECT date_trunc('second', ts) AS ts, 'user' || user_id AS logger,
           CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
           event_type || ' ' || event_id AS message
    FROM events
"""


def log_lines(spark, sf):
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    return table(spark, sf, "events").select(
        F.concat(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" - user"), F.col("user_id").cast("string"), F.lit(" - "),
            level, F.lit(" - "), F.col("event_type"), F.lit(" "), F.col("event_id").cast("string"),
        ).alias("value")
    )


@query("parsed_log", _LINES_SQL)
def parsed_log(spark, sf):
    """F11, F12."""
    return logs.parse_lines(log_lines(spark, sf)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "error_log_tail",
    f"SELECT * FROM ({_LINES_SQL}) WHERE level = 'ERROR' ORDER BY ts DESC, message LIMIT 100",
)
def error_log_tail(spark, sf):
    """A most-recent-first report of 100 lines."""
    return logs.error_tail(parsed_log(spark, sf))
