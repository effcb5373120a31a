"""One key holds a third or more of the rows: results stay whole and equal."""

import subprocess
import sys

from pyspark.sql import functions as F

from lodestream.operators import clean, mining, rerank, split, telemetry, validate


def hot(spark, n=30_000):
    return spark.range(n).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))


def test_dedup_and_duplicates(spark):
    df = hot(spark)
    first = clean.first_per_key(df, "k", "id")
    assert first.count() == df.select("k").distinct().count() == 20_001
    assert first.where("k = 0").first().id == 0
    assert validate.duplicate_keys(df, "k").first().duplicates == 30_000 - 20_001


def test_first_per_key_combines_before_the_shuffle(spark):
    plan = clean.first_per_key(hot(spark), "k", "id")._jdf.queryExecution().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_hot_text_and_request(spark):
    docs = hot(spark, 3000).select(F.col("id").alias("cid"), F.concat(F.lit("some text "), F.col("k").cast("string")).alias("text"))
    assert clean.quality_filter(docs).count() == 2001
    scored = hot(spark).select(F.col("k").alias("request_id"), F.col("id").alias("pos"), (F.col("id") % 97 / 97.0).alias("score"), F.lit(100).alias("top_n"))
    best = rerank.top_documents(scored)
    assert best.where("request_id = 0").count() == 100
    assert "WindowGroupLimit" in best._jdf.queryExecution().toString()


def test_hot_worker_and_window(spark):
    events = hot(spark).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 600).alias("ts"),
        F.lit("e").alias("endpoint"), F.lit("a").alias("action"), F.lit("success").alias("status"), F.col("k").alias("worker_id"),
    )
    assert telemetry.cold_starts(events).count() == 20_001
    total = telemetry.request_rate(events, "30 seconds").agg(F.sum(F.col("rate") * 30)).first()[0]
    assert round(total) == 30_000


def test_hot_query_in_mining(spark):
    ranking = spark.range(10_000).select(F.lit(1).cast("bigint").alias("qid"), F.col("id").alias("cid"), (1 - F.col("id") / 1e6).alias("score"))
    queries = spark.createDataFrame([(1, "q", [0, 2])], "qid bigint, question string, cid array<bigint>")
    kept = mining.hard_negatives(queries, ranking, 3).orderBy("neg_rank").collect()
    assert [r.negative_cid for r in kept] == [1, 3, 4]


def test_no_whole_table_window(spark):
    """Ranking a table never moves all rows to one task."""
    plan = split.seeded_rank(spark.range(100_000), "id")._jdf.queryExecution().toString()
    whole = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert "hashpartitioning(_bucket" in plan and len(whole) <= 2


def test_kernels_need_no_package_on_workers(tmp_path, sf):
    """A driver started elsewhere can still run the kernels."""
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "from lodestream.session import build_session\n"
        "s = build_session('x', 'local[2]', spark__ui__enabled='false', spark__sql__shuffle__partitions='2')\n"
        f"print('rows', e.queries()['topk_exact'](s, {sf!r}).count())\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert "rows 25000" in out.stdout, out.stderr[-2000:]


def test_ranks_move_keys_only(spark):
    """No whole row and no whole table goes through a window or one task, however small the table."""
    df = spark.range(50).withColumn("payload", F.repeat(F.lit("x"), 1000))
    plan = split.seeded_rank(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    window = next(line for line in plan.splitlines() if "Window [" in line)
    assert "payload" not in window
    for cut in (split.exact_split(df, "id"), split.seeded_sample(df, "id", 7)):
        assert "Exchange" not in cut._jdf.queryExecution().executedPlan().toString()


def test_cuts_equal_ranks(spark, monkeypatch):
    """Radix selection cuts where the ranking does, also where many keys share a bucket or a hash."""
    monkeypatch.setattr(split, "hash32", lambda seed, key: F.pmod(F.hash(F.lit(str(seed)), F.col(key)).cast("bigint"), F.lit(97)) * 3)
    for df in (spark.range(2000), spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("id"))):
        place = {r["id"]: r["pos"] for r in split.seeded_rank(df, "id").collect()}
        assert sorted(place.values()) == list(range(2000))
        for n in (0, 1, 2, 500, 777, 1999, 2000, 5000):
            assert {r["id"] for r in split.seeded_sample(df, "id", n).collect()} == {k for k, p in place.items() if p < n}
        parts = {r["id"]: r["split"] for r in split.exact_split(df, "id").collect()}
        assert all(parts[k] == ("train" if p < 1400 else "val" if p < 1800 else "test") for k, p in place.items())
