import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestream.functions.vector import dot
from lodestream.operators import ranking_metrics
from lodestream.operators.topk import exact_topk


def exact_topk_sql(queries, corpus, k, exclude_self=False):
    """Every pair, for small fixtures only: what the kernels must equal."""
    pairs = queries.select("qid", F.col("embedding").alias("qv")).crossJoin(
        corpus.select("cid", F.col("embedding").alias("cv"))
    )
    if exclude_self:
        pairs = pairs.where("qid <> cid")
    scored = pairs.select("qid", "cid", F.round(dot(F.col("qv"), F.col("cv")), 9).alias("score"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rows(df):
    return sorted((r.qid, r["rank"], r.cid, r.score) for r in df.select("qid", "rank", "cid", "score").collect())


@pytest.fixture(scope="module")
def sides(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    return e.withColumnRenamed("vec_id", "qid"), e.withColumnRenamed("vec_id", "cid")


def test_forms_agree(sides):
    q, c = sides
    expected = rows(exact_topk_sql(q, c, 7, exclude_self=True))
    assert rows(exact_topk(q, c, 7, exclude_self=True)) == expected
    assert rows(exact_topk(q.repartition(3), c.repartition(5), 7, exclude_self=True, floor_rows=60)) == expected
    assert rows(exact_topk(q, c, 7, exclude_self=True, block_rows=150, floor_rows=0)) == expected
    assert rows(exact_topk(q, c, 7, exclude_self=True, block_bytes=64 * 8 * 200, floor_rows=40)) == expected


def test_ties_go_to_smaller_id(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "qid bigint, embedding array<float>")
    data = [(i, [0.5, float(i)]) for i in range(40, 0, -1)] + [(99, [0.9, 0.0])]
    c = spark.createDataFrame(data, "cid bigint, embedding array<float>").repartition(4)
    assert [r[2] for r in rows(exact_topk(q, c, 4))] == [99, 1, 2, 3]
    assert [r[2] for r in rows(exact_topk(q, c, 4, block_rows=1, floor_rows=5))] == [99, 1, 2, 3]


def test_small_corpus_and_no_queries(spark):
    q = spark.createDataFrame([(1, [1.0]), (2, [-1.0])], "qid bigint, embedding array<float>")
    c = spark.createDataFrame([(5, [1.0]), (6, [2.0])], "cid bigint, embedding array<float>")
    assert rows(exact_topk(q, c, 10)) == [(1, 1, 6, 2.0), (1, 2, 5, 1.0), (2, 1, 5, -1.0), (2, 2, 6, -2.0)]
    assert rows(exact_topk(q.where(F.lit(False)), c, 10)) == []


def test_hot_duplicates(spark):
    """A third of the corpus is one vector: nothing is lost or repeated."""
    rng = np.random.default_rng(0)
    vectors = [[float(x) for x in rng.normal(size=4)] for _ in range(400)] + [[1.0, 1.0, 1.0, 1.0]] * 200
    c = spark.createDataFrame(list(enumerate(vectors)), "cid bigint, embedding array<double>")
    q = c.select(F.col("cid").alias("qid"), "embedding")
    expected = rows(exact_topk_sql(q, c, 250))
    assert rows(exact_topk(q, c, 250)) == expected
    assert rows(exact_topk(q, c, 250, block_rows=200, floor_rows=70)) == expected


def test_odd_vectors(spark):
    schema = "cid bigint, embedding array<double>"
    q = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "qid bigint, embedding array<double>")
    for bad in ([(1, [1.0, 2.0, 3.0]), (2, [1.0] * 5), (3, [1.0])], [(1, [1.0, 2.0, 3.0]), (2, None)]):
        with pytest.raises(Exception, match="same dimension|is null"):
            exact_topk(q, spark.createDataFrame(bad, schema).coalesce(1), 2).collect()
    nan = [(1, [float("nan"), 0.0, 0.0]), (2, [3.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (4, [1.0, 0.0, 0.0])]
    assert [r[2] for r in rows(exact_topk(q, spark.createDataFrame(nan, schema), 3))] == [2, 3, 4]


def test_blocks_leave_one_table_and_no_broadcast(spark):
    """Several query blocks are ranked one after the other; what is left is a stored table."""
    vectors = spark.range(300).select(F.col("id").alias("qid"), F.array(F.sin("id"), F.cos("id")).alias("embedding"))
    corpus = vectors.withColumnRenamed("qid", "cid")
    got = exact_topk(vectors, corpus, 3, block_rows=100, floor_rows=20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Exchange" not in plan
    assert rows(got) == rows(exact_topk(vectors, corpus, 3))


def test_failed_cases(spark):
    judged = spark.createDataFrame([(1, 1, 10, 0), (1, 2, 11, 1), (2, 1, 12, 0), (2, 9, 13, 1)], "qid bigint, rank int, cid bigint, rel int")
    judged = judged.withColumn("score", F.lit(1.0))
    queries = spark.createDataFrame([(1,), (2,), (3,)], "qid bigint")
    got = {r.qid: r.top_cids for r in ranking_metrics.failed_cases(queries, judged, within=3, show=1).collect()}
    assert got == {2: [12], 3: None}


def test_many_queries_stay_on_the_executors(spark):
    """More than a block of queries: pairs of blocks are ranked by tasks, and no vector is collected."""
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in rng.normal(size=6)] for _ in range(500)] + [[0.5] * 6] * 40 + [[1e9, 0.0, 1e-9, 0.0, 0.0, 0.0]]
    c = spark.createDataFrame(list(enumerate(vectors)), "cid bigint, embedding array<float>").repartition(3).cache()
    q = c.select(F.col("cid").alias("qid"), "embedding").where("qid % 3 = 0").cache()
    for k in (5, 60, 1000):
        assert rows(exact_topk(q, c, k, exclude_self=True, block_rows=20)) == rows(exact_topk(q, c, k, exclude_self=True))
    collected, original = [], type(c).toArrow
    type(c).toArrow = lambda self: collected.append(1) or original(self)
    try:
        exact_topk(q, c, 5, block_rows=20)
    finally:
        type(c).toArrow = original
    assert not collected


def test_kernel_against_all_scores():
    """Slices of any size, floors, repeated vectors and large scores give the rows of all scores."""
    from lodestream.operators import topk

    rng = np.random.default_rng(5)
    q, c = rng.normal(size=(300, 8)), np.repeat(rng.normal(size=(2500, 8)), 2, axis=0)
    ids = rng.permutation(len(c))
    for scale, kind in ((1.0, np.float32), (1.0, np.float64), (1e-5, np.float64), (1e16, np.float64)):
        a, b = (q * scale).astype(kind), c.astype(kind)
        scores = np.rint(a.astype(float) @ b.astype(float).T * topk.SCALE) / topk.SCALE
        expected = [list(ids[np.lexsort((ids, -s))[:7]]) for s in scores]
        floors = np.sort(scores, axis=1)[:, -20]
        for low in (None, floors):
            running = topk._Running(np.arange(300), a, low, 7, False)
            for at in (0, 900, 3000):
                end = {0: 900, 900: 3000, 3000: 5000}[at]
                running.add(ids[at:end], b[at:end])
            found = {i: [] for i in range(300)}
            for part in running.rows():
                for i, cid, score in zip(*part):
                    found[int(i)].append((-score, int(cid)))
            assert [[cid for _, cid in sorted(found[i])] for i in range(300)] == expected


def test_single_precision_only_filters(monkeypatch):
    """Scores that differ by less than single precision tells apart are ranked by their exact values."""
    from lodestream.operators import topk

    rng = np.random.default_rng(11)
    kinds, keep = [], topk._Running._keep
    monkeypatch.setattr(topk._Running, "_keep", lambda self, part, here, scores, *rest: kinds.append(scores.dtype) or keep(self, part, here, scores, *rest))
    base, q = rng.normal(size=12), rng.normal(size=(270, 12))
    c = np.concatenate([base + rng.normal(size=(4000, 12)) * 1e-8, rng.normal(size=(1500, 12)), np.tile(base, (300, 1))])
    c, ids = c[rng.permutation(len(c))], rng.permutation(len(c))
    for scale, odd, kind in ((1.0, None, np.float32), (1e20, None, np.float64), (1.0, np.inf, np.float64), (1e-30, None, np.float32)):
        a, b = q * scale, c.copy()
        if odd:
            b[7, 3] = odd
        with np.errstate(all="ignore"):
            scores = np.rint(np.einsum("ij,kj->ik", a, b) * topk.SCALE) / topk.SCALE
        scores[~np.isfinite(scores)] = -np.inf
        scores[np.arange(270), np.argsort(ids)[:270]] = -np.inf
        expected = [[int(i) for i in ids[np.lexsort((ids, -s))[:9]]] for s in scores]
        kinds.clear()
        running = topk._Running(np.arange(270), a, None, 9, True)
        with np.errstate(all="ignore"):
            for at in range(0, len(c), 2900):
                running.add(ids[at : at + 2900], b[at : at + 2900])
        found = {i: [] for i in range(270)}
        for part in running.rows():
            for i, cid, score in zip(*part):
                found[int(i)].append((-score, int(cid)))
        same = [[cid for _, cid in sorted(found[i])] == expected[i] for i in range(270)]
        # Beyond a quantum the order of a sum decides; elsewhere every row is equal.
        assert all(same) if scale != 1e20 else sum(same) > 200
        assert kind in kinds


def test_a_task_per_pair_of_blocks(spark):
    """Pairs of blocks are neither dealt to the same task by a hash nor merged for having few bytes."""
    from lodestream.operators import topk

    queries, corpus = (spark.range(400).select(F.col("id").alias(name), F.array(F.sin("id"), F.cos("id")).alias("vec")) for name in ("qid", "cid"))
    cells = topk._cells(queries, corpus, 16, 2, 3, False)
    placed = cells.select("qid", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(placed) == 800 and len({r.p for r in placed}) == 32
