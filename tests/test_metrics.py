import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestream.operators import losses, pair_metrics, pooling, ranking_metrics, runs


@pytest.fixture(scope="module")
def ranked(spark):
    """q1: hits at 2 and 4 of 3 true; q2: no hit; q3: no truth; q4: nothing retrieved."""
    ranking = spark.createDataFrame(
        [(1, i + 1, c) for i, c in enumerate([10, 11, 12, 13])] + [(2, 1, 20), (3, 1, 30)], "qid bigint, rank int, cid bigint"
    ).withColumn("score", 1.0 / F.col("rank"))
    queries = spark.createDataFrame([(1, [11, 13, 99]), (2, [77]), (3, []), (4, [5])], "qid bigint, cid array<bigint>")
    return ranking, queries


def test_ranking_golden(ranked):
    ranking, queries = ranked
    sizes, qrels = ranking_metrics.truth_from_lists(queries)
    judged = ranking_metrics.judge(ranking, qrels)
    got = {r.metric: r.value for r in ranking_metrics.mean_metrics(
        ranking_metrics.per_query(judged, sizes, (1, 2), (5,), (3,), set_recall=True)).collect()}
    dcg = 1 / math.log2(3)
    ideal = 1 + 1 / math.log2(3) + 1 / math.log2(4)
    assert got["recall@1"] == 0 and got["recall@2"] == 0.25 == got["hit_rate@2"]
    assert got["set_recall@2"] == pytest.approx(1 / 3 / 4)
    assert got["precision@5"] == pytest.approx(2 / 5 / 4)
    assert got["ndcg@3"] == pytest.approx(dcg / ideal / 4)
    assert got["mrr"] == pytest.approx(0.5 / 4)
    assert got["map"] == pytest.approx((1 / 2 + 2 / 4) / 3)
    standard = ranking_metrics.per_query(judged, sizes, (), (), (), use_mrr=False, standard_map=True)
    assert ranking_metrics.mean_metrics(standard).first().value == pytest.approx((1 / 2 + 2 / 4) / 3 / 3)


def test_failed_cases(ranked):
    ranking, queries = ranked
    judged = ranking_metrics.judge(ranking, ranking_metrics.truth_from_lists(queries)[1])
    failed = {r.qid: r.top_cids for r in ranking_metrics.failed_cases(queries.select("qid"), judged).collect()}
    assert failed == {2: [20], 3: [30], 4: None}


def pairs(spark, rows):
    return spark.createDataFrame(rows, "score double, label int")


def auc(spark, rows):
    return pair_metrics.roc_auc(pairs(spark, rows)).first().auc_roc


def test_auc(spark):
    assert auc(spark, [(0.1, 0), (0.4, 1), (0.35, 0), (0.8, 1)]) == 1.0
    assert auc(spark, [(0.5, 0), (0.5, 1), (0.5, 1)]) == 0.5
    assert auc(spark, [(0.5, 1), (0.7, 1)]) == 0.0
    random.seed(1)
    rows = [(random.randrange(30) / 30, random.randrange(2)) for _ in range(500)]
    wins = [(a > b) + (a == b) / 2 for a, la in rows if la for b, lb in rows if not lb]
    value = auc(spark, rows)
    assert value == pytest.approx(sum(wins) / len(wins))
    assert auc(spark, [(math.exp(3 * s), y) for s, y in rows]) == pytest.approx(value)
    assert auc(spark, [(-s, y) for s, y in rows]) == pytest.approx(1 - value)


def test_counts_at_threshold_and_one_class(spark):
    row = pair_metrics.rates(pair_metrics.confusion_counts(pairs(spark, [(0.5, 1), (0.49, 1), (0.9, 1)]))).first()
    assert (row.true_positives, row.false_negatives, row.true_negatives, row.false_positives) == (2, 1, 0, 0)
    assert row.precision == 1 and row.recall == pytest.approx(2 / 3) == row.sensitivity and row.specificity == 0
    none = pair_metrics.rates(pair_metrics.confusion_counts(pairs(spark, [(0.1, 0)]))).first()
    assert none.precision == none.recall == none.f1 == 0 and none.accuracy == 1


def test_losses(spark):
    z = spark.createDataFrame([(2.0, 1), (-1.0, 0), (0.0, 1)], "logit double, label int")
    expected = np.mean([math.log1p(math.exp(-2)), math.log1p(math.exp(-1)), math.log(2)])
    assert losses.bce_from_logits(z).first().loss == pytest.approx(expected)
    m = spark.createDataFrame([(0.9, 0.1), (0.4, 0.3)], "pos_score double, neg_score double")
    assert losses.margin_loss(m).first().loss == pytest.approx(0.2)


@pytest.mark.parametrize("block", [1024, 7])
def test_inbatch_loss_brute_force(spark, block):
    rng = np.random.default_rng(3)
    q, p = rng.normal(size=(30, 5)), rng.normal(size=(30, 5))
    batch = [0 if i < 20 else 1 for i in range(30)]
    df = spark.createDataFrame(
        [(batch[i], i, q[i].tolist(), p[i].tolist()) for i in range(30)],
        "batch_id bigint, row_id bigint, query_vec array<double>, positive_vec array<double>",
    )
    got = {r.batch_id: r.loss for r in losses.inbatch_softmax(df, block_rows=block).collect()}
    for b, part in ((0, slice(0, 20)), (1, slice(20, 30))):
        s = 20 * q[part] @ p[part].T
        top = s.max(axis=1)
        lse = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        assert got[b] == pytest.approx(float(np.mean(lse - np.diag(s))))
    cached = {r.cache_id: r.loss for r in losses.cached_inbatch_softmax(df, cache_size=20).collect()}
    assert cached[0] == pytest.approx(got[0]) and cached[1] is None


def test_pooling(spark):
    rows = [(1, 0, 1, [1.0, 2.0]), (1, 1, 0, [9.0, 9.0]), (1, 2, 1, [3.0, 0.0]), (2, 5, 0, [4.0, 4.0])]
    df = spark.createDataFrame(rows, "doc_id bigint, pos int, mask int, vec array<float>")
    get = lambda out: {r.doc_id: list(r.embedding) for r in out.collect()}
    assert get(pooling.mean_pool(df)) == {1: [2.0, 1.0], 2: [0.0, 0.0]}
    assert get(pooling.max_pool(df)) == {1: [3.0, 2.0], 2: [0.0, 0.0]}
    assert get(pooling.first_token_pool(df)) == {1: [1.0, 2.0], 2: [4.0, 4.0]}


def test_epochs(spark):
    curves = {1: [1.0, 0.9995, 0.9992, 0.9991, 0.5], 2: [1.0, 0.5, 0.6, 0.4, 0.4], 3: [0.3]}
    df = spark.createDataFrame([(r, e, v) for r, c in curves.items() for e, v in enumerate(c, 1)], "run_id int, epoch int, val_loss double")
    assert {r.run_id: r.best_epoch for r in runs.best_epoch(df).collect()} == {1: 5, 2: 4, 3: 1}
    assert {r.run_id: r.stop_epoch for r in runs.early_stop(df).collect()} == {1: 4, 2: None, 3: None}


def test_gate(spark):
    bi = spark.createDataFrame([("mrr", 0.35), ("recall@10", 0.6)], "metric string, value double")
    good = spark.createDataFrame([("true_positives", 3.0), ("auc_roc", 0.65), ("recall", 0.05)], "metric string, value double")
    row = runs.gate(bi, good).first()
    assert row.passed and row.cross_tp == 3
    assert "🟢 PASSED" in runs.gate_summary(runs.gate(bi, good)).first().message
    bad = good.withColumn("value", F.when(F.col("metric") == "true_positives", 0.0).otherwise(F.col("value")))
    assert not runs.gate(bi, bad).first().passed
    assert not runs.gate(bi.where("metric = 'mrr'"), good).first().passed


def test_auc_under_heavy_ties(spark):
    """999 of 1000 rows have one score: the zones still hold the others apart."""
    rows = [(0.5, i % 2) for i in range(9990)] + [(i / 10, int(i > 4)) for i in range(10)]
    df = spark.createDataFrame(rows, "score double, label int")
    pos, neg = [s for s, l in rows if l], [s for s, l in rows if not l]
    from collections import Counter

    p, n = Counter(pos), Counter(neg)
    exact = sum(c * sum(d * ((a > b) + (a == b) / 2) for b, d in n.items()) for a, c in p.items()) / (len(pos) * len(neg))
    assert pair_metrics.roc_auc(df).first()[0] == pytest.approx(exact)


def test_caches_fill_by_rows(spark):
    """Batches of any size over several ranges of batches: caches end where a plain walk ends them."""
    import random

    rng = random.Random(3)
    for most, size in ((9, 20), (50, 20), (1, 7)):
        sizes = [(b, rng.randint(0, most)) for b in range(500)]
        want, held, number = {}, 0, 0
        for b, n in sizes:
            want[b] = number
            held += n
            if held >= size:
                held, number = 0, number + 1
        table = spark.createDataFrame(sizes, "batch_id bigint, n bigint").repartition(5)
        assert {r["batch"]: r["cache_id"] for r in losses.caches(table, size).collect()} == want
    assert losses.caches(table.limit(0), 5).count() == 0
