import os

import pytest
from pyspark.sql import functions as F

from lodestream.operators import clean, split
from lodestream.sources import readers, writers


def test_csv_corpus(spark, tmp_path):
    path = tmp_path / "corpus.csv"
    path.write_text('text,cid,extra\n"line one\nline ""two"", end",1.0,x\nplain,2,y\n,3,z\nno id,,w\n')
    got = sorted(tuple(r) for r in clean.clean_corpus(readers.raw_corpus(spark, str(path))).collect())
    assert got == [(1, 'line one\nline "two", end'), (2, "plain")]


def test_csv_train(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text('question,context,cid,qid\nq?,"[\'a, b\', ""c\'s""]","[1, 2]",9\n')
    row = clean.clean_train(readers.raw_train(spark, str(path))).first()
    assert (row.qid, list(row.cid), list(row.context)) == (9, [1, 2], ["a, b", "c's"])
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(path), "nothing STRING")


def test_patterns_and_optional(spark, tmp_path):
    for name in ("a/x.csv", "a/y.txt", "b/z.csv"):
        os.makedirs(tmp_path / name.split("/")[0], exist_ok=True)
        (tmp_path / name).write_text("cid,text\n1,t\n")
    assert readers.read_matching(spark, str(tmp_path), "*.csv").count() == 2
    spark.range(3).write.parquet(str(tmp_path / "there"))
    found = readers.read_optional(spark, {"there": str(tmp_path / "there"), "gone": str(tmp_path / "gone")})
    assert list(found) == ["there"]


def test_embeddings_round_trip(spark, sf, tmp_path):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("cid"), "embedding")
    writers.write_embeddings(vectors, str(tmp_path / "e"), model_name="m", batch_size=64)
    back, meta = readers.read_embeddings(spark, str(tmp_path / "e"))
    row = meta.first()
    assert (row.num_documents, row.embedding_dim, row.model_name) == (500, 64, "m") and back.count() == 500
    report = readers.file_report(back).first()
    assert report.rows == 500 and report.bytes > 500 * 64 * 4 / 2


def test_splits_prune(spark, sf, tmp_path):
    docs = split.hash_split(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    writers.write_splits(docs, str(tmp_path / "s"))
    test = readers.read_split(spark, str(tmp_path / "s"), "test")
    assert test.count() == docs.where("split = 'test'").count()
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().toString()


def test_metrics_and_predictions(spark, tmp_path):
    metrics = spark.createDataFrame([("mrr", 0.5), ("recall@10", 0.75)], "metric string, value double")
    writers.write_metrics(metrics, str(tmp_path / "m"))
    assert sorted(tuple(r) for r in writers.read_metrics(spark, str(tmp_path / "m")).collect()) == [("mrr", 0.5), ("recall@10", 0.75)]
    ranking = spark.createDataFrame([(1, 2, 8, 0.1), (1, 1, 7, 0.2)], "qid bigint, rank int, cid bigint, score double")
    queries = spark.createDataFrame([(1, "q", [7])], "qid bigint, question string, cid array<bigint>")
    writers.write_predictions(queries, ranking, str(tmp_path / "p"))
    assert list(spark.read.parquet(str(tmp_path / "p")).first().predictions) == [7, 8]
    writers.export_csv(queries, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).first().cid == "[7]"


def test_csv_keeps_white_space(spark, tmp_path):
    rows = [(1, "  a\nb "), (2, 'say "x", \\ y\t')]
    writers.export_csv(spark.createDataFrame(rows, "cid bigint, text string"), str(tmp_path / "w"))
    assert sorted(tuple(r) for r in clean.clean_corpus(readers.raw_corpus(spark, str(tmp_path / "w"))).collect()) == rows
