"""Registered queries against their SQL, and the pipeline."""

import oracle
import pytest

import corpus_pipeline
from lodestream.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    con = oracle.connect(sf)
    df = QUERIES[name](spark, sf)
    assert oracle.type_differences(df, con, ORACLES[name]) == {}
    assert oracle.spark_rows(df) == oracle.duck_rows(con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_pipeline(spark, sf):
    packed = corpus_pipeline.run(spark, sf)
    by_sequence = {r[0]: r[1] for r in packed.groupBy("sequence_id").agg({"length": "sum"}).collect()}
    assert by_sequence and max(by_sequence.values()) <= 2048


def test_stages_on_odd_rows(spark, sf, odd):
    docs = odd.drop("n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
        got.count()
