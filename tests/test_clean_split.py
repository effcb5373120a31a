import pytest
from pyspark.sql import functions as F

from lodestream.operators import clean, segment, split, validate


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, None)], "n int, cid int, text string")
    first = {r.cid: r.text for r in clean.first_per_key(df, "cid", "n").collect()}
    last = {r.cid: r.text for r in clean.last_per_key(df, "cid", "n").collect()}
    assert first == {1: "a", 2: None} and last == {1: "b", 2: None}


def test_clean_train(spark):
    raw = spark.createDataFrame(
        [("q1", "['a', ' ', 'b']", "[3, 4]", 1), ("q2", "plain", "x", 2), ("q3", "c", "5", 3)],
        "question string, context string, cid string, qid bigint",
    )
    train = clean.clean_train(raw)
    assert {r.qid: list(r.cid) for r in train.collect()} == {1: [3, 4], 3: [5]}
    assert {r.qid: list(r.cid) for r in clean.clean_train(raw, first_only=True).collect()} == {1: [3], 3: [5]}
    assert sorted((r.query, r.positive) for r in clean.positive_pairs(train).collect()) == [("q1", "a"), ("q1", "b"), ("q3", "c")]


def test_drop_null_keys(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), ("2", None)], "cid string, text string")
    assert [tuple(r) for r in clean.drop_null_keys(df, {"cid": "bigint", "text": "string"}).collect()] == [(1, "a")]


def test_lookup_and_resolution(spark):
    pairs = spark.createDataFrame([(1, 7, None), (0, 7, 8), (0, 7, None), (0, 7, 99)], "label int, p bigint, n bigint")
    corpus = spark.createDataFrame([(7, "seven"), (8, "eight")], "cid bigint, text string")
    keyed = pairs.withColumn("k", clean.resolved_document(F.col("label"), F.col("p"), F.col("n")))
    got = sorted((r.label, r.k, r.document) for r in clean.attach_text(keyed, corpus, "k").collect())
    assert got == [(0, 7, "seven"), (0, 8, "eight"), (0, 99, ""), (1, 7, "seven")]


def test_split_is_stable(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    a = {r.o_orderkey: r.split for r in split.hash_split(orders, "o_orderkey").collect()}
    b = {r.o_orderkey: r.split for r in split.hash_split(orders.repartition(5).where("o_orderkey > 100"), "o_orderkey").collect()}
    assert all(a[k] == v for k, v in b.items()) and set(a.values()) == {"train", "val", "test"}
    exact = split.exact_split(orders, "o_orderkey").groupBy("split").count()
    assert {r["split"]: r["count"] for r in exact.collect()} == {"train": 1050, "val": 300, "test": 150}


def test_seeded_rank_is_a_permutation(spark):
    df = spark.range(5000)
    pos = [r.pos for r in split.seeded_rank(df, "id").collect()]
    assert sorted(pos) == list(range(5000))
    again = split.seeded_rank(df.repartition(7), "id").orderBy("pos").select("id")
    assert [r.id for r in split.seeded_rank(df, "id").orderBy("pos").collect()] == [r.id for r in again.collect()]
    sample = {r.id for r in split.seeded_sample(df, "id", 700).collect()}
    assert sample == {r.id for r in again.limit(700).collect()}
    assert split.seeded_sample(df, "id", 9000).count() == 5000
    other = [r.id for r in split.seeded_shuffle(df, "id", epoch=1).orderBy("pos").collect()]
    assert other != [r.id for r in again.collect()]


def test_validation(spark):
    df = spark.createDataFrame([(1, None), (1, "b"), (None, "c"), (None, None)], "cid int, text string")
    assert {r.column: r.nulls for r in validate.null_counts(df, ["cid", "text"]).collect()} == {"cid": 2, "text": 2}
    assert validate.duplicate_keys(df, "cid").first().duplicates == 2
    with pytest.raises(ValueError):
        validate.require_columns(df, ["question"])
    verdict = {r.table_name: r.valid for r in validate.validation_verdict(df, df).collect()}
    assert verdict == {"train": False, "corpus": False, "all": False}


def test_segmentation(spark):
    docs = spark.createDataFrame(
        [(1, "new york city new york"), (2, "x a a a"), (3, None), (4, "  "), (5, "york new")], "cid int, text string"
    )
    units = spark.createDataFrame([("new york",), ("york city",), ("x a",), ("a a",)], "pair string")
    got = {r.cid: r.text for r in segment.segment(docs, units, "cid").collect()}
    assert got == {1: "new_york city new_york", 2: "x_a a_a", 3: "", 4: "", 5: "york new"}
    lists = spark.createDataFrame([(1, ["new york", "york city"]), (2, [])], "cid int, ctx array<string>")
    got = {r.cid: list(r.ctx) for r in segment.segment_lists(lists, units, "cid", "ctx").collect()}
    assert got == {1: ["new_york", "york_city"], 2: []}
    upper = {r.cid: r.text for r in segment.segment_with(docs, F.upper).collect()}
    assert upper[5] == "YORK NEW" and upper[3] == "" and upper[4] == "  "


def test_segmentation_with_and_without_held_units(spark):
    """Units that tasks hold and units that travel to their texts give the same texts."""
    import random

    rng = random.Random(1)
    docs = spark.createDataFrame([(i, " ".join(rng.choices("abcde", k=rng.randint(0, 30))) or None) for i in range(300)], "cid bigint, text string")
    units = spark.createDataFrame([(p, *p.split()) for p in ("a b", "b c", "c c", "e a", "d e")], "pair string, first string, second string")
    held, sent = ({r.cid: r.text for r in segment.segment(docs, units, "cid", held_units=n).collect()} for n in (10, 2))
    assert held == sent and held.keys() == set(range(300))
    pairs = {"a b", "b c", "c c", "e a", "d e"}
    for row in docs.collect():
        words, out = (row.text or "").split(), []
        while words:
            if " ".join(words[:2]) in pairs and len(words) > 1:
                out.append("_".join(words[:2]))
                words = words[2:]
            else:
                out.append(words.pop(0))
        assert held[row.cid] == " ".join(out)


def test_units_that_travel(spark, monkeypatch):
    """Only pairs that pass the filter are moved; the units are learned once; keys may be null or repeat."""
    monkeypatch.setattr(segment, "FILTER_WORDS", 64)
    learned = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            learned.add(batch.num_rows)
            yield batch

    pairs = ["a b", "b c", "c c", "e a", "é z"]
    units = spark.createDataFrame([(p,) for p in pairs], "pair string").coalesce(1).mapInArrow(count, "pair string")
    rows = [(None, ["a b c", "x  y"]), (None, ["c c c", None, "é z"]), (1, ["q\te a"]), (1, []), (2, None), (3, ["", "a b c"])]
    docs = spark.createDataFrame(rows, "cid bigint, texts array<string>").repartition(3)
    done = segment.segment_lists(docs, units, "cid", "texts", held_units=2)
    wanted = [(k, [segment.joined(t, frozenset(pairs)) for t in texts or []]) for k, texts in rows]
    assert sorted(map(str, ((r.cid, list(r.texts)) for r in done.collect()))) == sorted(map(str, wanted))
    assert learned.value == len(pairs)
    flat = docs.select("cid", F.explode("texts").alias("text"))
    done = segment.segment(flat, units, "cid", held_units=2)
    assert sorted(r.text for r in done.collect()) == sorted(t for _, texts in wanted for t in texts)
    assert learned.value == 2 * len(pairs)
    table = segment._filter(spark.createDataFrame([("a b",)], "pair string"))
    assert "a b" in segment._passing(["x a b x", None], table)
    assert len(segment._passing([" ".join(f"w{i}" for i in range(1000))], table)) < 100
