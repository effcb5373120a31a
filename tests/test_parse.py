import pytest
from pyspark.sql import functions as F

from lodestream.functions import parse
from lodestream.functions.text import preview

TEXTS = {
    "['a','b']": ["a", "b"],
    "[\"it's\",'x']": ["it's", "x"],
    "[]": [],
    "[12, 13]": ["12", "13"],
    "plain": ["plain"],
    "[None,'z']": [None, "z"],
    "['a\\xa0b']": ["a\xa0b"],
    "['it\\'s', 'x\\n']": ["it's", "x\n"],
    "[broken": ["[broken"],
    "['a'] ['b']": ["['a'] ['b']"],
    "['a' 'b']": ["ab"],
    "'quoted'": ["quoted"],
    "[true]": ["[true]"],
    "['null', 'x']": ["null", "x"],
    None: None,
}


def test_text_list(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r.t: r.l for r in df.select("t", parse.text_list(F.col("t")).alias("l")).collect()}
    assert got == TEXTS
    assert {r.t: r.l for r in parse.with_text_list(df, "t", "l").collect()} == TEXTS


def test_usual_lists_stay_in_the_jvm(spark):
    """Escapes that mean the same in both are read there; only what is left is sent to Python."""
    import ast

    texts = [r"""['it\'s', "a\"b", 'x\\y', 'n\n\t\r']""", r"['end\\']", "[]", "['a', 2, 3.5]", "plain", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(parse._unsettled(F.col("t"))).count() == 0
    got = {r.t: r.l for r in parse.with_text_list(df, "t", "l").collect()}
    assert got[texts[0]] == ast.literal_eval(texts[0]) and got[texts[1]] == ["end\\"] and got["plain"] == ["plain"]
    hard = spark.createDataFrame([(t,) for t in (r"['\x41']", r"['\101']", r"['a\\\x42']", "[['a']]", "['a' 'b']")], "t string")
    assert hard.where(parse._unsettled(F.col("t"))).count() == 5
    assert sorted(r.l for r in parse.with_text_list(hard, "t", "l").collect()) == sorted([["A"], ["A"], ["a\\B"], ["['a']"], ["ab"]])


@pytest.mark.parametrize(
    "text,ids,first",
    [("7", [7], 7), ("[7, 8]", [7, 8], 7), ("[]", None, None), ("abc", None, None), (None, None, None),
     ("7.0", [7], 7), ("['7']", [7], 7), ("[7, x]", None, None), ("[7, null]", None, 7)],
)
def test_ids(spark, text, ids, first):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(parse.id_list(F.col("t")).alias("l"), parse.first_id(F.col("t")).alias("f")).first()
    assert (row.l, row.f) == (ids, first)


def test_safe_casts(spark):
    df = spark.createDataFrame([("7", 0), ("x", 2), (None, None)], "t string, n int")
    rows = df.select(
        parse.safe_int(F.col("t"), 5).alias("i"),
        parse.safe_float(F.col("t"), 0.5).alias("f"),
        parse.safe_bool(F.col("t")).alias("b"),
        parse.safe_bool(F.col("n"), True, numeric=True).alias("nb"),
    ).collect()
    assert [tuple(r) for r in rows] == [(7, 7.0, False, False), (5, 0.5, False, True), (5, 0.5, False, True)]
    yes = spark.createDataFrame([("YES",), ("1",), ("true",), ("no",)], "t string")
    assert [r[0] for r in yes.select(parse.safe_bool(F.col("t"))).collect()] == [True, True, True, False]


def test_preview(spark):
    df = spark.createDataFrame([("x" * 200,), ("y" * 201,)], "t string")
    assert [len(r[0]) for r in df.select(preview(F.col("t"))).collect()] == [200, 203]
