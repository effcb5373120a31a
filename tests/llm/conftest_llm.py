import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))

# Nulls in any column, empty and very long texts, ties and repeated rows.
ODD = [
    (1, "one two three four five six\nseven eight nine ten eleven twelve", "en", "a"),
    (1, "one two three four five six\nseven eight nine ten eleven twelve", "en", "a"),
    (1, "another text under the same id", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (None, "a row without an id", "en", "b"),
    (None, None, None, None),
    (4, " \t\n\r ", "de", None),
    (5, LONG, "fr", "c"),
    (6, "one two three four five six\nseven eight nine ten eleven twelve", "en", "b"),
    (-7, "éè ñ œ ß 中文 \U0001f600 it's 12'34", "es", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
CLASHING = "_row _key _pos _all _n _k _block side term d h l k key c n m at size target copies fingerprint component_id score part piece start length".split()


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with further columns whose names operators use inside."""
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    return docs.withColumns({name: F.lit(name) for name in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
