"""Readers. Any path Spark can open works, object storage included: raw files
are read where they are, never copied first."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream import schemas

log = logging.getLogger(__name__)

# Quoted fields may hold doubled quotes.
_CSV = {"header": "true", "escape": '"', "mode": "PERMISSIVE"}


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """CSV by column name: the file may order or add columns as it likes.

    With ``multi_line`` quoted fields may hold line breaks, and a file is one task;
    without, large files are split.
    """
    raw = spark.read.options(**_CSV, multiLine=multi_line).csv(path)
    wanted = [field.split()[0] for field in schema.split(", ")]
    kinds = dict(field.split(maxsplit=1) for field in schema.split(", "))
    missing = [c for c in wanted if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns in {path}: {missing}")
    return raw.select(*[F.col(c).try_cast(kinds[c].lower()).alias(c) for c in wanted])


def raw_corpus(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_CORPUS, multi_line)


def raw_train(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_TRAIN, multi_line)


def read_matching(spark: SparkSession, folder: str, pattern: str, fmt: str = "csv", schema: str | None = None) -> DataFrame:
    """Every file below ``folder`` whose name matches a glob."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if fmt == "csv":
        reader = reader.options(**_CSV, multiLine=True)
    return (reader.schema(schema) if schema else reader).format(fmt).load(folder)


def read_optional(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """The tables that exist; a missing one is reported and left out."""
    found = {}
    for name, path in paths.items():
        try:
            found[name] = spark.read.option("ignoreMissingFiles", "true").format(fmt).load(path)
        except AnalysisException as error:
            # Only a missing path may be skipped, not a wrong schema or a denied access.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("skipping %s: %s", name, error)
    return found


def read_embeddings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vectors, one metadata row) as written by ``write_embeddings``."""
    return spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/metadata")


def read_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One split of a partitioned table; the others are not listed."""
    return spark.read.parquet(path).where(F.col("split") == name)


def file_report(df: DataFrame) -> DataFrame:
    """Rows, files and bytes behind a file-based table.

    One row per file is kept before the sizes are added up.
    """
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.max("_metadata.file_size").alias("bytes")
    )
    return per_file.agg(F.sum("n").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
