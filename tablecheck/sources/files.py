"""File scans and null-token normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Texts that stand for NULL in uploaded files.
NULL_TOKENS = ("", "null", "NULL", "NaN")


def normalize_nulls(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Replace null tokens by NULL in text columns; other columns are left alone."""
    return df.replace(list(tokens), None)


def read_csv(spark: SparkSession, path: str, delimiter: str = ";") -> DataFrame:
    """CSV with a header; every column is text, so no inference pass is needed."""
    return normalize_nulls(spark.read.option("header", True).option("delimiter", delimiter).csv(path))


def read_json(spark: SparkSession, path: str, lines: bool = False, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON file holding an array of objects, or JSON Lines.

    An array file is read by one task, which suits small ones; large array files
    are read by :func:`~tablecheck.sources.json_array.read_json_array` in many. JSON
    Lines (``lines=True``) split by themselves; a schema saves the inference scan.
    """
    reader = spark.read.option("multiline", not lines)
    if schema is not None:
        reader = reader.schema(schema)
    return normalize_nulls(reader.json(path))


def load_seed(spark: SparkSession, path: str, schema: T.StructType | str, name: str | None = None) -> DataFrame:
    """Comma-separated seed file with quoted fields and a declared schema.

    With ``name`` the seed is also registered as a view.
    """
    df = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    if name is not None:
        df.createOrReplaceTempView(name)
    return df
