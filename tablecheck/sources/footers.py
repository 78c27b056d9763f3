"""Row counts, extremes and freshness of Parquet tables from file footers, without reading a data page."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_column

#: Types whose least and greatest values Spark takes from footers.
_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


@contextmanager
def footer_reads(spark: SparkSession) -> Iterator[None]:
    """Parquet frames that are read and run inside may answer aggregates from footers."""
    names = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def table_summary(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """One row: ``n`` and, for each column, ``min_<column>`` and ``max_<column>``.

    Runs at once. Counts and the extremes of numbers and days come from footers
    alone; columns of other types, such as timestamps and texts, whose footers
    Spark does not trust, are scanned in a second query over just these columns.
    """
    schema = spark.read.parquet(path).schema
    asked = columns or []
    light = [c for c in asked if isinstance(schema[c].dataType, _TYPES)]
    ends = lambda names: [f(as_column(c)).alias(f"{n}_{c}") for c in names for n, f in (("min", F.min), ("max", F.max))]
    found = {}
    with footer_reads(spark):
        row = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), *ends(light)).first()
        # Without a row group there is nothing to add up.
        found |= row.asDict() | {"n": row["n"] or 0}
    heavy = [c for c in asked if c not in light]
    if heavy:
        found |= spark.read.parquet(path).agg(*ends(heavy)).first().asDict()
    fields = [T.StructField("n", T.LongType())]
    fields += [T.StructField(f"{n}_{c}", schema[c].dataType) for c in asked for n in ("min", "max")]
    return spark.createDataFrame([tuple(found[f.name] for f in fields)], T.StructType(fields))
