"""Materialising models."""

from __future__ import annotations

from pyspark.sql import DataFrame

VIEW = "view"
TABLE = "table"


def materialize(
    df: DataFrame, name: str, kind: str, path: str | None = None, cluster_by: list[str] | None = None, buckets: int = 0
) -> DataFrame:
    """Register a model as a temporary view or write it as a table, and read it back.

    ``cluster_by`` with ``buckets`` buckets and sorts the table, so that later
    joins and aggregations on those columns need no shuffle. ``path`` keeps the
    table's files outside the warehouse folder.
    """
    spark = df.sparkSession
    if kind == VIEW:
        df.createOrReplaceTempView(name)
    elif kind == TABLE:
        writer = df.write.mode("overwrite").format("parquet")
        if path is not None:
            writer = writer.option("path", path)
        if cluster_by:
            writer = writer.bucketBy(buckets, *cluster_by).sortBy(*cluster_by)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"unknown materialisation: {kind}")
    return spark.table(name)
