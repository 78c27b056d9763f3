"""Connected components of a link table, as alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

MAX_ROUNDS = 60


def _saved(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The table written to the shared folder and read again, which cuts the lineage, and its checksum."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    again = spark.read.schema(df.schema).parquet(path)
    total = again.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return again, tuple(total)


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node.

    ``links`` has columns ``u`` and ``v`` (long). The result has one row
    (``node``, ``root``) for every node that is linked to a smaller one; a root
    itself has no row. Links with a null end and loops are ignored; repeated
    links and both directions may occur. Without links the result is empty.

    Every round is a grouping and a join of the link table; nothing but a
    checksum of it reaches the driver.
    """
    edges = (
        links.filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges, before = _saved(edges, "links")
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges, now = _saved(small, "links")
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
