"""Date spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: ten years of 365 days.
SPINE_DAYS = 3650


def date_spine(spark: SparkSession, end: Column | str, n_days: int = SPINE_DAYS) -> DataFrame:
    """One row per day, ``date_day``, from ``n_days`` before ``end`` up to it.

    ``end`` is a date text or a column, for example a scalar subquery.
    """
    last = (F.lit(end) if isinstance(end, str) else end).cast("date")
    first = F.date_sub(last, n_days)
    days = F.sequence(first, last, F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))
