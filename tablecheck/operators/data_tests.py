"""Data tests on built models. Each returns its failing records; none means passed.

NULL passes every test except :func:`test_not_null`. The functions are plain
transformations, so a failing-record count is ``.count()`` on the result.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column
from ..functions.predicates import expr_true, in_set
from .aggregates import frequencies
from .joins import orphans


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows with a NULL in the column."""
    return df.filter(as_column(col).isNull())


def unique(df: DataFrame, col: str, digest: bool = False) -> DataFrame:
    """Non-NULL values that occur more than once, with their count ``n``."""
    return frequencies(df, [col], digest).filter(as_column(col).isNotNull() & (F.col("n") > 1))


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows with a non-NULL key that is absent from the parent."""
    return orphans(child, parent, col, field)


def accepted_values(df: DataFrame, col: str, values: str | Iterable[str]) -> DataFrame:
    """Non-NULL values outside the list, with their count ``n``.

    The rows are filtered before they are grouped, so good values never shuffle.
    """
    return frequencies(df.filter(as_column(col).isNotNull() & ~in_set(col, values)), [col])


def expression_is_true(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows for which the condition is false; a NULL outcome passes."""
    return df.filter(~expr_true(condition))


def freshness(df: DataFrame, loaded_at: str, now: str | Column, warn_after: timedelta = timedelta(hours=24)) -> DataFrame:
    """Age of the newest row at ``now``: ``max_loaded_at, age_seconds, status``.

    The status is ``warn`` when the age exceeds ``warn_after`` or no row exists.
    """
    at = (F.lit(now) if isinstance(now, str) else now).cast("timestamp")
    newest = df.agg(F.max(as_column(loaded_at).try_cast("timestamp")).alias("max_loaded_at"))
    age = F.unix_micros(at) - F.unix_micros("max_loaded_at")
    limit = int(warn_after.total_seconds() * 1_000_000)
    return newest.select(
        "max_loaded_at",
        F.floor(age / 1_000_000).alias("age_seconds"),
        F.when(age <= limit, F.lit("pass")).otherwise(F.lit("warn")).alias("status"),
    )
