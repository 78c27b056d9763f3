"""Aggregations used by marts and quality metrics. All combine map-side."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import as_column
from ..functions.predicates import expr_true


def row_count(df: DataFrame, where: Column | str | None = None) -> DataFrame:
    """One row ``n``: all rows, or the rows for which the condition is true."""
    n = F.count(F.lit(1)) if where is None else F.count_if(F.coalesce(expr_true(where), F.lit(False)))
    return df.agg(n.alias("n"))


def count_distinct(c: Column | str, approx: bool = False) -> Column:
    """Distinct non-NULL values; ``approx`` uses a fixed-size sketch instead."""
    return F.approx_count_distinct(as_column(c)) if approx else F.count_distinct(as_column(c))


def count_flag(c: Column | str) -> Column:
    """Rows whose flag is true; a NULL flag counts as 0."""
    return F.sum(F.when(as_column(c), F.lit(1)).otherwise(F.lit(0)))


def count_col(c: Column | str) -> Column:
    """Non-NULL values."""
    return F.count(as_column(c))


def first_and_last(ts: str) -> list[Column]:
    """Earliest and latest timestamp, as aggregates."""
    return [F.min(as_column(ts)).alias(f"first_{ts}"), F.max(as_column(ts)).alias(f"last_{ts}")]


def first_last(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Earliest and latest timestamp per key."""
    return df.groupBy(as_column(key)).agg(*first_and_last(ts))


def sum_by(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Sum of a column per key."""
    return df.groupBy(*[as_column(k) for k in keys]).agg(F.sum(as_column(col)).alias(col))


def frequencies(df: DataFrame, cols: list[str], digest: bool = False) -> DataFrame:
    """Rows per distinct key, as the key columns and ``n``.

    With ``digest`` text keys are replaced by their SHA-256, so that long texts
    are hashed where they are read and only 64 characters each are shuffled.
    """
    types = dict(df.dtypes)
    keys = [
        (F.sha2(as_column(c), 256) if digest and types[c] == "string" else as_column(c)).alias(c) for c in cols
    ]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


#: Rank error of the sketch that brackets a median, as one part in so many, and how far to each side the bracket reaches.
SKETCH_ACCURACY = 10_000
BRACKET = 2.5 / SKETCH_ACCURACY


def exact_median(df: DataFrame, keys: list[str], value: Column | str, out: str) -> DataFrame:
    """Interpolated median per group without holding a group in one task and without a job of its own.

    A quantile sketch per group, merged map-side, gives two values around the
    middle. A second pass counts what lies below them and keeps only the values
    between, merged into (group, value, count): about one in 1,400 of a large
    group's values, each once however often it occurs. A running count over those
    finds the one or two middle values. The sketch only chooses what is kept; the
    ranks are counted, and a bracket that missed the middle would raise instead
    of giving another value. A text that is no number counts as NULL; groups
    without a value have no row.
    """
    group = [as_column(k) for k in keys]
    values = df.select(*group, as_column(value).try_cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    # Percentages are ranks of the sketch: both middle values of a small group are in it exactly.
    around = F.percentile_approx("__v", [0.5 - BRACKET, 0.5 + BRACKET], SKETCH_ACCURACY)
    sketched = values.groupBy(*group).agg(around.alias("__around"), F.count(F.lit(1)).alias("__all"))
    bracket = sketched.select(
        *[as_column(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__around")[0].alias("__low"), F.col("__around")[1].alias("__high"), "__all",
    )
    if keys:
        same = reduce(operator.and_, [as_column(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
        met = values.join(bracket, same)
    else:
        # One row for the whole table.
        met = values.withColumn("__one", F.lit(1)).join(F.broadcast(bracket.withColumn("__one", F.lit(1))), "__one")
    # All rows below the bracket become one row per group, with a NULL value.
    kept = F.when(F.col("__v") >= F.col("__low"), F.col("__v")).alias("__x")
    counts = met.filter(F.col("__v") <= F.col("__high")).groupBy(*group, kept).agg(
        F.count(F.lit(1)).alias("__n"), F.first("__all").alias("__all")
    )
    by_value = Window.partitionBy(*group).orderBy(F.col("__x").asc_nulls_first())
    ranked = counts.withColumn("__upto", F.sum("__n").over(by_value.rowsBetween(Window.unboundedPreceding, 0)))
    # A value is in the middle when its rank range covers one of the two middle ranks.
    low, high = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    start = F.col("__upto") - F.col("__n") + 1

    def at(rank: Column) -> Column:
        return F.max(F.when((start <= rank) & (F.col("__upto") >= rank), F.col("__x")))

    middle = ranked.groupBy(*group).agg(at(low).alias("__a"), at(high).alias("__b"))
    missed = F.raise_error(F.lit("the bracket of a median missed the middle")).cast("double")
    return middle.select(*group, F.coalesce((F.col("__a") + F.col("__b")) / 2, missed).alias(out))
