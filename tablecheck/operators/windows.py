"""Window operators whose hot partitions are split, and small set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import as_column
from ..sources.scratch import scratch_path
from .joins import hot_keys, is_hot

_CELL = "__cell"
_LOCAL = "__local"


def _range_cells(df: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """The rows dealt out in the order of partition and order columns, each with the number of its range.

    Ranges are cut by the distribution of the rows, wherever it lies, so none
    grows beyond its portion unless rows are equal in all columns. They are written to the
    shared folder, as the ranges of a second run need not be the same.
    """
    spark = df.sparkSession
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = scratch_path(spark, "ranges")
    by = [as_column(c) for c in [*partition, *order]]
    df.repartitionByRange(n, *by).withColumn(_CELL, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _shifted(cells: DataFrame, partition: list[str], size: Column, local: Column, out: str, total: str | None) -> DataFrame:
    """``local``, computed inside each cell, plus the size of the earlier cells of its partition."""
    key = F.struct(*[as_column(p).alias(f"p{i}") for i, p in enumerate(partition)], F.col(_CELL).alias("cell"))
    keyed = cells.withColumn(_CELL, key)
    owner = [F.col(f"{_CELL}.p{i}") for i in range(len(partition))]
    before = Window.partitionBy(*owner).orderBy(f"{_CELL}.cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy(_CELL).agg(size.alias("__size")).select(
        _CELL,
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"),
        F.sum("__size").over(Window.partitionBy(*owner)).alias("__total"),
    )
    joined = keyed.withColumn(_LOCAL, local).join(offsets, _CELL)
    plain = [as_column(c) for c in cells.columns if c != _CELL]
    extra = [] if total is None else [F.col("__total").alias(total)]
    # A cell of which nothing has been counted yet has no running value.
    value = F.when(F.col(_LOCAL).isNull() & (F.col("__offset") == 0), F.lit(None)).otherwise(
        F.coalesce(F.col(_LOCAL), F.lit(0)) + F.col("__offset")
    )
    return joined.select(*plain, value.alias(out), *extra)


def ordinal(
    df: DataFrame, partition: str, order: list[str], out: str, cells_from: DataFrame | None = None, **limits
) -> DataFrame:
    """``row_number`` over ``partition`` by ``order`` (end it with a unique tie-break).

    Partitions with more rows than a task should take, NULL among them, are dealt
    out in ranges of the whole order; rows are numbered inside their range and
    shifted by the size of the earlier ranges of their partition. Where no
    partition is that large, this is the plain window. ``cells_from`` is a frame
    with the same rows that is cheaper to count than ``df``. ``limits`` as in
    :func:`~tablecheck.operators.joins.hot_keys`.
    """
    by = [as_column(o) for o in order]
    hot = hot_keys(df if cells_from is None else cells_from, [partition], nulls=True, **limits)

    def numbered(frame: DataFrame) -> DataFrame:
        w = Window.partitionBy(as_column(partition)).orderBy(*by)
        return frame.withColumn(out, F.row_number().over(w).cast("bigint"))

    if not hot:
        return numbered(df)
    cells = _range_cells(df.filter(is_hot([partition], hot)), [partition], order)
    local = F.row_number().over(Window.partitionBy(_CELL).orderBy(*by))
    split = _shifted(cells, [partition], F.count(F.lit(1)), local, out, None)
    return numbered(df.filter(~is_hot([partition], hot))).union(split.withColumn(out, F.col(out).cast("bigint")))


def running_sum(
    df: DataFrame,
    partition: list[str],
    order: list[str],
    value: str,
    out: str,
    total: str | None = None,
    split: bool = False,
    **limits,
) -> DataFrame:
    """Running total of ``value`` over ``partition`` by ``order``.

    ``total`` names a further column for the total of the whole partition.
    Without ``split`` a task holds a whole partition, which suits aggregated
    series. With it, partitions above the ``limits`` (as in
    :func:`~tablecheck.operators.joins.hot_keys`) are dealt out in ranges of the
    order as in :func:`ordinal`.
    """
    by = [as_column(o) for o in order]

    def summed(frame: DataFrame) -> DataFrame:
        keys = [as_column(p) for p in partition]
        w = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        more = {} if total is None else {total: F.sum(as_column(value)).over(Window.partitionBy(*keys))}
        return frame.withColumns({out: F.sum(as_column(value)).over(w), **more})

    hot = hot_keys(df, partition, nulls=True, **limits) if split else []
    if not hot:
        return summed(df)
    cells = _range_cells(df.filter(is_hot(partition, hot)), partition, order)
    w = Window.partitionBy(_CELL).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifted = _shifted(cells, partition, F.sum(as_column(value)), F.sum(as_column(value)).over(w), out, total)
    return summed(df.filter(~is_hot(partition, hot))).union(shifted)


def cumulative(series: DataFrame, day: str, value: str, out: str, keys: list[str] | None = None) -> DataFrame:
    """All-time running total of a series that has one row per day (and key).

    A day without a value keeps the total reached before it.
    """
    return running_sum(series, keys or [], [day], value, out)


def growth_pct(current: Column | str, previous: Column | str) -> Column:
    """Change against the earlier value in percent; NULL when that is 0 or missing."""
    cur, prev = as_column(current), as_column(previous)
    return F.try_divide((cur - prev).cast("double") * 100, prev.cast("double"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of a table, for looking at it."""
    return df.limit(n)


def union_frames(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out
