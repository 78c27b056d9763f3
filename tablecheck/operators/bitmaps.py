"""Referential integrity of whole-number keys by bitmaps.

Keys fall into buckets of 32,768 neighbours, and a bucket is one bitmap. One
grouping of both sides by bucket tells, for each bucket, which keys the parent
has, which keys occur at all, and how many child rows fall in. Where nothing but
the parent's keys occurs, all rows of the bucket match, and no key has been moved.
Only the rows of the other buckets are looked at again, each by one bit.

This suits dense keys, such as running numbers: a bucket is then a few kilobytes
instead of thousands of keys. Keys of other types, or of two types, are compared
as in :mod:`~tablecheck.operators.joins`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_column
from ..sources.scratch import saved
from . import joins

_BUCKET, _BITS = "__bucket", "__bits"


def dense_keys(child: DataFrame, parent: DataFrame, col: str, col2: str) -> bool:
    """Whether both keys are whole numbers, so that bitmaps can hold them."""
    types = [df.select(as_column(c)).schema.fields[0].dataType for df, c in ((child, col), (parent, col2))]
    return all(isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for t in types)


def _has_bit(bits: Column, key: Column) -> Column:
    at = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def key_bits(child: DataFrame, parent: DataFrame, col: str, col2: str) -> DataFrame:
    """One row per bucket of either side's keys: child rows ``n``, and bitmaps of ``every`` key and of ``theirs``, the parent's."""
    sides = child.select(as_column(col).cast("long").alias("k"), F.lit(True).alias("mine")).union(
        parent.select(as_column(col2).cast("long").alias("k"), F.lit(False).alias("mine")).filter("k IS NOT NULL")
    )
    at = F.bitmap_bit_position("k")
    return sides.groupBy(F.bitmap_bucket_number("k").alias(_BUCKET)).agg(
        F.count_if("mine").alias("n"),
        F.bitmap_construct_agg(at).alias("every"),
        F.bitmap_construct_agg(F.when(~F.col("mine"), at)).alias("theirs"),
    )


def key_buckets(child: DataFrame, parent: DataFrame, col: str, col2: str) -> DataFrame:
    """One row per bucket with child rows: their number ``n`` and, if some key is absent, the parent's ``bits``.

    Rows with a NULL key are the bucket NULL. Both sides are read once, at once,
    and the buckets are written to the shared folder.
    """
    absent = F.bitmap_count("every") > F.bitmap_count("theirs")
    found = key_bits(child, parent, col, col2).filter("n > 0")
    return saved(found.select(_BUCKET, "n", F.when(absent, F.col("theirs")).alias(_BITS)), "buckets")


def orphans(child: DataFrame, parent: DataFrame, col: str, col2: str, buckets: DataFrame | None = None) -> DataFrame:
    """Child rows with a non-NULL key that the parent does not have.

    ``buckets`` are those of :func:`key_buckets`, if they are known. Keys that
    bitmaps cannot hold are anti-joined.
    """
    if not dense_keys(child, parent, col, col2):
        return joins.orphans(child, parent, col, col2)
    found = key_buckets(child, parent, col, col2) if buckets is None else buckets
    key = as_column(col).cast("long")
    open_buckets = found.filter(F.col(_BITS).isNotNull()).select(_BUCKET, _BITS)
    met = child.filter(key.isNotNull()).withColumn(_BUCKET, F.bitmap_bucket_number(key)).join(open_buckets, _BUCKET)
    return met.filter(~_has_bit(F.col(_BITS), key)).select(*[as_column(c) for c in child.columns])


def orphan_keys(child: DataFrame, parent: DataFrame, col: str, col2: str) -> DataFrame:
    """Non-NULL child keys that the parent does not have, with their row counts ``n``; only those are shuffled."""
    rows = orphans(child.select(as_column(col)), parent, col, col2)
    return rows.groupBy(as_column(col).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def integrity(child: DataFrame, parent: DataFrame, col: str, col2: str) -> DataFrame:
    """One row ``total, matched, value``: child rows, those whose key the parent has, and their share (NULL without rows)."""
    if dense_keys(child, parent, col, col2):
        found = key_buckets(child, parent, col, col2)
        keyed = F.col(_BUCKET).isNotNull()
        known = found.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(keyed, F.col("n"))), F.lit(0)).alias("keyed")
        )
        lost = orphans(child.select(as_column(col)), parent, col, col2, found).agg(F.count(F.lit(1)).alias("lost"))
        counts = joins.combine_metrics(known, lost, []).select("total", (F.col("keyed") - F.col("lost")).alias("matched"))
    else:
        keys = joins.key_match(child, parent, col, col2)
        matched = F.sum(F.when(F.col("matched"), F.col("n")))
        counts = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(matched, F.lit(0)).alias("matched"))
    return counts.select("total", "matched", F.try_divide("matched", "total").alias("value"))
