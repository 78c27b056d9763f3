"""Uniqueness of any number of keys of a table, without moving long texts.

The first pass groups the rows by each key: by its cells as they are, but by a
hash for texts of more than ``SHORT`` bytes. Keys without such a text are counted
then, as is a hash met once. The second pass looks only at rows whose hash was
met again and counts their real keys, so a chance clash of hashes changes
nothing. Keys of numbers, days and short texts need no second pass.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_column
from ..sources.scratch import saved

#: What parts of a key are NULL: none, some, all.
FULL, PART, NONE = range(3)
#: Texts of more bytes are grouped by a hash first.
SHORT = 32
_COUNTS = ("rows", "null_rows", "part_null_rows", "once", "repeated_keys", "repeated_rows")


def _cells(df: DataFrame, names: list[str]) -> list[tuple[Column, bool]]:
    """The parts of a key as values to group by, and whether they are texts."""
    found = []
    for c in names:
        kind = df.select(as_column(c)).schema.fields[0].dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            raise ValueError(f"column {c} has a type that is no key: {kind.simpleString()}")
        text = isinstance(kind, T.StringType)
        found.append((as_column(c).cast("string") if text else as_column(c), text or isinstance(kind, T.BinaryType)))
    return found


def _shortened(cells: list[tuple[Column, bool]]) -> dict[str, Column]:
    """What stands for the parts of a key in the first pass: ``__cell`` and its number, and for texts ``__hash`` and its number."""
    out = {}
    for i, (cell, text) in enumerate(cells):
        long = F.octet_length(cell) > SHORT if text else F.lit(False)
        out[f"__cell{i}"] = F.when(~long, cell) if text else cell
        if text:
            out[f"__hash{i}"] = F.when(long, F.xxhash64(cell))
    return out


def _nulls(missing: list[Column]) -> Column:
    return F.when(reduce(operator.and_, missing), F.lit(NONE)).when(reduce(operator.or_, missing), F.lit(PART)).otherwise(F.lit(FULL))


def hash_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """The first pass over one key: its shortened parts, rows ``n``, kind of ``nulls``, and whether ``hashed``."""
    parts = _shortened(_cells(df, names))
    counted = df.select(*[c.alias(n) for n, c in parts.items()]).groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))
    both = [[f"{kind}{i}" for kind in ("__cell", "__hash") if f"{kind}{i}" in parts] for i in range(len(names))]
    hashed = [F.col(c).isNotNull() for c in parts if c.startswith("__hash")]
    return counted.withColumns({
        "nulls": _nulls([F.coalesce(*own).isNull() if len(own) == 1 else F.col(own[0]).isNull() & F.col(own[1]).isNull() for own in both]),
        "hashed": reduce(operator.or_, hashed, F.lit(False)),
    })


def _of_key(df: DataFrame, names: list[str], rule: int) -> list[DataFrame]:
    """Frames of ``rule`` and the counts, which add up to the summary of one key."""
    zero = F.lit(0).cast("long")
    n, nulls, keys = F.col("n"), F.col("nulls"), F.col("keys")

    def part(rows=zero, null=zero, some=zero, once=zero, keys=zero, repeated=zero) -> list[Column]:
        counts = zip((rows, null, some, once, keys, repeated), _COUNTS)
        return [F.lit(rule).alias("rule"), *[c.cast("long").alias(name) for c, name in counts]]

    def found(sure: Column) -> dict[str, Column]:
        """Counts of keys of which ``keys`` have ``n`` rows in all; below two rows a key occurs once."""
        single, again = F.col("times") == 1, (F.col("times") > 1) & (nulls == FULL)
        return {
            "once": F.when(sure & single & (nulls != NONE), keys).otherwise(zero),
            "keys": F.when(sure & again, keys).otherwise(zero), "repeated": F.when(sure & again, n).otherwise(zero),
        }

    counted = hash_counts(df, names)
    shortened = [c for c in counted.columns if c.startswith("__")]
    texts = any(c.startswith("__hash") for c in shortened)
    met = F.col("hashed") & (n > 1)
    first = counted.groupBy(
        "nulls", met.alias("met"), F.least(n, F.lit(2)).alias("times"), *[F.when(met, F.col(c)).alias(c) for c in shortened if texts]
    ).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"))
    if texts:
        first = saved(first, "hashes")
    summed = first.select(
        *part(n, F.when(nulls == NONE, n).otherwise(zero), F.when(nulls == PART, n).otherwise(zero), **found(~F.col("met")))
    )
    if not texts:
        return [summed]
    cells = _cells(df, names)
    whole = {f"__key{i}": cell for i, (cell, _) in enumerate(cells)}
    rows = df.select(*[c.alias(k) for k, c in (_shortened(cells) | whole).items()])
    wanted = first.filter("met").select(*[F.col(c).alias(f"{c}_met") for c in shortened])
    same = reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"{c}_met")) for c in shortened])
    real = rows.join(wanted, same).groupBy(*whole).agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"nulls": _nulls([F.col(k).isNull() for k in whole]), "times": F.col("n"), "keys": F.lit(1)}
    )
    return [summed, real.select(*part(**found(F.lit(True))))]


def key_summary(df: DataFrame, key_sets: list[list[str] | str]) -> DataFrame:
    """One row per key: ``key``, ``rows``, ``null_rows``, ``part_null_rows``, ``once``, ``repeated_keys``, ``repeated_rows``.

    ``once`` counts keys that occur in one row, keys with some NULL parts among
    them; keys of NULL parts only are ``null_rows``. ``repeated_keys`` and
    ``repeated_rows`` are about keys without a NULL part. For keys with texts the
    first pass runs at once and leaves the repeated hashes in the shared folder, so
    that Spark sends them to the rows where they are few and joins them where they
    are many.
    """
    names = [[k] if isinstance(k, str) else list(k) for k in key_sets]
    labels = df.sparkSession.createDataFrame([(i, ",".join(k)) for i, k in enumerate(names)], "rule int, key string")
    everything = labels.select("rule", *[F.lit(0).cast("long").alias(c) for c in _COUNTS])
    for i, k in enumerate(names):
        for frame in _of_key(df, k, i):
            everything = everything.unionByName(frame)
    return everything.groupBy("rule").agg(*[F.sum(c).alias(c) for c in _COUNTS]).join(labels, "rule").select("key", *_COUNTS)


def uniqueness(df: DataFrame, key_sets: list[list[str] | str]) -> DataFrame:
    """The uniqueness of every key: ``instance, name, value``, as :func:`tablecheck.operators.metrics.uniqueness` has it."""
    value = F.try_divide("once", F.col("rows") - F.col("null_rows"))
    return key_summary(df, key_sets).select(F.col("key").alias("instance"), F.lit("Uniqueness").alias("name"), value.alias("value"))


def key_constraints(df: DataFrame, table: str, primary: list[list[str] | str], unique: list[list[str] | str]) -> DataFrame:
    """Primary and unique keys in the form of :func:`tablecheck.operators.constraints.validate_constraints`, without messages.

    A primary key counts rows with a NULL part and keys that repeat, a unique key the latter only.
    """
    asked = [("pk", k) for k in primary] + [("unique", k) for k in unique]
    sets = [[k] if isinstance(k, str) else list(k) for _, k in asked]
    distinct = [list(k) for k in dict.fromkeys(map(tuple, sets))]
    found = key_summary(df, distinct)
    rules = df.sparkSession.createDataFrame(
        [(kind, ",".join(k)) for (kind, _), k in zip(asked, sets)], "kind string, key string"
    )
    nulls = F.when(F.col("kind") == "pk", F.col("null_rows") + F.col("part_null_rows")).otherwise(F.lit(0))
    return rules.join(found, "key").select(
        F.lit(table).alias("table_name"), F.concat("kind", F.lit("("), "key", F.lit(")")).alias("constraint"),
        (F.col("repeated_keys") + nulls).alias("violations"),
    )
