"""Joins that keep working when one key holds a large share of the rows.

* Referential checks compare *keys*: both sides are reduced to one row per key
  before they meet, so a hot key costs one row per map task.
* Joins that must keep every row of the large side are ordinary joins. Whether a
  side is broadcast is left to Spark, which checks real sizes, and a skewed
  partition of a sort-merge join is split by adaptive execution.
* :func:`salted_join` spreads hot keys by hand, for sessions without adaptive
  execution; :func:`join_dimension` uses it only where some key is hot.
"""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.columns import as_column

# A key is hot when it has more rows than one task should take.
HOT_SHARE = 1e-4
HOT_ROWS = 1_000_000
NULL_SALTS = 4096

_SALT = "__salt"
_SALTS = "__salts"


def hot_keys(
    df: DataFrame, on: list[str], share: float = HOT_SHARE, min_rows: int = HOT_ROWS, nulls: bool = False
) -> list[tuple]:
    """Keys with more than ``max(min_rows, share * rows)`` rows, each with its salt count as the last value.

    One grouping, combined map-side, is run at once; the number of all rows is
    observed on its way. At most ``1 / share`` keys can qualify, and because a key
    gets one salt per such portion of rows, all salts together stay below
    ``2 / share``: what reaches the driver has a proven bound. Keys with a NULL part
    are left out unless ``nulls`` is set.
    """
    keys = [as_column(c) for c in on]
    rows = df if nulls or not on else df.filter(reduce(operator.and_, [c.isNotNull() for c in keys]))
    seen = Observation()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).observe(seen, F.sum("n").alias("rows"))
    # Keys that qualify are among the largest 1 / share.
    largest = counts.filter(F.col("n") > min_rows).orderBy(F.desc("n")).limit(math.ceil(1 / share)).collect()
    portion = max(float(min_rows), (seen.get["rows"] or 0) * share)
    return [(*r[:-1], math.ceil(r[-1] / portion)) for r in map(tuple, largest) if r[-1] > portion]


def _any(conditions: list[Column]) -> Column:
    """OR of all, as a balanced tree: there may be thousands."""
    if not conditions:
        return F.lit(False)
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:]) if half else conditions[0]


def is_hot(on: list[str], hot: list[tuple]) -> Column:
    """Whether a row has one of the hot keys; never NULL."""
    if not on:
        return F.lit(bool(hot))
    if len(on) == 1:
        col, values = as_column(on[0]), [key[0] for key in hot]
        known = F.coalesce(col.isin([v for v in values if v is not None]), F.lit(False))
        return known | col.isNull() if None in values else known
    return _any([reduce(operator.and_, [as_column(c).eqNullSafe(F.lit(v)) for c, v in zip(on, key)]) for key in hot])


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, hot: list[tuple], salt_on: list[str] | None = None
) -> DataFrame:
    """Equi-join (left, inner, left_semi or left_anti) with hot keys split.

    Left rows of a hot key go to one of its salts, right rows of that key are
    repeated once per salt; other keys keep salt 0. Left rows with a NULL key
    match nothing, so they are spread freely. The salt is a hash of the row and
    of the map task: a retried task repeats it, and identical copies of one row
    still spread over tasks.
    """
    assert how in {"left", "inner", "left_semi", "left_anti"}, how
    spread = [as_column(c) for c in (salt_on or on)]
    null_key = reduce(operator.or_, [as_column(c).isNull() for c in on])
    schema = T.StructType([*left.select(*[as_column(c) for c in on]).schema.fields, T.StructField(_SALTS, T.IntegerType())])
    # At most 1 / share keys, so this is broadcast whatever the size of the data.
    keys = F.broadcast(left.sparkSession.createDataFrame(hot, schema))
    salts = F.coalesce(F.col(_SALTS), F.lit(1))
    left_salts = F.when(null_key, F.lit(NULL_SALTS)).otherwise(salts)
    salt = F.pmod(F.xxhash64(*spread, F.spark_partition_id()), left_salts).cast("int")
    left_salted = left.join(keys, on, "left").withColumn(_SALT, salt).drop(_SALTS)
    right_salted = right.join(keys, on, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1))).drop(_SALTS)
    joined = left_salted.join(right_salted, [*on, _SALT], how).drop(_SALT)
    extra = [] if how in {"left_semi", "left_anti"} else [c for c in right.columns if c not in on]
    return joined.select(*[as_column(c) for c in [*left.columns, *extra]])


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    salt_on: list[str] | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join every fact row with another side (left, inner, semi or anti), hot keys salted where there are any."""
    hot = hot_keys(fact, on, share, min_rows)
    return salted_join(fact, dim, on, how, hot, salt_on) if hot else fact.join(dim, on, how)


def comparable(child: DataFrame, col: str, parent: DataFrame, col2: str) -> Column:
    """The child's key in the type of the parent's where exactly one of them is text.

    A text that is no value of the parent's type becomes NULL and so matches
    nothing. Keys of two other types meet in the type that Spark finds for both.
    """
    mine, theirs = (df.select(as_column(c)).schema.fields[0].dataType for df, c in ((child, col), (parent, col2)))
    texts = [isinstance(t, (T.StringType, T.VarcharType, T.CharType)) for t in (mine, theirs)]
    return as_column(col).try_cast(theirs) if texts[0] != texts[1] else as_column(col)


def key_match(child: DataFrame, parent: DataFrame, col: str, col2: str) -> DataFrame:
    """One row per child key (NULL included): key, row count ``n``, ``matched``.

    Both sides are aggregated to distinct keys first; the join is one to one and
    reuses the partitioning of the two aggregations. Text keys and typed keys
    compare as in :func:`comparable`.
    """
    child_keys = child.groupBy(as_column(col).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    parent_keys = (
        parent.select(as_column(col2).alias("parent_key")).filter(F.col("parent_key").isNotNull()).distinct()
    )
    same = comparable(child_keys, "key", parent_keys, "parent_key") == F.col("parent_key")
    return child_keys.join(parent_keys, same, "left").select("key", "n", F.col("parent_key").isNotNull().alias("matched"))


def orphan_keys(child: DataFrame, parent: DataFrame, col: str, col2: str) -> DataFrame:
    """Non-NULL child keys absent from the parent, with their row counts."""
    return key_match(child, parent, col, col2).filter(F.col("key").isNotNull() & ~F.col("matched")).select("key", "n")


def rows_in(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys`` (semi-join)."""
    return df.join(keys.select(*[as_column(c) for c in on]), on, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, col: str, col2: str) -> DataFrame:
    """Child rows with a non-NULL key that the parent does not have (anti-join)."""
    parent_keys = parent.select(as_column(col2).alias("__parent_key")).filter(F.col("__parent_key").isNotNull()).distinct()
    same = comparable(child, col, parent_keys, "__parent_key") == F.col("__parent_key")
    return child.filter(as_column(col).isNotNull()).join(parent_keys, same, "left_anti")


def combine_metrics(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join of two aggregates on their group keys, NULL keys matching."""
    if not on:
        # Two one-row totals: a constant key lets them meet as an equi-join.
        left, right, on = left.withColumn("__one", F.lit(1)), right.withColumn("__one", F.lit(1)), ["__one"]
    r = right.select(*[as_column(c).alias(f"__r_{c}") if c in on else as_column(c) for c in right.columns])
    cond = None
    for c in on:
        part = as_column(c).eqNullSafe(as_column(f"__r_{c}"))
        cond = part if cond is None else cond & part
    keys = [F.coalesce(as_column(c), as_column(f"__r_{c}")).alias(c) for c in on if c != "__one"]
    rest = [as_column(c) for c in [*left.columns, *right.columns] if c not in on]
    return left.join(r, cond, "full_outer").select(*keys, *rest)


def offset_join(
    series: DataFrame, day: str, value: str, out: str, months: int = 1, keys: list[str] | None = None
) -> DataFrame:
    """Attach the value of ``months`` earlier to every row of an aggregated series.

    The month step clamps at month ends (31 March looks at 28 or 29 February).
    """
    keys = keys or []
    prev = series.select(
        as_column(day).alias("__prev_day"), *[as_column(k).alias(f"__prev_{k}") for k in keys], as_column(value).alias(out)
    )
    cond = F.add_months(as_column(day), -months) == F.col("__prev_day")
    for k in keys:
        cond = cond & as_column(k).eqNullSafe(as_column(f"__prev_{k}"))
    return series.join(prev, cond, "left").drop("__prev_day", *[f"__prev_{k}" for k in keys])


def on_spine(series: DataFrame, spine: DataFrame, day: str, spine_day: str = "date_day") -> DataFrame:
    """Every day of the spine with the series' values, NULL where it has none.

    Days of the series outside the spine have no row in the result.
    """
    days = spine.select(as_column(spine_day).alias(day))
    return days.join(series, day, "left")


def on_own_days(series: DataFrame, day: str, keys: list[str], carried: list[str] | None = None) -> DataFrame:
    """Every day of each key from its first to its last, with the series' values, NULL where it has none.

    A row stands for its day and is followed by the days up to the key's next row,
    so only rows of the series are shuffled and sorted, never the days between.
    Columns in ``carried``, such as running totals, keep their value on these days.
    ``day`` is a date. Rows without a day have no row in the result; NULL keys are
    keys.
    """
    own, carried = as_column(day), carried or []
    by_day = Window.partitionBy(*[as_column(k) for k in keys]).orderBy(own)
    rows = series.filter(own.isNotNull()).withColumn("__next", F.lead(own).over(by_day))
    # The last day of a key, and a day that occurs more than once, have no days after them.
    after = F.greatest(F.coalesce(F.date_diff("__next", own) - 1, F.lit(0)), F.lit(0))
    days = rows.select("*", F.explode(F.sequence(F.lit(0), after)).alias("__after"))

    def value(c: str) -> Column:
        if c == day:
            return F.date_add(own, F.col("__after"))
        return as_column(c) if c in keys or c in carried else F.when(F.col("__after") == 0, as_column(c))

    return days.select(*[value(c).alias(c) for c in series.columns])
