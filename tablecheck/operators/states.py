"""Metrics from states that merge: a run over a new slice of a table reads only that slice.

A state is a row per metric and slice: counts, a least and a greatest value, or
a sketch. States of slices are saved beside each other and merged when they are
asked for, so a table of any age costs one row per slice and metric.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_column
from ..functions.predicates import expr_true, matches

SHARE, COUNT, SUM, LEAST, GREATEST, DISTINCT, QUANTILE = "share", "count", "sum", "min", "max", "distinct", "quantile"
#: Two to this power is the number of registers of a distinct-value sketch; the size of a quantile sketch.
HLL_BITS, KLL_SIZE = 14, 400
STATE = (
    "slice string, name string, instance string, kind string, hits long, total long, amount double, least double, "
    "greatest double, distinct_sketch binary, quantile_sketch binary, rank double"
)
_VALUES = [c.split()[0] for c in STATE.split(", ")[4:]]


@dataclass(frozen=True, eq=False)
class StateMetric:
    """A metric whose state merges: ``of`` is the condition of a share, otherwise the measured value."""

    name: str
    instance: str
    kind: str
    of: Column | None = None
    rank: float | None = None


def size() -> StateMetric:
    return StateMetric("Size", "*", COUNT)


def completeness(col: str) -> StateMetric:
    return StateMetric("Completeness", col, SHARE, as_column(col).isNotNull())


def compliance(name: str, condition: Column | str) -> StateMetric:
    """Rows for which a condition is true over all rows."""
    return StateMetric("Compliance", name, SHARE, expr_true(condition))


def pattern_match(col: str, pattern: str) -> StateMetric:
    return StateMetric("PatternMatch", col, SHARE, matches(col, pattern))


def minimum(col: str) -> StateMetric:
    return StateMetric("Minimum", col, LEAST, as_column(col))


def maximum(col: str) -> StateMetric:
    return StateMetric("Maximum", col, GREATEST, as_column(col))


def mean(col: str) -> StateMetric:
    """Average of the non-NULL values, from their sum and number."""
    return StateMetric("Mean", col, SUM, as_column(col))


def approx_distinct(col: str) -> StateMetric:
    """Distinct values by a sketch, with an error of about one percent."""
    return StateMetric("ApproxCountDistinct", col, DISTINCT, as_column(col))


def approx_quantile(col: str, rank: float) -> StateMetric:
    """A quantile of a whole percent by a sketch, with a rank error of below one percent."""
    return StateMetric(f"ApproxQuantile-{rank}", col, QUANTILE, as_column(col), rank)


def _state(m: StateMetric) -> dict[str, Column]:
    number = None if m.of is None else m.of.try_cast("double")
    if m.kind == SHARE:
        return {"hits": F.count_if(F.coalesce(m.of, F.lit(False))), "total": F.count(F.lit(1))}
    if m.kind == COUNT:
        return {"total": F.count(F.lit(1))}
    if m.kind == SUM:
        return {"amount": F.sum(number), "total": F.count(number)}
    if m.kind == LEAST:
        return {"least": F.min(number)}
    if m.kind == GREATEST:
        return {"greatest": F.max(number)}
    if m.kind == DISTINCT:
        return {"distinct_sketch": F.hll_sketch_agg(m.of.cast("string"), HLL_BITS), "total": F.count(m.of)}
    return {"quantile_sketch": F.kll_sketch_agg_double(number, KLL_SIZE), "total": F.count(number)}


def metric_states(df: DataFrame, metrics: list[StateMetric], slice_by: Column | str | None = None) -> DataFrame:
    """The states of all metrics, one row per slice and metric, from one scan.

    Rows without a slice are the slice NULL. Without ``slice_by`` the whole table
    is one slice.
    """
    kinds = {c.split()[0]: c.split()[1] for c in STATE.split(", ")}
    parts = {(i, name): col for i, m in enumerate(metrics) for name, col in _state(m).items()}
    values = [c.alias(f"{n}{i}") for (i, n), c in parts.items()]
    if slice_by is None:
        grouped = df.agg(*values).withColumn("slice", F.lit(None).cast("string"))
    else:
        grouped = df.groupBy(as_column(slice_by).cast("string").alias("slice")).agg(*values)
    structs = [
        F.struct(
            F.lit(m.name).alias("name"), F.lit(m.instance).alias("instance"), F.lit(m.kind).alias("kind"),
            *[(F.col(f"{v}{i}") if (i, v) in parts else F.lit(m.rank if v == "rank" else None)).cast(kinds[v]).alias(v) for v in _VALUES],
        )
        for i, m in enumerate(metrics)
    ]
    return grouped.select("slice", F.inline(F.array(*structs)))


def metrics_from_states(states: DataFrame) -> DataFrame:
    """The metrics of all rows behind the states: ``name, instance, value`` (NULL without rows to measure)."""
    some = F.col("total") > 0
    merged = states.groupBy("name", "instance", "kind", "rank").agg(
        F.sum("hits").alias("hits"), F.sum("total").alias("total"), F.sum("amount").alias("amount"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg(F.when(some & (F.col("kind") == DISTINCT), F.col("distinct_sketch"))).alias("distinct"),
        F.kll_merge_agg_double(F.when(some & (F.col("kind") == QUANTILE), F.col("quantile_sketch"))).alias("quantiles"),
    )
    kind = F.col("kind")
    # A sketch is asked for constant ranks only.
    percents = F.kll_sketch_get_quantile_double("quantiles", F.array(*[F.lit(p / 100) for p in range(101)]))
    value = (
        F.when(kind == SHARE, F.try_divide("hits", "total"))
        .when(kind == COUNT, F.col("total").cast("double"))
        .when(kind == SUM, F.try_divide("amount", "total"))
        .when(kind == LEAST, F.col("least")).when(kind == GREATEST, F.col("greatest"))
        .when((kind == DISTINCT) & some, F.hll_sketch_estimate("distinct").cast("double"))
        .when((kind == DISTINCT), F.lit(0.0))
        .when((kind == QUANTILE) & some, F.element_at(percents, F.round(F.col("rank") * 100).cast("int") + 1))
    )
    return merged.select("name", "instance", value.alias("value"))


def save_states(states: DataFrame, path: str) -> None:
    """Add the states of slices to those at ``path``; a slice that is there already is replaced."""
    (
        states.withColumn("slice_key", F.coalesce("slice", F.lit("")))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice_key").parquet(path)
    )


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """All saved states; an empty table where nothing was saved yet."""
    try:
        return spark.read.schema(STATE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE)


def refresh_states(df: DataFrame, metrics: list[StateMetric], slice_by: str, path: str) -> DataFrame:
    """Measure and save the slices of ``df`` that have no saved states, and return all states.

    Where ``slice_by`` is a partition column, only the new slices' files are read.
    The names of saved slices, one per slice, pass the driver.
    """
    spark = df.sparkSession
    known = [r[0] for r in read_states(spark, path).select("slice").distinct().collect()]
    own = as_column(slice_by).cast("string")
    fresh = df.filter(~F.coalesce(own.isin([k for k in known if k is not None]), F.lit(None in known)))
    save_states(metric_states(fresh, metrics, slice_by), path)
    return read_states(spark, path)
