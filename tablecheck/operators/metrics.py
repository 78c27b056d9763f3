"""Quality metrics: one value per rule.

A :class:`Metric` is an aggregate expression, so any number of them over one
table compiles into a single ``agg``: one scan, one partial aggregation per
task and one final row. Metrics that need a shuffle (uniqueness, referential
integrity) carry a function that builds their own one-row frame instead.

Null policies: *strict* counts a NULL cell as a failure, *pass* as a success.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column, as_text, parse_date, parse_ts
from ..functions.predicates import expr_true, in_set, matches
from .aggregates import frequencies
from .joins import key_match
from .planning import compile_patterns, isolated, plan_errors
from .windows import union_frames

EMPTY_INPUT = "no rows to measure"
NOT_A_NUMBER = "the value is not a number"
# How a number without decimals and one with decimals is written.
WHOLE_NUMBER = r"^[0-9]+$"
DECIMAL_NUMBER = r"^\d+\.\d{%d,}$"


@dataclass(frozen=True, eq=False)
class Metric:
    """A named measurement; ``value`` is an aggregate or ``frame`` builds it."""

    name: str
    instance: str
    value: Column | None = None
    frame: Callable[[DataFrame], DataFrame] | None = None
    ratio: bool = True
    entity: str = "Column"
    pattern: str | None = None


def share(condition: Column, where: Column | str | None = None) -> Column:
    """Rows with a true condition over all rows (strict); NULL without rows."""
    hit = F.coalesce(condition, F.lit(False))
    if where is None:
        return F.try_divide(F.count_if(hit), F.count(F.lit(1)))
    kept = F.coalesce(expr_true(where), F.lit(False))
    return F.try_divide(F.count_if(hit & kept), F.count_if(kept))


def size(where: Column | str | None = None) -> Metric:
    """Number of rows."""
    n = F.count(F.lit(1)) if where is None else F.count_if(F.coalesce(expr_true(where), F.lit(False)))
    return Metric("Size", "*", n, ratio=False, entity="Dataset")


def completeness(col: str, where: Column | str | None = None) -> Metric:
    """Share of non-NULL cells."""
    return Metric("Completeness", col, share(as_column(col).isNotNull(), where))


def pattern_match(col: str, pattern: str, where: Column | str | None = None) -> Metric:
    """Share of rows in which the pattern is found (strict)."""
    return Metric("PatternMatch", col, share(matches(col, pattern), where), pattern=pattern)


def compliance(name: str, condition: Column | str, where: Column | str | None = None) -> Metric:
    """Share of rows for which a row condition is true (strict)."""
    return Metric("Compliance", name, share(expr_true(condition), where))


def credibility(col: str, pattern: str | None = None, values: str | Iterable[str] | None = None) -> Metric:
    """Credibility: by pattern, taken without blanks around it, or by value set."""
    if (pattern is None) == (values is None):
        raise ValueError("credibility needs either a pattern or a value set")
    if pattern is not None:
        return pattern_match(col, pattern.strip())
    return Metric("Compliance", col, share(in_set(col, values)))


def accuracy(col: str, pattern: str | None = None, values: str | Iterable[str] | None = None) -> Metric:
    """Accuracy: syntactic (pattern) or semantic (value set)."""
    return credibility(col, pattern, values)


def precision_pattern(decimals: int | str) -> str:
    """Fixed format of a number with at least that many decimals (0: none at all)."""
    n = int(decimals)
    return WHOLE_NUMBER if n == 0 else DECIMAL_NUMBER % n


def precision(col: str, decimals: int | str) -> Metric:
    """Share of numbers written with at least ``decimals`` decimals.

    Judged on the text of the number, so negative numbers, NULL and exponent
    notation fail.
    """
    pattern = precision_pattern(decimals)
    return Metric("PatternMatch", col, share(matches(as_text(col), pattern)), pattern=pattern)


def currency_date(col: str, limit: str) -> Metric:
    """Share of rows whose date is on or after the limit; formats mix per row."""
    return Metric("Compliance", col, share(parse_date(col) >= parse_date(F.lit(limit))))


def currency_ts(col: str, limit: str) -> Metric:
    """Share of rows whose timestamp is at or after the limit."""
    return Metric("Compliance", col, share(parse_ts(col) >= parse_ts(F.lit(limit))))


def minimum(col: str, where: Column | str | None = None) -> Metric:
    """Smallest value, over the rows that meet ``where``."""
    c = as_column(col)
    return Metric("Minimum", col, F.min(c if where is None else F.when(expr_true(where), c)), ratio=False)


def is_contained_in(col: str, values: str | Iterable[str]) -> Metric:
    """Share of rows whose cell is in the set or NULL (pass)."""
    return Metric("Compliance", col, share(as_column(col).isNull() | in_set(col, values)))


def satisfies(condition: Column | str, name: str) -> Metric:
    """Share of rows for which the condition is true."""
    return compliance(name, condition)


def uniqueness(cols: list[str] | str, digest: bool = False) -> Metric:
    """Values that occur exactly once over rows; all-NULL groups are left out.

    ``digest`` shuffles a hash of text keys instead of the texts themselves.
    """
    names = [cols] if isinstance(cols, str) else list(cols)

    def frame(df: DataFrame) -> DataFrame:
        any_key = reduce(lambda a, b: a | b, [as_column(c).isNotNull() for c in names])
        counted = frequencies(df, names, digest).filter(any_key)
        return counted.agg(F.try_divide(F.count_if(F.col("n") == 1), F.sum("n")).alias("value"))

    return Metric("Uniqueness", ",".join(names), frame=frame, entity="Column" if len(names) == 1 else "Multicolumn")


def referential_integrity(parent: DataFrame, col: str, col2: str) -> Metric:
    """Share of child rows whose key exists in the parent (a NULL key does not)."""

    def frame(child: DataFrame) -> DataFrame:
        keys = key_match(child, parent, col, col2)
        matched = F.coalesce(F.sum(F.when(F.col("matched"), F.col("n"))), F.lit(0))
        return keys.agg(F.try_divide(matched, F.sum("n")).alias("value"))

    return Metric("ReferentialIntegrity", col, frame=frame)


def _labels(m: Metric) -> list[Column]:
    return [
        F.lit(m.entity).alias("entity"),
        F.lit(m.instance).alias("instance"),
        F.lit(m.name).alias("name"),
        F.lit(m.ratio).alias("is_ratio"),
    ]


def _failed(df: DataFrame, m: Metric, message: str) -> DataFrame:
    one = df.sparkSession.range(1)
    return one.select(*_labels(m), F.lit(None).cast("double").alias("value"), F.lit(message).alias("message"))


def _plan(df: DataFrame, metrics: list[Metric]) -> None:
    """Raise unless all metrics can be planned.

    Analyzes the metrics, with the conversion of their values, and compiles
    their patterns without running a job.
    """
    compile_patterns(df.sparkSession, [m.pattern for m in metrics])
    scans = [m.value.try_cast("double") for m in metrics if m.frame is None]
    if scans:
        df.agg(*scans).schema  # noqa: B018
    for m in metrics:
        if m.frame is not None:
            m.frame(df).schema  # noqa: B018


def run_metrics(df: DataFrame, metrics: list[Metric]) -> DataFrame:
    """Measure a table: ``entity, instance, name, is_ratio, value, message``.

    All single-scan metrics share one aggregation. A metric that cannot be
    planned (unknown column, broken expression) gives a row with a NULL value
    and a message, and so does one without rows to measure or whose value is no
    number; the others run. Conversions that the metrics make themselves never
    raise; for expressions of the caller that may, see :func:`run_isolated`.
    """
    if not metrics:
        return df.sparkSession.createDataFrame([], RESULT)
    message = F.when(F.col("value").isNotNull(), F.lit(None)).when(F.col("found"), F.lit(NOT_A_NUMBER))
    message = message.otherwise(F.lit(EMPTY_INPUT)).alias("message")
    scans, frames = [], []
    for m, problem in zip(metrics, plan_errors(metrics, lambda some: _plan(df, some)), strict=True):
        if problem is not None:
            frames.append(_failed(df, m, problem))
        elif m.frame is None:
            scans.append(m)
        else:
            value = [F.col("value").try_cast("double").alias("value"), F.col("value").isNotNull().alias("found")]
            frames.append(m.frame(df).select(*_labels(m), *value).select("*", message).drop("found"))
    if scans:
        row = df.agg(*[m.value.alias(f"m{i}") for i, m in enumerate(scans)])
        values = [(F.col(f"m{i}").try_cast("double").alias("value"), F.col(f"m{i}").isNotNull().alias("found")) for i in range(len(scans))]
        rows = F.array(*[F.struct(*_labels(m), *value) for m, value in zip(scans, values)])
        frames.insert(0, row.select(F.inline(rows)).select("*", message).drop("found"))
    return union_frames(frames)


RESULT = "entity string, instance string, name string, is_ratio boolean, value double, message string"


def run_isolated(df: DataFrame, metrics: list[Metric]) -> DataFrame:
    """As :func:`run_metrics`, measured at once, with metrics that fail while running kept apart.

    Those get a row with a NULL value and the message. One row per metric
    reaches the driver.
    """
    rows = isolated(
        metrics, lambda some: run_metrics(df, some).collect(), lambda m, problem: _failed(df, m, problem).collect()
    )
    return df.sparkSession.createDataFrame(rows, RESULT)
