"""Declared table constraints, checked on any DataFrame.

NULL passes every constraint except NOT NULL and PRIMARY KEY. Row constraints
of a table are counted in one aggregation; key constraints take one group-by
each and foreign keys one key-to-key join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.columns import as_column
from ..functions.predicates import expr_true, in_set
from .aggregates import frequencies
from .joins import orphan_keys
from .planning import isolated, non_raising, plan_errors
from .windows import union_frames


@dataclass(frozen=True, eq=False)
class Constraint:
    """``broken`` marks an offending row; ``frame`` builds a one-row count instead."""

    name: str
    broken: Column | None = None
    frame: Callable[[DataFrame], DataFrame] | None = None


def _names(cols: list[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def pk(cols: list[str] | str) -> Constraint:
    """Rows with a NULL key part plus keys that occur more than once."""
    names = _names(cols)

    def frame(df: DataFrame) -> DataFrame:
        null_part = reduce(lambda a, b: a | b, [as_column(c).isNull() for c in names])
        bad = F.when(null_part, F.col("n")).when(F.col("n") > 1, F.lit(1)).otherwise(F.lit(0))
        return frequencies(df, names).agg(F.coalesce(F.sum(bad), F.lit(0)).alias("violations"))

    return Constraint(f"pk({','.join(names)})", frame=frame)


def unique(cols: list[str] | str) -> Constraint:
    """Keys without NULL parts that occur more than once."""
    names = _names(cols)

    def frame(df: DataFrame) -> DataFrame:
        full = reduce(lambda a, b: a & b, [as_column(c).isNotNull() for c in names])
        return frequencies(df, names).agg(F.count_if(full & (F.col("n") > 1)).alias("violations"))

    return Constraint(f"unique({','.join(names)})", frame=frame)


def not_null(col: str) -> Constraint:
    return Constraint(f"not_null({col})", as_column(col).isNull())


def fk(col: str, parent: DataFrame, field: str) -> Constraint:
    """Child rows with a non-NULL key that is absent from the parent."""

    def frame(df: DataFrame) -> DataFrame:
        return orphan_keys(df, parent, col, field).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))

    return Constraint(f"fk({col})", frame=frame)


def check(condition: Column | str, name: str) -> Constraint:
    return Constraint(f"check({name})", ~expr_true(condition))


def check_in(col: str, values: str | Iterable[str]) -> Constraint:
    return Constraint(f"check_in({col})", ~in_set(col, values))


def check_age(col: str, years: int, as_of: str | Column) -> Constraint:
    """Born at least ``years`` before ``as_of``; a text that is no date breaks it."""
    day = (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("date")
    old_enough = as_column(col).try_cast("date") <= F.add_months(day, -12 * years)
    return Constraint(f"check_age({col})", as_column(col).isNotNull() & ~F.coalesce(old_enough, F.lit(False)))


def max_length(col: str, n: int) -> Constraint:
    """Text of at most ``n`` characters."""
    return Constraint(f"max_length({col},{n})", F.length(as_column(col)) > n)


def fits_decimal(col: str, precision: int, scale: int) -> Constraint:
    """Number that fits ``decimal(precision, scale)``; extra decimals are rounded."""
    c = as_column(col)
    fits = c.try_cast(f"decimal({precision},{scale})").isNotNull()
    return Constraint(f"fits_decimal({col},{precision},{scale})", c.isNotNull() & ~fits)


RESULT = "table_name string, constraint string, violations long, message string"


def validate_constraints(df: DataFrame, table: str, constraints: list[Constraint]) -> DataFrame:
    """One row per constraint: ``table_name, constraint, violations, message``.

    A constraint that cannot be planned, such as one on a column that does not
    exist, has NULL violations and a message; the others are counted.
    """

    def planned(some: list[Constraint]) -> None:
        df.agg(*[F.count_if(c.broken) for c in some if c.broken is not None] or [F.lit(1)]).schema  # noqa: B018
        for c in some:
            if c.frame is not None:
                c.frame(df).schema  # noqa: B018

    if not constraints:
        return df.sparkSession.createDataFrame([], RESULT)
    problems = plan_errors(constraints, planned)
    failed = [(c.name, p) for c, p in zip(constraints, problems) if p is not None]
    constraints = [c for c, p in zip(constraints, problems) if p is None]
    rowwise = [c for c in constraints if c.broken is not None]
    null = F.lit(None).cast("string").alias("message")
    frames = []
    if rowwise:
        row = df.agg(*[F.count_if(F.coalesce(c.broken, F.lit(False))).alias(f"c{i}") for i, c in enumerate(rowwise)])
        structs = [
            F.struct(F.lit(c.name).alias("constraint"), F.col(f"c{i}").alias("violations"))
            for i, c in enumerate(rowwise)
        ]
        frames.append(row.select(F.inline(F.array(*structs))).select("*", null))
    for c in constraints:
        if c.frame is not None:
            frames.append(c.frame(df).select(F.lit(c.name).alias("constraint"), F.col("violations").cast("bigint"), null))
    for name, problem in failed:
        none = F.lit(None).cast("bigint").alias("violations")
        one = df.sparkSession.range(1)
        frames.append(one.select(F.lit(name).alias("constraint"), none, F.lit(problem).alias("message")))
    return union_frames(frames).select(F.lit(table).alias("table_name"), "constraint", "violations", "message")


def validate_isolated(df: DataFrame, table: str, constraints: list[Constraint]) -> DataFrame:
    """As :func:`validate_constraints`, counted at once, with constraints that fail while running kept apart.

    Those have NULL violations and a message. One row per constraint reaches the driver.
    """
    rows = isolated(
        constraints,
        lambda some: validate_constraints(df, table, some).collect(),
        lambda c, problem: [Row(table, c.name, None, problem)],
    )
    return df.sparkSession.createDataFrame(rows, RESULT)


def validate_guarded(df: DataFrame, table: str, constraints: list[Constraint]) -> DataFrame:
    """Row constraints in one lazy scan that no cell can end: ``table_name, constraint, violations, unjudged``.

    ``unjudged`` counts the rows for which a constraint has no outcome: those with
    a NULL, which pass, and those with a cell that its condition cannot read.
    Keys and references are counted by :func:`validate_constraints`.
    """
    rowwise = [c for c in constraints if c.broken is not None]
    with non_raising(df.sparkSession):
        counts = df.agg(
            *[F.count_if(F.coalesce(c.broken, F.lit(False))).alias(f"v{i}") for i, c in enumerate(rowwise)],
            *[F.count_if(c.broken.isNull()).alias(f"u{i}") for i, c in enumerate(rowwise)],
        )
    structs = [
        F.struct(F.lit(table).alias("table_name"), F.lit(c.name).alias("constraint"),
                 F.col(f"v{i}").alias("violations"), F.col(f"u{i}").alias("unjudged"))
        for i, c in enumerate(rowwise)
    ]
    return counts.select(F.inline(F.array(*structs)))
