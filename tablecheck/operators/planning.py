"""Finding what cannot be planned or run without stopping the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Row, SparkSession


class RuleError(Exception):
    """A rule that cannot be planned for a reason that Spark would only find while running."""


def first_line(e: Exception) -> str:
    return (str(e) or type(e).__name__).split("\n", 1)[0]


def plan_errors(items: list, plan: Callable[[list], None]) -> list[str | None]:
    """Why each item has no plan, or None. ``plan`` raises if any of its items has none.

    Halving finds a few broken items among many without planning each alone.
    """
    if not items:
        return []
    try:
        plan(items)
        return [None] * len(items)
    except (AnalysisException, SparkRuntimeException, RuleError) as e:
        if len(items) == 1:
            return [first_line(e)]
    half = len(items) // 2
    return plan_errors(items[:half], plan) + plan_errors(items[half:], plan)


def isolated(items: list, run: Callable[[list], list[Row]], failed: Callable[[object, str], list[Row]]) -> list[Row]:
    """The rows that ``run`` collects for all items; items that fail while running get those of ``failed``.

    One run measures them all. Only if it fails, halving finds the items at fault.
    """
    if not items:
        return []
    try:
        return run(items)
    except Exception as e:  # also what a source's driver raises inside a job
        if len(items) == 1:
            return failed(items[0], first_line(e))
    half = len(items) // 2
    return isolated(items[:half], run, failed) + isolated(items[half:], run, failed)


def compile_patterns(spark: SparkSession, patterns: Iterable[str | None]) -> None:
    """Raise if a pattern is none: a match on a literal is folded by the optimizer and reads nothing."""
    known = [p for p in patterns if p is not None]
    if known:
        spark.sql("SELECT " + ", ".join(["'' RLIKE ?"] * len(known)), args=known).collect()


@contextmanager
def non_raising(spark: SparkSession) -> Iterator[None]:
    """Frames built inside give NULL for a conversion, division or index that has no result, instead of raising.

    It holds for what is built inside, whenever that runs. Whole numbers that
    overflow wrap around; ``raise_error`` still raises.
    """
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
