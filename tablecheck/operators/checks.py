"""Checks: an assertion on a metric with a severity."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import Metric, run_isolated, run_metrics

# Severities and the status of a check that holds.
WARNING = "Warning"
ERROR = "Error"
SUCCESS = "Success"


def is_complete_ratio(value: Column) -> Column:
    """Default assertion: every row complies."""
    return value == F.lit(1.0)


@dataclass(frozen=True, eq=False)
class Check:
    """``assertion`` maps the metric's value to a boolean Column."""

    level: str
    description: str
    metric: Metric
    assertion: Callable[[Column], Column] = is_complete_ratio


def run_checks(df: DataFrame, checks: list[Check], isolate: bool = False) -> DataFrame:
    """One row per check: ``check, level, status, entity, instance, name, value, message``.

    A check whose metric has no value does not hold. With ``isolate`` all checks
    are measured at once, and one whose metric fails while running gets a message
    and does not end the others.
    """
    # The position of a metric in the list ties its row to its check.
    tagged = [
        Metric(c.metric.name, f"{i}\x1f{c.metric.instance}", c.metric.value, c.metric.frame, c.metric.ratio,
               c.metric.entity, c.metric.pattern)
        for i, c in enumerate(checks)
    ]
    rows = (run_isolated if isolate else run_metrics)(df, tagged).withColumn("__i", F.split_part("instance", F.lit("\x1f"), F.lit(1)).cast("int"))
    status, level, text = F.lit(None), F.lit(None), F.lit(None)
    for i, c in enumerate(checks):
        mine = F.col("__i") == i
        held = F.when(c.assertion(F.col("value")), F.lit(SUCCESS)).otherwise(F.lit(c.level))
        status = F.when(mine, held).otherwise(status)
        level = F.when(mine, F.lit(c.level)).otherwise(level)
        text = F.when(mine, F.lit(c.description)).otherwise(text)
    return rows.select(
        text.alias("check"), level.alias("level"), status.alias("status"), "entity",
        F.split_part("instance", F.lit("\x1f"), F.lit(2)).alias("instance"), "name", "is_ratio", "value", "message",
    )
