"""Evolution of indicators over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.windows import union_frames
from ..sources.results import INDICATOR, PERCENT


def union_history(frames: list[DataFrame]) -> DataFrame:
    """Histories of several origins as one; missing columns become NULL."""
    return union_frames(frames, allow_missing=True)


def percent_number() -> Column:
    """The percentage of a result row as a whole number."""
    return F.rtrim(F.col(PERCENT), F.lit("%")).try_cast("int").alias("percent")


def evolution(history: DataFrame) -> DataFrame:
    """One row per indicator and run: ``indicator, evaluation, percent, change``.

    ``change`` is the difference in percentage points to the previous run.
    """
    rows = history.select(
        F.col(f"`{INDICATOR}`").alias("indicator"),
        "evaluation",
        percent_number(),
    )
    # One row per run and indicator: the window spans the runs of one indicator.
    by_run = Window.partitionBy("indicator").orderBy("evaluation")
    return rows.withColumn("change", F.col("percent") - F.lag("percent").over(by_run))


def evolution_table(history: DataFrame, evaluations: list[str] | None = None) -> DataFrame:
    """Indicators as rows and runs as columns; naming the runs saves a job."""
    return evolution(history).groupBy("indicator").pivot("evaluation", evaluations).agg(F.first("percent"))
