"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS = 1 << 30


def bounded(rows: DataFrame, key: str, limit: int, by: str) -> DataFrame:
    """About ``limit`` rows of each value of ``by`` at most, chosen by a hash of ``key``.

    Values of ``by`` are class labels, few by nature; one count of each reaches
    the driver. The hash makes the choice the same in every run.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}
    mark = F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.lit(STEPS))
    chosen = F.lit(False)
    for value, n in counts.items():
        if value is not None:
            chosen |= (F.col(by) == F.lit(value)) & (mark < F.lit(int(STEPS * min(1.0, limit / n)) + 1))
    return rows.filter(chosen)
