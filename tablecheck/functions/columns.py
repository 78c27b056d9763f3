"""Scalar column functions: naming, cleaning, parsing and labelling.

Every function takes a column name or a ``Column`` and returns a ``Column``
made of built-in expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of plans, inputs and results.
DATE_FORMAT_SLASH = "dd/MM/yyyy"
TIMESTAMP_FORMAT_SLASH = "dd/MM/yyyy HH:mm:ss"
RUN_STAMP_FORMAT = "yyyy-MM-dd_HH:mm"

# Fixed value: what a NULL part of a surrogate key is replaced by.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def quoted(name: str) -> str:
    """Back-quote a column name so that spaces, dots and accents are safe."""
    return "`" + name.replace("`", "``") + "`"


def as_column(c: Column | str) -> Column:
    """A name becomes a quoted column reference; a Column is left alone."""
    return F.col(quoted(c)) if isinstance(c, str) else c


def trunc_day(c: Column | str) -> Column:
    """The calendar day of a timestamp, as a date."""
    return F.to_date(as_column(c))


def cents_to_dollars(c: Column | str) -> Column:
    """Integer cents to ``decimal(16,2)`` dollars."""
    return (as_column(c).cast("decimal(16,2)") / 100).cast("decimal(16,2)")


def flag_eq(c: Column | str, value) -> Column:
    """True where the column equals the value, false elsewhere, NULL included."""
    return F.coalesce(as_column(c) == F.lit(value), F.lit(False))


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 of the dash-joined column texts, with a marker for NULL."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def customer_type(is_repeat: Column | str) -> Column:
    """``returning`` for a repeat buyer, ``new`` otherwise (also for NULL)."""
    return F.when(as_column(is_repeat), F.lit("returning")).otherwise(F.lit("new"))


def pct(c: Column | str) -> Column:
    """Ratio as a percentage text, truncated (not rounded) to whole percents."""
    return F.concat((as_column(c) * 100).cast("int").cast("string"), F.lit("%"))


def indicator(kind: Column | str, *parts: Column | str) -> Column:
    """Indicator name: the test type and its components joined with ``_``."""
    cols = [F.lit(p) if isinstance(p, str) else p for p in (kind, *parts)]
    return F.concat_ws("_", *cols)


def run_stamp(ts: Column | str) -> Column:
    """Run stamp ``yyyy-MM-dd_HH:mm`` of a timestamp (a text is cast first)."""
    value = F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts
    return F.date_format(value, RUN_STAMP_FORMAT)


def as_text(c: Column | str) -> Column:
    """The column as text; doubles from 1e7 on use exponent notation."""
    return as_column(c).cast("string")


def _slash(text: Column, parsed: Column) -> Column:
    """Parse only texts with a slash: a failing parse is slow, the rest cannot fit."""
    return F.when(text.contains("/"), parsed)


def parse_date(c: Column | str) -> Column:
    """Date from ``dd/MM/yyyy`` text or anything castable; NULL if neither fits."""
    col = as_column(c)
    text = col.cast("string")
    return F.coalesce(_slash(text, F.try_to_date(text, DATE_FORMAT_SLASH)), col.try_cast("date"))


def parse_ts(c: Column | str) -> Column:
    """Timestamp from ``dd/MM/yyyy HH:mm:ss`` text or anything castable."""
    col = as_column(c)
    text = col.cast("string")
    return F.coalesce(
        _slash(text, F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT_SLASH))), col.try_cast("timestamp")
    )
