"""Row predicates. Each returns a boolean ``Column`` that is NULL for a NULL cell;
the null policy (fail, pass or ignore) is applied by the operator that uses it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column


def matches(c: Column | str, pattern: str) -> Column:
    """Pattern found anywhere in the text, with a non-empty match."""
    return F.regexp_extract(as_column(c).cast("string"), pattern, 0) != ""


def _as_bound(c: Column, bound) -> Column:
    """A text cell as a value of the bound's kind, NULL where it is none; other cells as they are."""
    kinds = ((dt.datetime, "timestamp"), (dt.date, "date"), (bool, "boolean"), ((int, float, Decimal), "double"))
    kind = next((name for types, name in kinds if isinstance(bound, types)), None)
    return c if kind is None else F.when(F.typeof(c) == "string", c.try_cast(kind))


def _compare(c: Column, bound, test) -> Column:
    """``test`` of the cell and the bound; a text cell is converted first, so that no cell can raise."""
    converted = _as_bound(c, bound)
    if converted is c:
        return test(c)
    # The type is known when the query is planned, so only one side is ever evaluated.
    return F.when(F.typeof(c) == "string", test(converted)).otherwise(test(c))


def split_values(values: str | Iterable[str]) -> list:
    """Items of a comma list, trimmed, empty ones dropped. A list is kept as it is."""
    if isinstance(values, str):
        return [v.strip() for v in values.split(",") if v.strip()]
    return list(values)


def in_set(c: Column | str, values: str | Iterable[str]) -> Column:
    """Case-sensitive membership in a list or a comma-separated text.

    A text cell is compared with a list of numbers or days by its value; a text that has none is no member.
    """
    items = split_values(values)
    col = as_column(c)
    if all(isinstance(v, str) for v in items):
        return col.cast("string").isin(items)
    member = F.lit(False)
    for kind in dict.fromkeys(type(v) for v in items):
        same = [v for v in items if type(v) is kind]
        member = member | F.coalesce(_compare(col, same[0], lambda x, same=same: x.isin(same)), F.lit(False))
    return F.when(col.isNotNull(), member)


def expr_true(condition: Column | str) -> Column:
    """A row condition given as SQL text or as a Column."""
    return F.expr(condition) if isinstance(condition, str) else condition


def between(c: Column | str, low=None, high=None) -> Column:
    """Closed range; an open side is given as None. A text without a value of the bound's kind is outside."""
    col = as_column(c)
    cond = None
    if low is not None:
        cond = F.coalesce(_compare(col, low, lambda x: x >= F.lit(low)), F.lit(False))
    if high is not None:
        upper = F.coalesce(_compare(col, high, lambda x: x <= F.lit(high)), F.lit(False))
        cond = upper if cond is None else cond & upper
    return col.isNotNull() if cond is None else F.when(col.isNotNull(), cond)
