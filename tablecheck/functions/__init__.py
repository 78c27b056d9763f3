"""Column-level building blocks."""

from .columns import (
    as_column,
    as_text,
    cents_to_dollars,
    customer_type,
    flag_eq,
    indicator,
    parse_date,
    parse_ts,
    pct,
    quoted,
    run_stamp,
    surrogate_key,
    trunc_day,
)
from .predicates import between, expr_true, in_set, matches, split_values

__all__ = [
    "as_column", "as_text", "between", "cents_to_dollars", "customer_type", "expr_true",
    "flag_eq", "in_set", "indicator", "matches", "parse_date", "parse_ts", "pct", "quoted",
    "run_stamp", "split_values", "surrogate_key", "trunc_day",
]
