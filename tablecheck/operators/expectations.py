"""Expectations with complete lists of unexpected rows.

Null policy *ignore*: except for the not-null rule, NULL cells are neither
expected nor unexpected. All row-level rules of a table share one scan, both
for the summary and for the violations.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import as_column
from ..functions.predicates import between, expr_true, in_set, matches
from .aggregates import frequencies
from .joins import rows_in
from .planning import RuleError, compile_patterns, isolated, non_raising, plan_errors
from .windows import union_frames


@dataclass(frozen=True, eq=False)
class Expectation:
    """``unexpected`` marks offending rows; None stands for the uniqueness rule.

    ``condition`` is what a row-level rule asks of a cell, ``pattern`` and
    ``bounds`` are what is looked at before it runs.
    """

    rule: str
    column: str
    unexpected: Column | None
    mostly: float = 1.0
    counts_nulls: bool = False
    condition: Column | None = None
    pattern: str | None = None
    bounds: tuple = ()


def _row_rule(rule: str, col: str, condition: Column, mostly: float, **planned) -> Expectation:
    bad = as_column(col).isNotNull() & ~F.coalesce(condition, F.lit(False))
    return Expectation(f"{rule}({col})", col, bad, mostly, condition=condition, **planned)


def expect_not_null(col: str, mostly: float = 1.0) -> Expectation:
    return Expectation(f"not_null({col})", col, as_column(col).isNull(), mostly, counts_nulls=True)


def expect_match_regex(col: str, regex: str, mostly: float = 1.0) -> Expectation:
    return _row_rule("match_regex", col, matches(col, regex), mostly, pattern=regex)


def expect_between(col: str, low=None, high=None, mostly: float = 1.0) -> Expectation:
    return _row_rule("between", col, between(col, low, high), mostly, bounds=(low, high))


def expect_in_set(col: str, values: str | Iterable[str], mostly: float = 1.0) -> Expectation:
    return _row_rule("in_set", col, in_set(col, values), mostly)


def expect_true(condition: Column | str, col: str, name: str, mostly: float = 1.0) -> Expectation:
    """Rows whose cell is not NULL meet a condition of the caller."""
    return _row_rule(name, col, expr_true(condition), mostly)


def expect_unique(col: str, mostly: float = 1.0) -> Expectation:
    """Every row of a value that occurs more than once is unexpected."""
    return Expectation(f"unique({col})", col, None, mostly)


def _summary_struct(e: Expectation, total: Column, missing: Column, unexpected: Column) -> Column:
    # The not-null rule judges every row, the others the non-NULL ones.
    base = total if e.counts_nulls else total - missing
    percent = F.coalesce(F.try_divide(unexpected * 100.0, base), F.lit(0.0))
    return F.struct(
        F.lit(e.rule).alias("rule"),
        F.lit(e.column).alias("column"),
        total.alias("element_count"),
        missing.alias("missing_count"),
        unexpected.alias("unexpected_count"),
        percent.alias("unexpected_percent"),
        F.try_divide(unexpected * 100.0, total).alias("unexpected_percent_total"),
        F.coalesce(F.try_divide(base - unexpected, base) >= F.lit(e.mostly), F.lit(True)).alias("success"),
    )


def _planned(df: DataFrame, expectations: list[Expectation]) -> None:
    """Raise unless all columns and rules can be planned, patterns compile and bounds have a value of the column's type."""
    rules = [F.count_if(e.unexpected).alias(f"r{i}") for i, e in enumerate(expectations) if e.unexpected is not None]
    cells = [F.count(as_column(e.column)).alias(f"c{i}") for i, e in enumerate(expectations)]
    df.agg(*cells, *rules).schema  # noqa: B018
    spark = df.sparkSession
    compile_patterns(spark, [e.pattern for e in expectations])
    types = [df.select(as_column(e.column)).schema.fields[0].dataType for e in expectations]
    texts = [(b, t) for e, t in zip(expectations, types) for b in e.bounds if isinstance(b, str) and t.typeName() != "string"]
    if texts:
        found = spark.range(1).select(*[F.lit(b).try_cast(t).isNull() for b, t in texts]).first()
        for (bound, kind), missing in zip(texts, found):
            if missing:
                raise RuleError(f"the bound '{bound}' is no {kind.simpleString()}")


RESULT = (
    "rule string, column string, element_count long, missing_count long, unexpected_count long, unexpected_percent double, "
    "unexpected_percent_total double, success boolean, message string"
)


def _failed(df: DataFrame, e: Expectation, problem: str) -> DataFrame:
    counts = [F.lit(None).cast("bigint").alias(f"{c}_count") for c in ("element", "missing", "unexpected")]
    shares = [F.lit(None).cast("double").alias(c) for c in ("unexpected_percent", "unexpected_percent_total")]
    names = F.lit(e.rule).alias("rule"), F.lit(e.column).alias("column")
    return df.sparkSession.range(1).select(*names, *counts, *shares, F.lit(False).alias("success"), F.lit(problem).alias("message"))


def summarize(df: DataFrame, expectations: list[Expectation], digest: bool = False) -> DataFrame:
    """One row per expectation with counts, percentages, success and message.

    Row-level rules are counted in one aggregation; each uniqueness rule takes
    one group-by of its column (``digest``: of a hash of it, for long texts). A
    rule that cannot be planned, such as one on a column that does not exist, is
    no success and has a message instead of counts; the others are judged.
    """
    if not expectations:
        return df.sparkSession.createDataFrame([], RESULT)
    problems = plan_errors(expectations, lambda some: _planned(df, some))
    failed = [_failed(df, e, p) for e, p in zip(expectations, problems) if p is not None]
    expectations = [e for e, p in zip(expectations, problems) if p is None]
    rowwise = [e for e in expectations if e.unexpected is not None]
    frames = []
    if rowwise:
        counts = df.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(as_column(e.column).isNull()).alias(f"missing{i}") for i, e in enumerate(rowwise)],
            *[F.count_if(e.unexpected).alias(f"bad{i}") for i, e in enumerate(rowwise)],
        )
        structs = [
            _summary_struct(e, F.col("total"), F.col(f"missing{i}"), F.col(f"bad{i}")) for i, e in enumerate(rowwise)
        ]
        frames.append(counts.select(F.inline(F.array(*structs))))
    for e in expectations:
        if e.unexpected is None:
            c = as_column(e.column)
            zero = F.lit(0).cast("bigint")
            counts = frequencies(df, [e.column], digest).agg(
                F.coalesce(F.sum("n"), zero).alias("total"),
                F.coalesce(F.sum(F.when(c.isNull(), F.col("n"))), zero).alias("missing"),
                F.coalesce(F.sum(F.when(c.isNotNull() & (F.col("n") > 1), F.col("n"))), zero).alias("bad"),
            )
            struct = _summary_struct(e, F.col("total"), F.col("missing"), F.col("bad"))
            frames.append(counts.select(F.inline(F.array(struct))))
    message = F.lit(None).cast("string").alias("message")
    return union_frames([f.select("*", message) for f in frames] + failed)


def summarize_isolated(df: DataFrame, expectations: list[Expectation], digest: bool = False) -> DataFrame:
    """As :func:`summarize`, counted at once, with rules that fail while running kept apart.

    Those are no success and have a message instead of counts. One row per rule
    reaches the driver.
    """
    rows = isolated(
        expectations,
        lambda some: summarize(df, some, digest).collect(),
        lambda e, problem: _failed(df, e, problem).collect(),
    )
    return df.sparkSession.createDataFrame(rows, RESULT)


def summarize_guarded(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """Row-level rules in one lazy scan that no cell can end: as :func:`summarize`, with ``unjudged_count`` instead of a message.

    A cell for which a rule's condition has no outcome, such as a text that it
    cannot convert, is unjudged: neither expected nor unexpected, and left out of
    the percentages like a missing one.
    """
    rowwise = [e for e in expectations if e.unexpected is not None]
    if not rowwise:
        empty = df.sparkSession.createDataFrame([], RESULT)
        return empty.drop("message").withColumn("unjudged_count", F.lit(0).cast("long"))
    with non_raising(df.sparkSession):
        missing = {i: as_column(e.column).isNull() for i, e in enumerate(rowwise)}
        unjudged = {
            i: F.lit(False) if e.condition is None else ~missing[i] & e.condition.isNull() for i, e in enumerate(rowwise)
        }
        counts = df.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(missing[i]).alias(f"missing{i}") for i in missing],
            *[F.count_if(unjudged[i]).alias(f"unjudged{i}") for i in missing],
            *[F.count_if(e.unexpected & ~unjudged[i]).alias(f"bad{i}") for i, e in enumerate(rowwise)],
        )
    structs = []
    for i, e in enumerate(rowwise):
        judged = _summary_struct(e, F.col("total"), F.col(f"missing{i}") + F.col(f"unjudged{i}"), F.col(f"bad{i}"))
        structs.append(judged.withField("missing_count", F.col(f"missing{i}")).withField("unjudged_count", F.col(f"unjudged{i}")))
    return counts.select(F.inline(F.array(*structs)))


def unjudged_rows(df: DataFrame, expectations: list[Expectation], key_cols: list[str]) -> DataFrame:
    """The cells that rules cannot judge, as ``key_cols..., rule, value`` (text), in one scan."""
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    as_column(e.column).isNotNull() & e.condition.isNull(),
                    F.struct(F.lit(e.rule).alias("rule"), as_column(e.column).cast("string").alias("value")),
                )
                for e in expectations
                if e.condition is not None
            ]
        )
    )
    with non_raising(df.sparkSession):
        return df.select(*[as_column(k) for k in key_cols], F.inline(found))


def duplicated_rows(df: DataFrame, col: str, digest: bool = False) -> DataFrame:
    """Every row whose non-NULL value occurs more than once.

    Only the values that repeat are joined back, in an ordinary semi-join. With
    ``digest`` a hash of a long text is grouped and joined instead of the text.
    """
    key = "__key"
    c = as_column(col)
    keyed = df.withColumn(key, F.sha2(c, 256) if digest and dict(df.dtypes)[col] == "string" else c)
    counts = frequencies(keyed.filter(F.col(key).isNotNull()), [key])
    repeated = counts.filter(F.col("n") > 1)
    return rows_in(keyed, repeated, [key]).drop(key)


def violations(
    df: DataFrame, expectations: list[Expectation], key_cols: list[str], digest: bool = False
) -> DataFrame:
    """Every offending cell as ``key_cols..., rule, value`` (text), never collected.

    One scan serves all row-level rules; each uniqueness rule adds one semi-join.
    A rule that cannot be planned has no rows here; :func:`summarize` says why.
    """
    problems = plan_errors(expectations, lambda some: _planned(df, some))
    expectations = [e for e, p in zip(expectations, problems) if p is None]
    keys = [as_column(k) for k in key_cols]
    rowwise = [e for e in expectations if e.unexpected is not None]
    frames = []
    if rowwise:
        found = F.array_compact(
            F.array(
                *[
                    F.when(
                        e.unexpected,
                        F.struct(F.lit(e.rule).alias("rule"), as_column(e.column).cast("string").alias("value")),
                    )
                    for e in rowwise
                ]
            )
        )
        frames.append(df.select(*keys, F.inline(found)))
    for e in expectations:
        if e.unexpected is None:
            narrow = df.select(*[as_column(c) for c in dict.fromkeys([*key_cols, e.column])])
            dup = duplicated_rows(narrow, e.column, digest)
            frames.append(dup.select(*keys, F.lit(e.rule).alias("rule"), as_column(e.column).cast("string").alias("value")))
    if not frames:
        rule = [F.lit(None).cast("string").alias(c) for c in ("rule", "value")]
        return df.select(*keys, *rule).filter(F.lit(False))
    return union_frames(frames)


def violation_counts(found: DataFrame) -> DataFrame:
    """Offending values per rule with their number of rows."""
    return found.groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n"))


def run_suite(
    df: DataFrame, suite: str, expectations: list[Expectation], digest: bool = False, isolate: bool = False
) -> DataFrame:
    """All expectations of a table as one validation: the summary rows plus
    ``suite`` and ``suite_success``. With ``isolate`` a rule that fails while
    running does not end the others, see :func:`summarize_isolated`."""
    judged = (summarize_isolated if isolate else summarize)(df, expectations, digest)
    rows = judged.withColumn("suite", F.lit(suite))
    # A handful of summary rows, one per expectation.
    return rows.withColumn("suite_success", F.bool_and("success").over(Window.partitionBy("suite")))
