"""Quality plans: validation, execution and result formatting.

A plan is a list of tests, one per row. The tests of a table are compiled into
one aggregation over it; referential-integrity tests add one key join each. Up
to the sink everything is one lazy DataFrame; only the plan itself, which is
configuration, is read on the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_column, indicator, parse_date, parse_ts, pct, run_stamp
from ..operators import metrics as m
from ..operators.planning import first_line
from ..operators.windows import union_frames
from ..sources.jdbc import JdbcPartition, read_jdbc
from ..sources.results import INDICATOR, PERCENT, STAMP, VALUE

# Test types, their subtypes and the order of the name parts.
COMPLETENESS = "Completitud"
CREDIBILITY = "Credibilidad"
ACCURACY = "Exactitud"
PRECISION = "Precision"
INTEGRITY = "Integridad Referencial"
CURRENCY = "Actualidad"
TYPES = (COMPLETENESS, CREDIBILITY, ACCURACY, PRECISION, INTEGRITY, CURRENCY)
BY_PATTERN = "Patron"
BY_VALUES = "Conjunto valores"
SYNTACTIC = "Sintactica"
SEMANTIC = "Semantica"
BY_DATE = "Fecha"
BY_DATE_TIME = "Fecha y hora"
NAME_PARTS = {
    COMPLETENESS: ("tabla", "columna"),
    CREDIBILITY: ("tipo_credibilidad", "tabla", "columna"),
    ACCURACY: ("tipo_exactitud", "tabla", "columna"),
    PRECISION: ("tabla", "columna"),
    INTEGRITY: ("tabla", "tabla_2", "columna"),
    CURRENCY: ("tabla", "columna"),
}

TableResolver = Callable[[str | None, str], DataFrame]


def frames_resolver(frames: dict[str, DataFrame]) -> TableResolver:
    """Tables of a plan given as DataFrames by name, whatever their schema."""
    return lambda _schema, name: frames[name]


def jdbc_resolver(
    spark: SparkSession,
    dialect: str,
    host: str,
    database: str,
    user: str,
    password: str,
    partitions: dict[str, JdbcPartition] | None = None,
) -> TableResolver:
    """Tables of a plan read from a database, those in ``partitions`` in parallel."""

    def resolve(schema: str | None, name: str) -> DataFrame:
        full = name if schema is None else f"{schema}.{name}"
        return read_jdbc(spark, dialect, host, database, full, user, password, (partitions or {}).get(name))

    return resolve


def _blank(name: str) -> Column:
    return F.coalesce(F.trim(as_column(name)) == "", F.lit(True))


def plan_tests(plan: DataFrame) -> DataFrame:
    """The plan with two more columns: the ``indicator`` name of every test and
    an ``error`` that is NULL for a test that can run."""
    kind = F.col("tipo")

    def subtype(name: str, *allowed: str) -> Column:
        return F.coalesce(~as_column(name).isin(*allowed), F.lit(True))

    limit = F.col("tiempo_limite")
    parsed = F.when(F.col("tipo_actualidad") == BY_DATE, parse_date(limit).isNull()).otherwise(parse_ts(limit).isNull())
    patterned = kind.isin(CREDIBILITY, ACCURACY)
    error = (
        F.when(F.coalesce(~kind.isin(*TYPES), F.lit(True)), F.lit("unknown test type"))
        .when(_blank("tabla") | _blank("columna"), F.lit("table and column are required"))
        .when(patterned & _blank("patron"), F.lit("pattern is required"))
        .when((kind == CREDIBILITY) & subtype("tipo_credibilidad", BY_PATTERN, BY_VALUES), F.lit("unknown subtype"))
        .when((kind == ACCURACY) & subtype("tipo_exactitud", SYNTACTIC, SEMANTIC), F.lit("unknown subtype"))
        .when(
            (kind == PRECISION) & ~F.coalesce(F.col("num_decimales").rlike("^[0-9]+$"), F.lit(False)),
            F.lit("number of decimals must be an integer"),
        )
        .when((kind == PRECISION) & (F.length(F.ltrim(F.col("num_decimales"), F.lit("0"))) > 3), F.lit("number of decimals is too large"))
        .when((kind == INTEGRITY) & (_blank("tabla_2") | _blank("columna_2")), F.lit("second table and column are required"))
        .when((kind == CURRENCY) & _blank("tiempo_limite"), F.lit("limit is required"))
        .when((kind == CURRENCY) & subtype("tipo_actualidad", BY_DATE, BY_DATE_TIME), F.lit("unknown subtype"))
        .when((kind == CURRENCY) & parsed, F.lit("limit is not a date"))
    )
    name = indicator(kind, F.col("tabla"), F.col("columna"))
    for known, parts in NAME_PARTS.items():
        name = F.when(kind == known, indicator(kind, *[F.col(p) for p in parts])).otherwise(name)
    return plan.select("*", name.alias("indicator"), error.alias("error"))


def validate_plan(plan: DataFrame) -> DataFrame:
    """The tests that cannot run, with their ``indicator`` name and ``error``."""
    return plan_tests(plan).filter(F.col("error").isNotNull())


def test_metric(test: Row, resolve: TableResolver) -> m.Metric:
    """The metric of one valid test."""
    col, kind = test["columna"], test["tipo"]
    if kind == COMPLETENESS:
        return m.completeness(col)
    if kind == PRECISION:
        return m.precision(col, test["num_decimales"])
    if kind == INTEGRITY:
        return m.referential_integrity(resolve(test["schema"], test["tabla_2"]), col, test["columna_2"])
    if kind == CURRENCY:
        measure = m.currency_date if test["tipo_actualidad"] == BY_DATE else m.currency_ts
        return measure(col, test["tiempo_limite"])
    if kind == CREDIBILITY:
        by_pattern = test["tipo_credibilidad"] == BY_PATTERN
        measure = m.credibility
    else:
        by_pattern = test["tipo_exactitud"] == SYNTACTIC
        measure = m.accuracy
    return measure(col, pattern=test["patron"]) if by_pattern else measure(col, values=test["patron"])


test_metric.__test__ = False  # not a pytest case


def _error_rows(spark: SparkSession, errors: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(n, None, e) for n, e in errors], "indicator string, value double, message string")


def run_plan(spark: SparkSession, plan: DataFrame, resolve: TableResolver, isolate: bool = False) -> DataFrame:
    """Measure every test: ``indicator, value, message``.

    ``resolve(schema, table)`` gives the DataFrame of a table. A test that is
    invalid, or whose table or column does not exist, gets a row with a NULL
    value and a message; the others run. All tests are one query. With
    ``isolate`` every table is measured at once, and a test that fails while
    running, for example because a column is computed by an expression that
    raises, gets a message too instead of ending the run.
    """
    errors: list[tuple[str, str]] = []
    by_table: dict[tuple, list[m.Metric]] = {}
    tables: dict[tuple, DataFrame] = {}

    def table(schema: str | None, name: str) -> DataFrame:
        if (schema, name) not in tables:
            tables[schema, name] = resolve(schema, name)
        return tables[schema, name]

    for test in plan_tests(plan).collect():
        problem = test["error"]
        if problem is None:
            try:
                table(test["schema"], test["tabla"])
                metric = replace(test_metric(test, table), instance=test["indicator"])
            except Exception as e:  # whatever keeps one table or test from being used is its message
                problem = first_line(e)
        if problem is None:
            by_table.setdefault((test["schema"], test["tabla"]), []).append(metric)
        else:
            errors.append((test["indicator"], problem))
    frames = [
        (m.run_isolated if isolate else m.run_metrics)(tables[key], found).select(F.col("instance").alias("indicator"), "value", "message")
        for key, found in by_table.items()
    ]
    if errors:
        frames.append(_error_rows(spark, errors))
    if not frames:
        return _error_rows(spark, [])
    return union_frames(frames)


def format_results(measured: DataFrame, run_ts: str | Column) -> DataFrame:
    """The result table: indicator, value, percentage and run stamp.

    Tests without a value have no row here; their messages stay in the input.
    """
    return measured.filter(F.col("value").isNotNull()).select(
        F.col("indicator").alias(INDICATOR),
        F.col("value").alias(VALUE),
        pct("value").alias(PERCENT),
        run_stamp(run_ts).alias(STAMP),
    )


def report(metrics: DataFrame, checks: DataFrame) -> DataFrame:
    """Analyzer metrics and check metrics in one table, percentages for ratios only."""
    frames = [
        df.select(F.lit(source).alias("source"), "entity", "instance", "name", "value",
                  F.when(F.col("is_ratio"), pct("value")).alias("percent"))
        for source, df in (("analysis", metrics), ("check", checks))
    ]
    return union_frames(frames)

