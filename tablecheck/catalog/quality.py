"""Quality metrics, plans, reports and histories over the given tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import indicator, pct
from ..operators import checks as ck
from ..operators import metrics as m
from ..operators.aggregates import frequencies, row_count
from ..operators.joins import key_match, orphans
from ..operators.windows import union_frames
from ..plans import quality as q
from ..plans.history import evolution, evolution_table, percent_number, union_history
from ..sources.plan_files import PLAN_FIELDS, PLAN_SCHEMA, load_plan, save_plan
from ..sources.results import INDICATOR, PERCENT, STAMP, VALUE, load_history, save_results
from ..sources.scratch import scratch_path
from .data import portable, query, table


RESULT_FIELDS = (INDICATOR, VALUE, PERCENT, STAMP)


def _measured(df: DataFrame) -> DataFrame:
    return df.select("instance", "name", "value")


def _customers(spark: SparkSession, d: str) -> DataFrame:
    """Customers with a segment that is NULL for one of its values."""
    return table(spark, d, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders with a NULL-bearing status and the order day as mixed texts."""
    return (
        table(spark, d, "orders")
        .withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
        .withColumn(
            "day_text",
            F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
                F.date_format("o_orderdate", "dd/MM/yyyy")
            ),
        )
    )


CUSTOMERS_SQL = "(SELECT *, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)"
ORDERS_SQL = """(SELECT *, nullif(o_orderstatus, 'P') AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS day_text
  FROM orders)"""


def _ratio_sql(instance: str, name: str, condition: str, source: str) -> str:
    return (
        f"SELECT '{instance}' AS instance, '{name}' AS name, "
        f"CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / count(*) AS value FROM {source}"
    )


def _union_sql(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


@query(
    "completeness",
    _union_sql(
        _ratio_sql("segment", "Completeness", "segment IS NOT NULL", CUSTOMERS_SQL),
        _ratio_sql("c_name", "Completeness", "c_name IS NOT NULL", CUSTOMERS_SQL),
        "SELECT '*', 'Size', CAST(count(*) AS DOUBLE) FROM customer",
    ),
)
def completeness(spark, d):
    metrics = [m.completeness("segment"), m.completeness("c_name"), m.size()]
    return _measured(m.run_metrics(_customers(spark, d), metrics))


@query(
    "credibility_pattern",
    _union_sql(
        _ratio_sql("c_name", "PatternMatch", r"regexp_extract(c_name, '^Customer#\d{9}$') <> ''", "customer"),
        _ratio_sql("segment", "PatternMatch", "regexp_extract(segment, 'M[A-Z]') <> ''", CUSTOMERS_SQL),
    ),
)
def credibility_pattern(spark, d):
    metrics = [m.credibility("c_name", pattern=r"^Customer#\d{9}$"), m.credibility("segment", pattern=" M[A-Z] ")]
    return _measured(m.run_metrics(_customers(spark, d), metrics))


@query(
    "credibility_set",
    _union_sql(
        _ratio_sql("status", "Compliance", "status IN ('O', 'F')", ORDERS_SQL),
        _ratio_sql("o_orderpriority", "Compliance", "o_orderpriority IN ('1-URGENT', 'O''Brien')", ORDERS_SQL),
    ),
)
def credibility_set(spark, d):
    metrics = [m.credibility("status", values="O, F,"), m.credibility("o_orderpriority", values=["1-URGENT", "O'Brien"])]
    return _measured(m.run_metrics(_orders(spark, d), metrics))


@query(
    "accuracy_syntactic",
    _ratio_sql("p_brand", "PatternMatch", "regexp_extract(p_brand, '^Brand#[1-9]$') <> ''", "part"),
)
def accuracy_syntactic(spark, d):
    return _measured(m.run_metrics(table(spark, d, "part"), [m.accuracy("p_brand", pattern="^Brand#[1-9]$")]))


@query(
    "accuracy_semantic",
    _union_sql(
        _ratio_sql("p_type", "Compliance", "p_type IN ('ECONOMY', 'SMALL')", "part"),
        _ratio_sql("p_size", "Compliance", "CAST(p_size AS VARCHAR) IN ('1', '20')", "part"),
    ),
)
def accuracy_semantic(spark, d):
    metrics = [m.accuracy("p_type", values="ECONOMY,SMALL"), m.accuracy("p_size", values="1,20")]
    return _measured(m.run_metrics(table(spark, d, "part"), metrics))


def _precision_sql(col: str, source: str, n: int) -> str:
    text = f"CAST({col} AS VARCHAR)"
    return _ratio_sql(f"{col}", "PatternMatch", f"regexp_matches({text}, '{m.precision_pattern(n)}')", source)


@query(
    "precision_decimals",
    _union_sql(*[_precision_sql("l_extendedprice", "lineitem", n) for n in (0, 1, 2)])
    + "\nUNION ALL\n"
    + _union_sql(*[_precision_sql("c_acctbal", "customer", n) for n in (1, 2)])
    + "\nUNION ALL\n"
    + _precision_sql("p_size", "part", 0),
)
def precision_decimals(spark, d):
    lineitem = m.run_metrics(table(spark, d, "lineitem"), [m.precision("l_extendedprice", n) for n in (0, 1, 2)])
    customer = m.run_metrics(table(spark, d, "customer"), [m.precision("c_acctbal", n) for n in ("1", "2")])
    part = m.run_metrics(table(spark, d, "part"), [m.precision("p_size", 0)])
    return _measured(union_frames([lineitem, customer, part]))


DAY_SQL = "coalesce(CAST(try_strptime(day_text, '%d/%m/%Y') AS DATE), try_cast(day_text AS DATE))"


@query(
    "currency_date",
    _union_sql(
        _ratio_sql("day_text", "Compliance", f"{DAY_SQL} >= DATE '1998-01-01'", ORDERS_SQL),
        _ratio_sql("day_text", "Compliance", f"{DAY_SQL} >= DATE '2000-06-30'", ORDERS_SQL),
        _ratio_sql("o_orderdate", "Compliance", "o_orderdate >= DATE '1998-01-01'", ORDERS_SQL),
        _ratio_sql("status", "Compliance", "try_cast(status AS DATE) >= DATE '1998-01-01'", ORDERS_SQL),
    ),
)
def currency_date(spark, d):
    metrics = [
        m.currency_date("day_text", "1998-01-01"),
        m.currency_date("day_text", "30/06/2000"),
        m.currency_date("o_orderdate", "1998-01-01"),
        m.currency_date("status", "1998-01-01"),
    ]
    return _measured(m.run_metrics(_orders(spark, d), metrics))


@query(
    "currency_timestamp",
    _union_sql(
        _ratio_sql("ts_text", "Compliance", "date_trunc('second', ts) >= TIMESTAMP '2024-01-15 12:00:00'", "events"),
        _ratio_sql("ts", "Compliance", "ts >= TIMESTAMP '2024-01-20 06:30:00'", "events"),
    ),
)
def currency_timestamp(spark, d):
    events = table(spark, d, "events").withColumn(
        "ts_text",
        F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(
            F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
        ),
    )
    metrics = [m.currency_ts("ts_text", "2024-01-15 12:00:00"), m.currency_ts("ts", "20/01/2024 06:30:00")]
    return _measured(m.run_metrics(events, metrics))


@query(
    "referential_integrity",
    """SELECT 'doc_id' AS instance, 'ReferentialIntegrity' AS name,
  CAST(count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS DOUBLE) / count(*) AS value FROM documents
UNION ALL SELECT 'o_orderkey', 'ReferentialIntegrity',
  CAST(count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS DOUBLE) / count(*) FROM orders
UNION ALL SELECT 'l_orderkey', 'ReferentialIntegrity',
  CAST(count(*) FILTER (WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) AS DOUBLE) / count(*)
  FROM lineitem
UNION ALL SELECT 'segment', 'ReferentialIntegrity',
  CAST(count(*) FILTER (WHERE segment IN (SELECT c_mktsegment FROM customer)) AS DOUBLE) / count(*)
  FROM (SELECT nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)""",
)
def referential_integrity(spark, d):
    orders, lineitem = table(spark, d, "orders"), table(spark, d, "lineitem")
    finished = orders.filter(F.col("o_orderstatus") == "F")
    frames = [
        m.run_metrics(
            table(spark, d, "documents"), [m.referential_integrity(table(spark, d, "labels"), "doc_id", "doc_id")]
        ),
        m.run_metrics(orders, [m.referential_integrity(lineitem, "o_orderkey", "l_orderkey")]),
        m.run_metrics(lineitem, [m.referential_integrity(finished, "l_orderkey", "o_orderkey")]),
        m.run_metrics(
            _customers(spark, d), [m.referential_integrity(table(spark, d, "customer"), "segment", "c_mktsegment")]
        ),
    ]
    return _measured(union_frames(frames))


@query(
    "key_match",
    """SELECT CAST(key AS BIGINT) AS key, n, key IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45) AS matched
FROM (SELECT l_partkey AS key, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def key_matches(spark, d):
    lineitem = table(spark, d, "lineitem")
    return key_match(lineitem, lineitem.filter("l_quantity >= 45"), "l_partkey", "l_partkey")


@query(
    "uniqueness",
    """SELECT 'l_orderkey,l_linenumber' AS instance, 'Uniqueness' AS name,
  CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n) AS value
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'text', 'Uniqueness', CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n)
  FROM (SELECT count(*) AS n FROM documents GROUP BY text)
UNION ALL SELECT 'segment', 'Uniqueness', CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n)
  FROM (SELECT nullif(c_mktsegment, 'BUILDING') AS s, count(*) AS n FROM customer GROUP BY 1) WHERE s IS NOT NULL""",
)
def uniqueness(spark, d):
    frames = [
        m.run_metrics(table(spark, d, "lineitem"), [m.uniqueness(["l_orderkey", "l_linenumber"])]),
        m.run_metrics(table(spark, d, "documents"), [m.uniqueness("text", digest=True)]),
        m.run_metrics(_customers(spark, d), [m.uniqueness("segment")]),
    ]
    return _measured(union_frames(frames))


@query("frequencies", "SELECT nullif(event_type, 'view') AS kind, user_id, count(*) AS n FROM events GROUP BY 1, 2")
def key_frequencies(spark, d):
    events = table(spark, d, "events").withColumn("kind", F.nullif("event_type", F.lit("view")))
    return frequencies(events, ["kind", "user_id"])


@query(
    "row_count",
    "SELECT count(*) AS n FROM lineitem UNION ALL SELECT count(*) FROM lineitem WHERE l_discount > CAST(0.05 AS DOUBLE)",
)
def row_counts(spark, d):
    lineitem = table(spark, d, "lineitem")
    return union_frames([row_count(lineitem), row_count(lineitem, "l_discount > 0.05D")])


@query(
    "minimum_where",
    """SELECT 'o_totalprice' AS instance, 'Minimum' AS name, min(o_totalprice) AS value FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'o_custkey', 'Minimum', CAST(min(o_custkey) AS DOUBLE) FROM orders WHERE o_totalprice >= 300000""",
)
def minimum_where(spark, d):
    metrics = [m.minimum("o_totalprice", "o_orderstatus = 'F'"), m.minimum("o_custkey", F.col("o_totalprice") >= 300000)]
    return _measured(m.run_metrics(table(spark, d, "orders"), metrics))


@query(
    "contained_in",
    _ratio_sql("status", "Compliance", "status IS NULL OR status IN ('O')", ORDERS_SQL),
)
def contained_in(spark, d):
    return _measured(m.run_metrics(_orders(spark, d), [m.is_contained_in("status", ["O"])]))


SHIPPED_SQL = "(SELECT l_shipdate, o_orderdate FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"


def _shipped(spark, d) -> DataFrame:
    """Items with the date of their order."""
    dates = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return items.join(dates, "l_orderkey", "left")


@query("satisfies", _ratio_sql("ships after order", "Compliance", "l_shipdate >= o_orderdate", SHIPPED_SQL))
def satisfies(spark, d):
    return _measured(
        m.run_metrics(_shipped(spark, d), [m.satisfies("l_shipdate >= o_orderdate", "ships after order")])
    )


@query(
    "metric_where",
    f"""SELECT 'status' AS instance, 'Completeness' AS name, CAST(count(status) AS DOUBLE) / count(*) AS value
  FROM {ORDERS_SQL} WHERE o_totalprice > 250000
UNION ALL SELECT 'price above 1000', 'Compliance', CAST(count(*) FILTER (WHERE o_totalprice > 1000) AS DOUBLE) / count(*)
  FROM {ORDERS_SQL} WHERE status = 'F'""",
)
def metric_where(spark, d):
    metrics = [
        m.completeness("status", where="o_totalprice > 250000"),
        m.compliance("price above 1000", "o_totalprice > 1000", where="status = 'F'"),
    ]
    return _measured(m.run_metrics(_orders(spark, d), metrics))


def _checks() -> list[ck.Check]:
    return [
        ck.Check(ck.WARNING, "status is known", m.is_contained_in("status", ["O", "F"]), lambda v: v >= 1.0),
        ck.Check(ck.ERROR, "price is positive", m.satisfies("o_totalprice > 0", "positive"), lambda v: v == 1.0),
        ck.Check(ck.ERROR, "status is complete", m.completeness("status")),
        ck.Check(ck.WARNING, "mostly recent", m.currency_date("day_text", "1996-01-01"), lambda v: v >= 0.5),
    ]


CHECKS_SQL = f"""SELECT "check", level, instance, name, value, CASE WHEN held THEN 'Success' ELSE level END AS status FROM (
SELECT *, CASE WHEN "check" = 'mostly recent' THEN value >= 0.5 ELSE value = 1.0 END AS held FROM (
SELECT 'status is known' AS "check", 'Warning' AS level, * FROM ({_ratio_sql('status', 'Compliance', "status IS NULL OR status IN ('O', 'F')", ORDERS_SQL)})
UNION ALL SELECT 'price is positive', 'Error', * FROM ({_ratio_sql('positive', 'Compliance', 'o_totalprice > 0', ORDERS_SQL)})
UNION ALL SELECT 'status is complete', 'Error', * FROM ({_ratio_sql('status', 'Completeness', 'status IS NOT NULL', ORDERS_SQL)})
UNION ALL SELECT 'mostly recent', 'Warning', * FROM ({_ratio_sql('day_text', 'Compliance', f"{DAY_SQL} >= DATE '1996-01-01'", ORDERS_SQL)})))"""


@query("check_status", CHECKS_SQL)
def check_status(spark, d):
    return ck.run_checks(_orders(spark, d), _checks()).select("check", "level", "instance", "name", "value", "status")


@query(
    "empty_input",
    """SELECT 'o_orderstatus' AS instance, 'Completeness' AS name, CAST(NULL AS DOUBLE) AS value, 'no rows to measure' AS message
WHERE (SELECT count(*) FROM orders WHERE o_totalprice < 0) = 0
UNION ALL SELECT 'o_orderkey', 'Uniqueness', CAST(NULL AS DOUBLE), 'no rows to measure'
UNION ALL SELECT 'o_orderkey', 'ReferentialIntegrity', CAST(NULL AS DOUBLE), 'no rows to measure'""",
)
def empty_input(spark, d):
    none = table(spark, d, "orders").filter("o_totalprice < 0")
    metrics = [
        m.completeness("o_orderstatus"),
        m.uniqueness("o_orderkey"),
        m.referential_integrity(table(spark, d, "lineitem"), "o_orderkey", "l_orderkey"),
    ]
    return m.run_metrics(none, metrics).select("instance", "name", "value", "message")


@query(
    "missing_column",
    _union_sql(
        f"SELECT *, false AS failed FROM ({_ratio_sql('segment', 'Completeness', 'segment IS NOT NULL', CUSTOMERS_SQL)})",
        "SELECT 'rating', 'PatternMatch', CAST(NULL AS DOUBLE), true",
        "SELECT 'unreadable', 'PatternMatch', CAST(NULL AS DOUBLE), true",
    ),
)
def missing_column(spark, d):
    customers = _customers(spark, d).withColumn("unreadable", F.col("c_name"))
    metrics = [m.completeness("segment"), m.pattern_match("rating", "[A-E][+-]?"), m.pattern_match("unreadable", "^[a-z")]
    rows = m.run_metrics(customers, metrics)
    return rows.select("instance", "name", "value", F.col("message").isNotNull().alias("failed"))


# ---------------------------------------------------------------- plans


def plan_frame(spark: SparkSession, tests: list[dict[str, str]]) -> DataFrame:
    """A plan from test descriptions; fields that a test lacks are NULL."""
    columns = {f: pa.array([t.get(f) for t in tests], pa.string()) for f in PLAN_FIELDS}
    return spark.createDataFrame(pa.table(columns), PLAN_SCHEMA)


def _test(kind: str, column: str, table_name: str, **more: str) -> dict[str, str]:
    return {"tipo": kind, "columna": column, "tabla": table_name, "schema": "shop", **more}


# Fourteen tests over seven tables.
PLAN = [
    _test(q.CREDIBILITY, "event_type", "events", patron="^(view|click)$", tipo_credibilidad=q.BY_PATTERN),
    _test(q.PRECISION, "l_discount", "lineitem", num_decimales="2"),
    _test(q.ACCURACY, "l_returnflag", "lineitem", patron="R , A", tipo_exactitud=q.SEMANTIC),
    _test(q.INTEGRITY, "l_partkey", "lineitem", columna_2="p_partkey", tabla_2="part"),
    _test(q.CREDIBILITY, "o_orderpriority", "orders", patron="1-URGENT,2-HIGH", tipo_credibilidad=q.BY_VALUES),
    _test(q.COMPLETENESS, "status", "orders"),
    _test(q.CURRENCY, "day_text", "orders", tiempo_limite="1996-10-01", tipo_actualidad=q.BY_DATE),
    _test(q.CURRENCY, "ts", "events", tiempo_limite="15/01/2024 06:30:00", tipo_actualidad=q.BY_DATE_TIME),
    _test(q.INTEGRITY, "doc_id", "documents", columna_2="doc_id", tabla_2="labels"),
    _test(q.ACCURACY, "lang", "documents", patron="^(en|de)$", tipo_exactitud=q.SYNTACTIC),
    _test(q.INTEGRITY, "s_nationkey", "supplier", columna_2="c_nationkey", tabla_2="customer"),
    _test(q.CREDIBILITY, "p_brand", "part", patron=" [13579]$", tipo_credibilidad=q.BY_PATTERN),
    _test(q.PRECISION, "p_retailprice", "part", num_decimales="1"),
    _test(q.COMPLETENESS, "segment", "customer"),
]

PLAN_STAMP = "2024-11-05 07:08:09"


def _named_sql(name: str, condition: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS indicator, CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / count(*) AS value FROM {source}"
    )


PLAN_SQL = _union_sql(
    _named_sql("Credibilidad_Patron_events_event_type", "event_type IN ('view', 'click')", "events"),
    _named_sql("Precision_lineitem_l_discount", r"regexp_matches(CAST(l_discount AS VARCHAR), '^\d+\.\d{2,}$')", "lineitem"),
    _named_sql("Exactitud_Semantica_lineitem_l_returnflag", "l_returnflag IN ('R', 'A')", "lineitem"),
    _named_sql("Integridad Referencial_lineitem_part_l_partkey", "l_partkey IN (SELECT p_partkey FROM part)", "lineitem"),
    _named_sql("Credibilidad_Conjunto valores_orders_o_orderpriority", "o_orderpriority IN ('1-URGENT', '2-HIGH')", "orders"),
    _named_sql("Completitud_orders_status", "status IS NOT NULL", ORDERS_SQL),
    _named_sql("Actualidad_orders_day_text", f"{DAY_SQL} >= DATE '1996-10-01'", ORDERS_SQL),
    _named_sql("Actualidad_events_ts", "ts >= TIMESTAMP '2024-01-15 06:30:00'", "events"),
    _named_sql("Integridad Referencial_documents_labels_doc_id", "doc_id IN (SELECT doc_id FROM labels)", "documents"),
    _named_sql("Exactitud_Sintactica_documents_lang", "lang IN ('en', 'de')", "documents"),
    _named_sql("Integridad Referencial_supplier_customer_s_nationkey", "s_nationkey IN (SELECT c_nationkey FROM customer)", "supplier"),
    _named_sql("Credibilidad_Patron_part_p_brand", "regexp_matches(p_brand, '[13579]$')", "part"),
    _named_sql("Precision_part_p_retailprice", r"regexp_matches(CAST(p_retailprice AS VARCHAR), '^\d+\.\d{1,}$')", "part"),
    _named_sql("Completitud_customer_segment", "segment IS NOT NULL", CUSTOMERS_SQL),
)


def resolver(spark: SparkSession, d: str) -> q.TableResolver:
    """Tables of the plan, with their NULL-bearing and text columns."""
    derived = {"customer": _customers, "orders": _orders}

    def resolve(_schema: str | None, name: str) -> DataFrame:
        return derived[name](spark, d) if name in derived else table(spark, d, name)

    return resolve


@query(
    "plan_run",
    f"""SELECT indicator AS "Nombre de indicador", value AS "Valor",
  CAST(CAST(trunc(value * 100) AS INTEGER) AS VARCHAR) || '%' AS "Porcentaje",
  '2024-11-05_07:08' AS "Fecha y hora de ejecución" FROM ({PLAN_SQL})""",
)
def plan_run(spark, d):
    measured = q.run_plan(spark, plan_frame(spark, PLAN), resolver(spark, d))
    return q.format_results(measured, PLAN_STAMP)


@query(
    "plan_errors",
    _union_sql(
        f"SELECT *, false AS failed FROM ({_named_sql('Completitud_customer_segment', 'segment IS NOT NULL', CUSTOMERS_SQL)})",
        "SELECT 'Completitud_customer_missing', CAST(NULL AS DOUBLE), true",
        "SELECT 'Completitud_nowhere_c_name', CAST(NULL AS DOUBLE), true",
        "SELECT 'Precision_customer_c_acctbal', CAST(NULL AS DOUBLE), true",
        "SELECT 'Precision_customer_c_name', CAST(NULL AS DOUBLE), true",
        "SELECT 'Completitud_offline_c_name', CAST(NULL AS DOUBLE), true",
        "SELECT 'Otro_customer_c_name', CAST(NULL AS DOUBLE), true",
        "SELECT 'Credibilidad_Patron_customer_c_name', CAST(NULL AS DOUBLE), true",
        "SELECT 'Integridad Referencial_customer_nation_c_nationkey', CAST(NULL AS DOUBLE), true",
        "SELECT 'Completitud_raising_as_number', CAST(NULL AS DOUBLE), true",
        f"SELECT *, false FROM ({_named_sql('Completitud_raising_segment', 'segment IS NOT NULL', CUSTOMERS_SQL)})",
        "SELECT 'Actualidad_customer_c_name', CAST(0 AS DOUBLE), false",
    ),
)
def plan_errors(spark, d):
    tests = [
        _test(q.COMPLETENESS, "segment", "customer"),
        _test(q.COMPLETENESS, "missing", "customer"),
        _test(q.COMPLETENESS, "c_name", "nowhere"),
        _test(q.PRECISION, "c_acctbal", "customer", num_decimales="two"),
        _test(q.PRECISION, "c_name", "customer", num_decimales="99999999999"),
        _test(q.COMPLETENESS, "c_name", "offline"),
        _test("Otro", "c_name", "customer"),
        _test(q.CREDIBILITY, "c_name", "customer", patron="^[a-z", tipo_credibilidad=q.BY_PATTERN),
        _test(q.INTEGRITY, "c_nationkey", "customer", columna_2="no_key", tabla_2="nation"),
        _test(q.COMPLETENESS, "as_number", "raising"),
        _test(q.COMPLETENESS, "segment", "raising"),
        _test(q.CURRENCY, "c_name", "customer", tiempo_limite="2020-01-01", tipo_actualidad=q.BY_DATE),
    ]
    known = resolver(spark, d)

    def resolve(schema: str | None, name: str) -> DataFrame:
        if name == "offline":
            raise RuntimeError("no connection")
        # A column of names cast to numbers raises when it is read.
        return _customers(spark, d).withColumn("as_number", F.expr("cast(c_name as int)")) if name == "raising" else known(schema, name)

    measured = q.run_plan(spark, plan_frame(spark, tests), resolve, isolate=True)
    return measured.select("indicator", "value", F.col("message").isNotNull().alias("failed"))


def _derived_plan(parts: DataFrame) -> DataFrame:
    """One test per part, of a type chosen by its size, some of them broken."""
    kinds = F.array(*[F.lit(k) for k in (*q.TYPES, "Otro")])
    kind = F.element_at(kinds, (F.col("p_size") % 7 + 1).cast("int"))
    broken = F.col("p_partkey") % 3 == 0
    cols = {
        "tipo": kind,
        "columna": F.col("p_brand"),
        "tabla": F.col("p_type"),
        "schema": F.lit("shop"),
        "patron": F.when(broken, F.lit("  ")).otherwise(F.col("p_name")),
        "tipo_exactitud": F.lit(q.SEMANTIC),
        "tipo_credibilidad": F.when(F.col("p_partkey") % 5 == 0, F.lit("?")).otherwise(F.lit(q.BY_PATTERN)),
        "num_decimales": F.when(broken, F.lit("1.5")).otherwise(F.lit("2")),
        "columna_2": F.when(~broken, F.lit("id")),
        "tabla_2": F.lit("other"),
        "tiempo_limite": F.when(broken, F.lit("soon")).otherwise(F.lit("01/02/2024")),
        "tipo_actualidad": F.lit(q.BY_DATE),
    }
    return parts.select(*[cols[f].alias(f) for f in PLAN_FIELDS])


@query(
    "plan_validate",
    """SELECT indicator, error, count(*) AS n FROM (
SELECT CASE k WHEN 1 THEN concat_ws('_', 'Credibilidad', sub, p_type, p_brand) WHEN 2 THEN concat_ws('_', 'Exactitud', 'Semantica', p_type, p_brand)
    WHEN 3 THEN concat_ws('_', 'Precision', p_type, p_brand) WHEN 4 THEN concat_ws('_', 'Integridad Referencial', p_type, 'other', p_brand)
    WHEN 5 THEN concat_ws('_', 'Actualidad', p_type, p_brand) WHEN 6 THEN concat_ws('_', 'Otro', p_type, p_brand) END AS indicator,
  CASE WHEN k = 6 THEN 'unknown test type'
    WHEN k IN (1, 2) AND broken THEN 'pattern is required'
    WHEN k = 1 AND sub = '?' THEN 'unknown subtype'
    WHEN k = 3 AND broken THEN 'number of decimals must be an integer'
    WHEN k = 4 AND broken THEN 'second table and column are required'
    WHEN k = 5 AND broken THEN 'limit is not a date' END AS error
FROM (SELECT *, p_size % 7 AS k, p_partkey % 3 = 0 AS broken, CASE WHEN p_partkey % 5 = 0 THEN '?' ELSE 'Patron' END AS sub FROM part)
) WHERE error IS NOT NULL GROUP BY 1, 2""",
)
def plan_validate(spark, d):
    errors = q.validate_plan(_derived_plan(table(spark, d, "part")))
    return errors.groupBy("indicator", "error").agg(F.count(F.lit(1)).alias("n"))


@query(
    "plan_roundtrip",
    """SELECT DISTINCT 'Completitud' AS tipo, p_brand AS columna, p_type AS tabla, 'shop' AS "schema", CAST(NULL AS VARCHAR) AS patron,
  'say "' || p_type || '"' AS tipo_exactitud FROM part""",
)
def plan_roundtrip(spark, d):
    """Save and load a plan with one test per brand and type, a bounded domain."""
    tests = (
        table(spark, d, "part")
        .select("p_brand", "p_type")
        .distinct()
        .select(
            F.lit(q.COMPLETENESS).alias("tipo"),
            F.col("p_brand").alias("columna"),
            F.col("p_type").alias("tabla"),
            F.lit("shop").alias("schema"),
            F.concat(F.lit('say "'), "p_type", F.lit('"')).alias("tipo_exactitud"),
        )
    )
    path = scratch_path(spark, "plan")
    save_plan(tests, path)
    return load_plan(spark, path).select("tipo", "columna", "tabla", "schema", "patron", "tipo_exactitud")


@query(
    "report",
    f"""SELECT source, entity, instance, name, value,
  CASE WHEN name <> 'Minimum' THEN CAST(CAST(trunc(value * 100) AS INTEGER) AS VARCHAR) || '%' END AS percent FROM (
SELECT 'analysis' AS source, 'Column' AS entity, * FROM ({_ratio_sql('status', 'Completeness', 'status IS NOT NULL', ORDERS_SQL)})
UNION ALL SELECT 'analysis', 'Column', 'o_totalprice', 'Minimum', min(o_totalprice) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'analysis', 'Column', 'o_orderkey', 'Uniqueness', CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n)
  FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1)
UNION ALL SELECT 'check', 'Column', instance, name, value FROM ({CHECKS_SQL}))""",
)
def report(spark, d):
    orders = _orders(spark, d)
    metrics = [m.completeness("status"), m.minimum("o_totalprice", "o_orderstatus = 'F'"), m.uniqueness("o_orderkey")]
    return q.report(m.run_metrics(orders, metrics), ck.run_checks(orders, _checks()))


@query(
    "scalar_labels",
    """SELECT DISTINCT 'Completitud_' || c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR) AS indicator,
  CAST(CAST(trunc(c_nationkey / 29 * 100) AS INTEGER) AS VARCHAR) || '%' AS percent FROM customer""",
)
def scalar_labels(spark, d):
    customers = table(spark, d, "customer")
    name = indicator("Completitud", F.col("c_mktsegment"), F.col("c_nationkey").cast("string"))
    return customers.select(name.alias("indicator"), pct(F.col("c_nationkey") / 29).alias("percent")).distinct()


# --------------------------------------------------------------- history

RUNS = (
    ("2025-01-31 08:00:00", "1996-01-01"),
    ("2025-02-28 08:00:00", "1998-01-01"),
    ("2025-03-31 08:05:00", "2000-01-01"),
)
RUNS_SQL = _union_sql(
    *[
        f"SELECT strftime(TIMESTAMP '{ts}', '%Y-%m-%d_%H:%M') AS evaluation, 'Actualidad_orders_o_orderdate' AS indicator, "
        f"CAST(trunc(CAST(count(*) FILTER (WHERE o_orderdate >= DATE '{limit}') AS DOUBLE) / count(*) * 100) AS BIGINT) AS percent FROM orders"
        for ts, limit in RUNS
    ],
    *[
        f"SELECT strftime(TIMESTAMP '{ts}', '%Y-%m-%d_%H:%M'), 'Completitud_orders_status', "
        f"CAST(trunc(CAST(count(status) AS DOUBLE) / count(*) * 100) AS BIGINT) FROM {ORDERS_SQL}"
        for ts, _ in RUNS
    ],
)


def _history(spark: SparkSession, d: str) -> DataFrame:
    """Three runs of a plan whose currency limit moves on, saved and loaded."""
    path = scratch_path(spark, "history")
    for ts, limit in RUNS:
        tests = [
            _test(q.CURRENCY, "o_orderdate", "orders", tiempo_limite=limit, tipo_actualidad=q.BY_DATE),
            _test(q.COMPLETENESS, "status", "orders"),
        ]
        results = q.format_results(q.run_plan(spark, plan_frame(spark, tests), resolver(spark, d)), ts)
        save_results(results, path, ts)
    return load_history(spark, path)


@query(
    "history_evolution",
    f"""SELECT indicator, evaluation, percent, percent - lag(percent) OVER (PARTITION BY indicator ORDER BY evaluation) AS change
FROM ({RUNS_SQL})""",
)
def history_evolution(spark, d):
    return portable(evolution(_history(spark, d)))


@query(
    "history_table",
    f"""SELECT indicator, max(percent) FILTER (WHERE evaluation = '2025-01-31_08:00') AS "2025-01-31_08:00",
  max(percent) FILTER (WHERE evaluation = '2025-02-28_08:00') AS "2025-02-28_08:00",
  max(percent) FILTER (WHERE evaluation = '2025-03-31_08:05') AS "2025-03-31_08:05" FROM ({RUNS_SQL}) GROUP BY 1""",
)
def history_table(spark, d):
    return portable(evolution_table(_history(spark, d)))


@query(
    "history_files",
    f"SELECT indicator, evaluation, percent FROM ({RUNS_SQL}) UNION ALL SELECT indicator, evaluation, percent FROM ({RUNS_SQL})",
)
def history_files(spark, d):
    """Result files that hold one JSON array each, beside the saved history: the same runs twice."""
    saved = _history(spark, d)
    path = scratch_path(spark, "result-files")
    paths = []
    for ts, _ in RUNS:
        stamp = f"{ts[:10]}_{ts[11:16]}"
        rows = saved.filter(F.col(STAMP) == stamp).select(*RESULT_FIELDS)
        # A result file is a few rows and one array.
        rows.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).coalesce(1).write.text(f"{path}/{stamp}")
        paths.append(f"{path}/{stamp}")
    both = union_history([saved, load_history(spark, paths, legacy=True)])
    return portable(both.select(F.col(INDICATOR).alias("indicator"), F.col(STAMP).alias("evaluation"), percent_number().alias("percent")))


TYPED_SQL = """(SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 'unreadable' ELSE CAST(o_custkey AS VARCHAR) END AS key_text,
  CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS INTEGER) AS VARCHAR) END AS price_text,
  CASE WHEN o_orderkey % 5 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text FROM orders)"""


def typed_texts(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose key, price and day are texts, some of them unreadable."""
    at = F.col("o_orderkey")
    return (
        table(spark, d, "orders")
        .withColumn("key_text", F.when(at % 11 == 0, F.lit("unreadable")).otherwise(F.col("o_custkey").cast("string")))
        .withColumn("price_text", F.when(at % 7 == 0, F.lit("n/a")).otherwise(F.rint("o_totalprice").cast("int").cast("string")))
        .withColumn("date_text", F.when(at % 5 == 0, F.lit("soon")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    )


@query(
    "integrity_mixed_types",
    f"""SELECT 'text to number' AS direction, CAST(count(*) FILTER (WHERE try_cast(key_text AS BIGINT) IN (SELECT c_custkey FROM customer)) AS DOUBLE)
  / count(*) AS value FROM {TYPED_SQL}
UNION ALL SELECT 'number to text', CAST(count(*) FILTER (WHERE CAST(c_custkey AS VARCHAR) IN (SELECT key_text FROM {TYPED_SQL})) AS DOUBLE) / count(*) FROM customer
UNION ALL SELECT 'orphans', count(*) FILTER (WHERE coalesce(try_cast(key_text AS BIGINT) NOT IN (SELECT c_custkey FROM customer), true)) FROM {TYPED_SQL}""",
)
def integrity_mixed_types(spark, d):
    orders, customers = typed_texts(spark, d), table(spark, d, "customer")
    to_number = m.run_metrics(orders, [m.referential_integrity(customers, "key_text", "c_custkey")])
    to_text = m.run_metrics(customers, [m.referential_integrity(orders, "c_custkey", "key_text")])
    lost = orphans(orders, customers, "key_text", "c_custkey").agg(F.count(F.lit(1)).cast("double").alias("value"))
    named = lambda name, df: df.select(F.lit(name).alias("direction"), "value")
    return union_frames([named("text to number", to_number), named("number to text", to_text), named("orphans", lost)])


@query(
    "pattern_with_blanks",
    "SELECT 'text' AS instance, 'PatternMatch' AS name, CAST(count(*) FILTER (WHERE regexp_matches(text, ' of ')) AS DOUBLE) / count(*) AS value FROM documents",
)
def pattern_with_blanks(spark, d):
    """A pattern whose blanks at both ends count."""
    return _measured(m.run_metrics(table(spark, d, "documents"), [m.pattern_match("text", " of ")]))
