"""Expectations, data tests and constraints over the given tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from ..operators import checks as ck
from ..operators import constraints as c
from ..operators import data_tests as dt
from ..operators import expectations as e
from ..operators import metrics as m
from ..operators.joins import join_dimension, orphan_keys, rows_in
from ..operators.windows import union_frames
from .data import portable, query, table
from .quality import CUSTOMERS_SQL, ORDERS_SQL, TYPED_SQL, _customers, _orders, typed_texts


@query(
    "expect_not_null",
    f"SELECT c_custkey, 'not_null(segment)' AS rule, segment AS value FROM {CUSTOMERS_SQL} WHERE segment IS NULL",
)
def expect_not_null(spark, d):
    return e.violations(_customers(spark, d), [e.expect_not_null("segment")], ["c_custkey"])


@query(
    "expect_regex",
    "SELECT p_partkey, 'match_regex(p_brand)' AS rule, p_brand AS value FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[1-9]$')",
)
def expect_regex(spark, d):
    return e.violations(table(spark, d, "part"), [e.expect_match_regex("p_brand", "^Brand#[1-9]$")], ["p_partkey"])


@query(
    "expect_between",
    """SELECT c_custkey, 'between(c_acctbal)' AS rule, CAST(c_acctbal AS VARCHAR) AS value FROM customer WHERE c_acctbal < 500
UNION ALL SELECT c_custkey, 'between(c_nationkey)', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey NOT BETWEEN 2 AND 20""",
)
def expect_between(spark, d):
    rules = [e.expect_between("c_acctbal", low=500), e.expect_between("c_nationkey", 2, 20)]
    return e.violations(table(spark, d, "customer"), rules, ["c_custkey"])


@query(
    "expect_in_set",
    f"SELECT o_orderkey, 'in_set(status)' AS rule, status AS value FROM {ORDERS_SQL} WHERE status NOT IN ('O')",
)
def expect_in_set(spark, d):
    return e.violations(_orders(spark, d), [e.expect_in_set("status", "O")], ["o_orderkey"])


@query(
    "expect_unique",
    """SELECT doc_id, 'unique(text)' AS rule, text AS value FROM documents
WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
)
def expect_unique(spark, d):
    return e.violations(table(spark, d, "documents"), [e.expect_unique("text")], ["doc_id"], digest=True)


CUSTOMER_RULES = [
    ("segment", "not_null", "segment IS NULL"),
    ("c_name", "match_regex", "NOT regexp_matches(c_name, '[02468]$')"),
    ("c_acctbal", "between", "c_acctbal < 0 OR c_acctbal > 9000"),
    ("segment", "in_set", "segment NOT IN ('MACHINERY', 'FURNITURE')"),
]


def _suite() -> list[e.Expectation]:
    return [
        e.expect_not_null("segment", mostly=0.75),
        e.expect_match_regex("c_name", "[02468]$", mostly=0.5),
        e.expect_between("c_acctbal", 0, 9000, mostly=0.6),
        e.expect_in_set("segment", ["MACHINERY", "FURNITURE"]),
        e.expect_unique("c_nationkey"),
        e.expect_unique("c_name"),
    ]


def _summary_sql(col: str, rule: str, bad: str, base: str, mostly: float) -> str:
    """Counts of one rule; ``base`` is the number of rows it judges."""
    return f"""SELECT '{rule}({col})' AS rule, '{col}' AS "column", total AS element_count, missing AS missing_count,
  unexpected AS unexpected_count, unexpected * CAST(100 AS DOUBLE) / {base} AS unexpected_percent,
  unexpected * CAST(100 AS DOUBLE) / total AS unexpected_percent_total,
  CAST({base} - unexpected AS DOUBLE) / {base} >= CAST({mostly} AS DOUBLE) AS success
FROM (SELECT count(*) AS total, count(*) - count({col}) AS missing, count(*) FILTER (WHERE {bad}) AS unexpected FROM source)"""


SUMMARY_SQL = f"""WITH source AS {CUSTOMERS_SQL}
{_summary_sql('segment', 'not_null', 'segment IS NULL', 'total', 0.75)}
UNION ALL {_summary_sql('c_name', 'match_regex', "NOT regexp_matches(c_name, '[02468]$')", '(total - missing)', 0.5)}
UNION ALL {_summary_sql('c_acctbal', 'between', 'c_acctbal < 0 OR c_acctbal > 9000', '(total - missing)', 0.6)}
UNION ALL {_summary_sql('segment', 'in_set', "segment NOT IN ('MACHINERY', 'FURNITURE')", '(total - missing)', 1.0)}
UNION ALL {_summary_sql('c_nationkey', 'unique', 'c_nationkey IN (SELECT c_nationkey FROM source GROUP BY 1 HAVING count(*) > 1)', '(total - missing)', 1.0)}
UNION ALL {_summary_sql('c_name', 'unique', 'c_name IN (SELECT c_name FROM source GROUP BY 1 HAVING count(*) > 1)', '(total - missing)', 1.0)}"""


@query("expectation_summary", SUMMARY_SQL)
def expectation_summary(spark, d):
    return e.summarize(_customers(spark, d), _suite()).drop("message")


@query(
    "suite",
    f"SELECT *, 'customers' AS suite, bool_and(success) OVER () AS suite_success FROM ({SUMMARY_SQL})",
)
def suite(spark, d):
    return e.run_suite(_customers(spark, d), "customers", _suite()).drop("message")


@query(
    "violation_counts",
    f"""SELECT rule, value, count(*) AS n FROM (
SELECT 'not_null(segment)' AS rule, segment AS value FROM {CUSTOMERS_SQL} WHERE segment IS NULL
UNION ALL SELECT 'match_regex(c_name)', c_name FROM customer WHERE NOT regexp_matches(c_name, '[02468]$')
UNION ALL SELECT 'between(c_acctbal)', CAST(c_acctbal AS VARCHAR) FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000
UNION ALL SELECT 'in_set(segment)', segment FROM {CUSTOMERS_SQL} WHERE segment NOT IN ('MACHINERY', 'FURNITURE')
UNION ALL SELECT 'unique(c_nationkey)', CAST(c_nationkey AS VARCHAR) FROM customer
  WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)
) GROUP BY 1, 2""",
)
def violation_counts(spark, d):
    return e.violation_counts(e.violations(_customers(spark, d), _suite(), ["c_custkey"]))


@query("test_not_null", f"SELECT c_custkey, c_name, segment FROM {CUSTOMERS_SQL} WHERE segment IS NULL")
def test_not_null(spark, d):
    return dt.not_null(_customers(spark, d).select("c_custkey", "c_name", "segment"), "segment")


@query(
    "test_unique",
    """SELECT 'l_orderkey' AS tested, CAST(l_orderkey AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'text', text, n FROM (SELECT sha256(text) AS text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1)""",
)
def test_unique(spark, d):
    cases = [("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("documents", "text")]
    frames = [
        dt.unique(table(spark, d, t), col, digest=True).select(
            F.lit(col).alias("tested"), F.col(col).cast("string").alias("value"), "n"
        )
        for t, col in cases
    ]
    return union_frames(frames)


@query(
    "test_relationships",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def test_relationships(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return dt.relationships(docs, "doc_id", table(spark, d, "labels"), "doc_id")


@query(
    "orphan_keys",
    """SELECT o_custkey AS key, count(*) AS n FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1""",
)
def orphaned_keys(spark, d):
    parents = table(spark, d, "customer").filter("c_mktsegment <> 'BUILDING'")
    return orphan_keys(table(spark, d, "orders"), parents, "o_custkey", "c_custkey")


@query(
    "rows_in",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def semi_joined_rows(spark, d):
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows_in(items, urgent, ["l_orderkey"])


@query(
    "duplicates_hot_values",
    """SELECT event_id, user_id FROM events
WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)""",
)
def duplicates_hot_values(spark, d):
    """Repeated values joined back; they hold nearly all rows."""
    events = table(spark, d, "events").select("event_id", "user_id")
    return e.duplicated_rows(events, "user_id")


@query(
    "join_hot_keys",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, p_name, p_size > 25 AS is_big
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'LARGE') ON l_partkey = p_partkey""",
)
def join_hot_keys(spark, d):
    """A dimension joined with hot keys salted."""
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = (
        table(spark, d, "part")
        .filter("p_type <> 'LARGE'")
        .select(F.col("p_partkey").alias("l_partkey"), "p_name", (F.col("p_size") > 25).alias("is_big"))
    )
    joined = join_dimension(items, parts, ["l_partkey"], "left", ["l_orderkey"], min_rows=30)
    return portable(joined)


@query(
    "test_accepted_values",
    f"SELECT status, count(*) AS n FROM {ORDERS_SQL} WHERE status NOT IN ('O') GROUP BY 1",
)
def test_accepted_values(spark, d):
    return dt.accepted_values(_orders(spark, d), "status", ["O"])


@query(
    "test_expression",
    f"SELECT o_orderkey, status, o_totalprice FROM {ORDERS_SQL} WHERE NOT (o_totalprice < 400000 AND status <> 'O')",
)
def test_expression(spark, d):
    orders = _orders(spark, d).select("o_orderkey", "status", "o_totalprice")
    return dt.expression_is_true(orders, "o_totalprice < 400000 AND status <> 'O'")


@query(
    "freshness",
    """SELECT 'events' AS source, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_loaded_at,
  CAST(floor((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max(ts))) / 1000000) AS BIGINT) AS age_seconds,
  CASE WHEN TIMESTAMP '2024-01-31 12:00:00' - max(ts) <= INTERVAL 24 HOUR THEN 'pass' ELSE 'warn' END AS status FROM events
UNION ALL SELECT 'orders', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'),
  CAST(floor((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max(o_orderdate))) / 1000000) AS BIGINT),
  CASE WHEN TIMESTAMP '2024-01-31 12:00:00' - max(o_orderdate) <= INTERVAL 24 HOUR THEN 'pass' ELSE 'warn' END FROM orders""",
)
def freshness(spark, d):
    frames = [
        dt.freshness(table(spark, d, t), col, "2024-01-31 12:00:00", timedelta(hours=24)).withColumn("source", F.lit(t))
        for t, col in (("events", "ts"), ("orders", "o_orderdate"))
    ]
    return portable(union_frames(frames))


@query(
    "constraints",
    f"""WITH o AS {ORDERS_SQL}, c AS {CUSTOMERS_SQL}
SELECT 'orders' AS table_name, 'not_null(status)' AS "constraint", count(*) FILTER (WHERE status IS NULL) AS violations FROM o
UNION ALL SELECT 'orders', 'check(total)', count(*) FILTER (WHERE NOT (o_totalprice >= 1000)) FROM o
UNION ALL SELECT 'orders', 'check_in(status)', count(*) FILTER (WHERE status NOT IN ('O', 'X')) FROM o
UNION ALL SELECT 'orders', 'check_age(o_orderdate)', count(*) FILTER (WHERE NOT (CAST(o_orderdate AS DATE) <= DATE '2017-06-30' - INTERVAL 18 YEAR)) FROM o
UNION ALL SELECT 'orders', 'fits_decimal(o_totalprice,7,2)', count(*) FILTER (WHERE try_cast(o_totalprice AS DECIMAL(7, 2)) IS NULL) FROM o
UNION ALL SELECT 'orders', 'pk(o_orderkey)', (SELECT count(*) FROM (SELECT o_orderkey FROM o GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'fk(o_custkey)', count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM c WHERE segment IS NOT NULL)) FROM o
UNION ALL SELECT 'customer', 'max_length(segment,8)', count(*) FILTER (WHERE length(segment) > 8) FROM c
UNION ALL SELECT 'customer', 'unique(segment)', (SELECT count(*) FROM (SELECT segment FROM c WHERE segment IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'customer', 'pk(segment,c_nationkey)', (SELECT CAST(sum(CASE WHEN segment IS NULL THEN n WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT)
  FROM (SELECT segment, c_nationkey, count(*) AS n FROM c GROUP BY 1, 2))""",
)
def constraints(spark, d):
    customers = _customers(spark, d)
    orders = c.validate_constraints(
        _orders(spark, d),
        "orders",
        [
            c.not_null("status"),
            c.check("o_totalprice >= 1000", "total"),
            c.check_in("status", ["O", "X"]),
            c.check_age("o_orderdate", 18, "2017-06-30"),
            c.fits_decimal("o_totalprice", 7, 2),
            c.pk("o_orderkey"),
            c.fk("o_custkey", customers.filter("segment IS NOT NULL"), "c_custkey"),
        ],
    )
    people = c.validate_constraints(
        customers, "customer", [c.max_length("segment", 8), c.unique("segment"), c.pk(["segment", "c_nationkey"])]
    )
    return union_frames([orders, people]).drop("message")


@query(
    "between_text",
    f"""SELECT 'between(price_text)' AS rule, count(*) AS element_count, count(*) FILTER (WHERE NOT coalesce(try_cast(price_text AS DOUBLE) BETWEEN 1000 AND 200000, false)) AS unexpected_count FROM {TYPED_SQL}
UNION ALL SELECT 'in_set(price_text)', count(*), count(*) FILTER (WHERE NOT coalesce(try_cast(price_text AS DOUBLE) IN (1000, 150000), false)) FROM {TYPED_SQL}
UNION ALL SELECT 'between(date_text)', count(*), count(*) FILTER (WHERE NOT coalesce(try_cast(date_text AS DATE) >= DATE '1995-06-01', false)) FROM {TYPED_SQL}""",
)
def between_text(spark, d):
    """Bounds and sets of numbers and days on text columns with unreadable cells."""
    rules = [
        e.expect_between("price_text", 1000, 200_000),
        e.expect_in_set("price_text", [1000, 150_000]),
        e.expect_between("date_text", low=date(1995, 6, 1)),
    ]
    return e.summarize(typed_texts(spark, d), rules).select("rule", "element_count", "unexpected_count")


@query(
    "constraints_text",
    f"""SELECT 'orders' AS table_name, 'check_age(date_text)' AS "constraint", count(*) FILTER (WHERE NOT coalesce(try_cast(date_text AS DATE) <= DATE '2014-06-30' - INTERVAL 18 YEAR, false)) AS violations,
  false AS failed FROM {TYPED_SQL}
UNION ALL SELECT 'orders', 'fk(key_text)', count(*) FILTER (WHERE coalesce(try_cast(key_text AS BIGINT) NOT IN (SELECT c_custkey FROM customer), true)), false FROM {TYPED_SQL}
UNION ALL SELECT 'orders', 'not_null(gone)', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'orders', 'pk(gone)', CAST(NULL AS BIGINT), true""",
)
def constraints_text(spark, d):
    """Constraints on texts with unreadable cells, and two on a column that does not exist."""
    declared = [
        c.check_age("date_text", 18, "2014-06-30"), c.fk("key_text", table(spark, d, "customer"), "c_custkey"),
        c.not_null("gone"), c.pk("gone"),
    ]
    found = c.validate_constraints(typed_texts(spark, d), "orders", declared)
    return found.select("table_name", "constraint", "violations", F.col("message").isNotNull().alias("failed"))


@query(
    "suite_errors",
    f"""SELECT 'not_null(segment)' AS rule, count(*) FILTER (WHERE segment IS NULL) AS unexpected_count, false AS failed FROM {CUSTOMERS_SQL}
UNION ALL SELECT 'not_null(gone)', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'match_regex(c_name)', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'between(c_custkey)', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'unique(gone)', CAST(NULL AS BIGINT), true""",
)
def suite_errors(spark, d):
    """A suite with two rules on a column that does not exist, a broken pattern and bounds that are no numbers."""
    rules = [
        e.expect_not_null("gone"), e.expect_not_null("segment"), e.expect_unique("gone"), e.expect_match_regex("c_name", "("),
        e.expect_between("c_custkey", "a", "z"),
    ]
    found = e.run_suite(_customers(spark, d), "customers", rules)
    return found.select("rule", "unexpected_count", F.col("message").isNotNull().alias("failed"))


#: Customers with a code that is a number for three of four.
CODED_SQL = """(SELECT *, CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE CAST(c_custkey % 50 AS VARCHAR) END AS code,
  nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)"""


def _coded(spark, d):
    """Customers with a code that is a number for three of four; reading the others as numbers raises."""
    code = F.when(F.col("c_custkey") % 4 == 0, F.col("c_name")).otherwise((F.col("c_custkey") % 50).cast("string"))
    return _customers(spark, d).withColumn("code", code)


@query(
    "suite_isolated",
    f"""SELECT 'not_null(segment)' AS rule, count(*) FILTER (WHERE segment IS NULL) AS unexpected_count, false AS failed FROM {CODED_SQL}
UNION ALL SELECT 'small(code)', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'between(c_acctbal)', count(*) FILTER (WHERE c_acctbal < 0), false FROM {CODED_SQL}
UNION ALL SELECT 'unique(c_name)', count(*) - count(DISTINCT c_name), false FROM {CODED_SQL}""",
)
def suite_isolated(spark, d):
    """A rule that raises on a cell does not end the others."""
    rules = [
        e.expect_not_null("segment"), e.expect_true("cast(code AS int) < 40", "code", "small"),
        e.expect_between("c_acctbal", low=0), e.expect_unique("c_name"),
    ]
    found = e.run_suite(_coded(spark, d), "customers", rules, isolate=True)
    return found.select("rule", "unexpected_count", F.col("message").isNotNull().alias("failed"))


@query(
    "suite_guarded",
    f"""SELECT 'small(code)' AS rule, count(*) AS element_count, CAST(0 AS BIGINT) AS missing_count,
  count(*) FILTER (WHERE try_cast(code AS INT) >= 40) AS unexpected_count, count(*) FILTER (WHERE try_cast(code AS INT) IS NULL) AS unjudged_count,
  coalesce(100.0 * count(*) FILTER (WHERE try_cast(code AS INT) >= 40) / nullif(count(try_cast(code AS INT)), 0), 0) AS unexpected_percent FROM {CODED_SQL}
UNION ALL SELECT 'not_null(segment)', count(*), count(*) FILTER (WHERE segment IS NULL), count(*) FILTER (WHERE segment IS NULL), 0,
  100.0 * count(*) FILTER (WHERE segment IS NULL) / count(*) FROM {CODED_SQL}
UNION ALL SELECT 'in_set(segment)', count(*), count(*) FILTER (WHERE segment IS NULL), count(*) FILTER (WHERE segment NOT IN ('MACHINERY')), 0,
  100.0 * count(*) FILTER (WHERE segment NOT IN ('MACHINERY')) / count(segment) FROM {CODED_SQL}""",
)
def suite_guarded(spark, d):
    """All rules in one scan; cells that a rule cannot read are counted apart."""
    rules = [
        e.expect_true("cast(code AS int) < 40", "code", "small"), e.expect_not_null("segment"), e.expect_in_set("segment", "MACHINERY"),
    ]
    counts = ["element_count", "missing_count", "unexpected_count", "unjudged_count", "unexpected_percent"]
    return e.summarize_guarded(_coded(spark, d), rules).select("rule", *counts)


@query("unjudged_cells", f"SELECT c_custkey, 'small(code)' AS rule, code AS value FROM {CODED_SQL} WHERE try_cast(code AS INT) IS NULL")
def unjudged_cells(spark, d):
    return e.unjudged_rows(_coded(spark, d), [e.expect_true("cast(code AS int) < 40", "code", "small")], ["c_custkey"])


@query(
    "constraints_isolated",
    f"""SELECT 'customer' AS table_name, 'check(code)' AS constraint, CAST(NULL AS BIGINT) AS violations, true AS failed
UNION ALL SELECT 'customer', 'not_null(segment)', count(*) FILTER (WHERE segment IS NULL), false FROM {CODED_SQL}
UNION ALL SELECT 'customer', 'pk(c_custkey)', 0, false
UNION ALL SELECT 'customer', 'check(balance)', count(*) FILTER (WHERE NOT c_acctbal > 100), false FROM {CODED_SQL}""",
)
def constraints_isolated(spark, d):
    """A CHECK that raises on a cell does not end the others."""
    asked = [c.check("cast(code AS int) < 40", "code"), c.not_null("segment"), c.pk("c_custkey"), c.check("c_acctbal > 100", "balance")]
    found = c.validate_isolated(_coded(spark, d), "customer", asked)
    return found.select("table_name", "constraint", "violations", F.col("message").isNotNull().alias("failed"))


@query(
    "constraints_guarded",
    f"""SELECT 'customer' AS table_name, 'check(code)' AS constraint, count(*) FILTER (WHERE try_cast(code AS INT) >= 40) AS violations,
  count(*) FILTER (WHERE try_cast(code AS INT) IS NULL) AS unjudged FROM {CODED_SQL}
UNION ALL SELECT 'customer', 'check_in(segment)', count(*) FILTER (WHERE segment NOT IN ('MACHINERY', 'FURNITURE')),
  count(*) FILTER (WHERE segment IS NULL) FROM {CODED_SQL}""",
)
def constraints_guarded(spark, d):
    asked = [c.check("cast(code AS int) < 40", "code"), c.check_in("segment", "MACHINERY,FURNITURE")]
    return c.validate_guarded(_coded(spark, d), "customer", asked)


@query(
    "checks_isolated",
    f"""SELECT 'balance' AS check, 'Success' AS status, CAST(count(*) FILTER (WHERE c_acctbal >= -1000) AS DOUBLE) / count(*) AS value, false AS failed FROM {CODED_SQL}
UNION ALL SELECT 'code', 'Error', CAST(NULL AS DOUBLE), true
UNION ALL SELECT 'segment', 'Warning', CAST(count(segment) AS DOUBLE) / count(*), false FROM {CODED_SQL}""",
)
def checks_isolated(spark, d):
    """A check whose metric raises on a cell does not end the others."""
    asked = [
        ck.Check(ck.ERROR, "balance", m.compliance("balance", "c_acctbal >= -1000")),
        ck.Check(ck.ERROR, "code", m.compliance("code", "cast(code AS int) < 40")),
        ck.Check(ck.WARNING, "segment", m.completeness("segment")),
    ]
    found = ck.run_checks(_coded(spark, d), asked, isolate=True)
    return found.select("check", "status", "value", F.col("message").isNotNull().alias("failed"))
