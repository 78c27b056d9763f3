"""Staging models, marts and metrics over the given tables.

The shop's raw inputs are projections of the given tables: customers, orders,
order items (lineitem), products (part), stores (supplier) and supplies (three
per product, with a cost that follows from its size).
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as a
from ..operators.joins import combine_metrics, offset_join, on_spine
from ..operators.spine import date_spine
from ..operators.windows import cumulative, growth_pct, ordinal, running_sum
from ..plans import marts, staging
from ..plans.semantic import SAVED_QUERIES, Cumulative, Key, MetricCatalog, TimeDimension, shop_metrics
from ..sources.scratch import scratch_path
from ..sources.tables import TABLE, VIEW, materialize
from .data import portable, query, table

FOOD, DRINK = "ECONOMY", "PROMO"


class Shop:
    """Raw, staged and mart frames of one data folder, built on demand."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    def _table(self, name: str) -> DataFrame:
        return table(self.spark, self.d, name)

    @cached_property
    def customers_stg(self) -> DataFrame:
        return staging.stg_customers(
            self._table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
        )

    @cached_property
    def orders_stg(self) -> DataFrame:
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        raw = (
            self._table("orders")
            .withColumn("order_total", cents)
            .withColumn("tax_paid", F.expr("order_total * 8 div 108"))
            .select(
                F.col("o_orderkey").alias("id"),
                (F.col("o_custkey") % 10).alias("store_id"),
                F.col("o_custkey").alias("customer"),
                (F.col("order_total") - F.col("tax_paid")).alias("subtotal"),
                "tax_paid",
                "order_total",
                F.col("o_orderdate").alias("ordered_at"),
            )
        )
        return staging.stg_orders(raw)

    @cached_property
    def items_stg(self) -> DataFrame:
        parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        raw = self._table("lineitem").select(
            F.concat_ws("-", *parts).alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku")
        )
        return staging.stg_order_items(raw)

    @cached_property
    def products_stg(self) -> DataFrame:
        raw = self._table("part").select(
            F.col("p_partkey").alias("sku"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("type"),
            F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"),
            F.col("p_brand").alias("description"),
        )
        return staging.stg_products(raw, FOOD, DRINK)

    @cached_property
    def locations_stg(self) -> DataFrame:
        raw = self._table("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            (F.col("s_nationkey") / 100).alias("tax_rate"),
            F.expr("timestamp_ntz'1998-03-15 06:30:00' + make_dt_interval(0, cast(s_suppkey * 5 as int))").alias("opened_at"),
        )
        return staging.stg_locations(raw)

    @cached_property
    def supplies_stg(self) -> DataFrame:
        raw = (
            self._table("part")
            .select("p_partkey", "p_size", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)])).alias("k"))
            .select(
                F.concat(F.lit("SUP-"), F.col("k").cast("string")).alias("id"),
                F.concat(F.lit("supply "), F.col("k").cast("string")).alias("name"),
                (F.col("p_size") * F.col("k")).alias("cost"),
                (F.col("k") == 2).alias("perishable"),
                F.col("p_partkey").alias("sku"),
            )
        )
        return staging.stg_supplies(raw)

    @cached_property
    def order_items(self) -> DataFrame:
        return marts.order_items(self.items_stg, self.orders_stg, self.products_stg, self.supplies_stg)

    @cached_property
    def orders(self) -> DataFrame:
        return marts.orders(self.orders_stg, self.order_items)

    @cached_property
    def customers(self) -> DataFrame:
        return marts.customers(self.customers_stg, self.orders)

    @cached_property
    def catalog(self) -> MetricCatalog:
        # As functions, so that a query builds only the marts it reads.
        return shop_metrics(
            lambda: self.order_items,
            lambda: self.orders,
            lambda: self.customers,
            lambda: marts.locations(self.locations_stg),
            lambda: marts.order_facts(
                self.orders_stg, marts.priced_items(self.items_stg, self.products_stg, self.supplies_stg)
            ),
        )


CENTS = "CAST({} / CAST(100 AS DOUBLE) AS DOUBLE)"
STAGING_SQL = {
    "stg_customers": "SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer",
    "stg_orders": f"""SELECT id AS order_id, store_id AS location_id, customer AS customer_id, order_total - tax_paid AS subtotal_cents,
  tax_paid AS tax_paid_cents, order_total AS order_total_cents, {CENTS.format('(order_total - tax_paid)')} AS subtotal,
  {CENTS.format('tax_paid')} AS tax_paid, {CENTS.format('order_total')} AS order_total, strftime(o_orderdate, '%Y-%m-%d') AS ordered_at
FROM (SELECT *, o_orderkey AS id, o_custkey % 10 AS store_id, o_custkey AS customer, order_total * 8 // 108 AS tax_paid
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS order_total FROM orders))""",
    "stg_order_items": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_item_id, l_orderkey AS order_id,
  l_partkey AS product_id FROM lineitem""",
    "stg_products": f"""SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_type, p_brand AS product_description,
  {CENTS.format('CAST(round(p_retailprice * 100) AS BIGINT)')} AS product_price,
  coalesce(p_type = '{FOOD}', false) AS is_food_item, coalesce(p_type = '{DRINK}', false) AS is_drink_item FROM part""",
    "stg_locations": """SELECT s_suppkey AS location_id, s_name AS location_name, s_nationkey / CAST(100 AS DOUBLE) AS tax_rate,
  strftime(TIMESTAMP '1998-03-15 06:30:00' + to_hours(CAST(s_suppkey * 5 AS INTEGER)), '%Y-%m-%d') AS opened_date FROM supplier""",
    "stg_supplies": f"""SELECT md5('SUP-' || k || '-' || p_partkey) AS supply_uuid, 'SUP-' || k AS supply_id,
  p_partkey AS product_id, 'supply ' || k AS supply_name, {CENTS.format('(p_size * k)')} AS supply_cost,
  k = 2 AS is_perishable_supply FROM (SELECT *, unnest([1, 2, 3]) AS k FROM part)""",
}
STAGES = {
    "stg_customers": "customers_stg",
    "stg_orders": "orders_stg",
    "stg_order_items": "items_stg",
    "stg_products": "products_stg",
    "stg_locations": "locations_stg",
    "stg_supplies": "supplies_stg",
}
for _name, _attr in STAGES.items():
    query(_name, STAGING_SQL[_name])(lambda spark, d, attr=_attr: portable(getattr(Shop(spark, d), attr)))


def _dec(expr: str) -> str:
    """Exact sum of two-decimal amounts."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(18, 2))) AS DOUBLE)"


MARTS_SQL = ",\n".join(f"{n} AS ({s})" for n, s in STAGING_SQL.items()) + f""",
supply_costs AS (SELECT product_id, {_dec('supply_cost')} AS supply_cost FROM stg_supplies GROUP BY 1),
order_items AS (SELECT i.*, o.ordered_at, p.product_name, p.product_price, p.is_food_item, p.is_drink_item, s.supply_cost
  FROM stg_order_items i LEFT JOIN stg_orders o USING (order_id) LEFT JOIN stg_products p USING (product_id)
  LEFT JOIN supply_costs s USING (product_id)),
items_summary AS (SELECT order_id, {_dec('supply_cost')} AS order_cost, {_dec('product_price')} AS order_items_subtotal,
  CAST(sum(CASE WHEN is_food_item THEN 1 ELSE 0 END) AS BIGINT) AS count_food_items,
  CAST(sum(CASE WHEN is_drink_item THEN 1 ELSE 0 END) AS BIGINT) AS count_drink_items,
  count(order_item_id) AS count_order_items FROM order_items GROUP BY 1),
orders_mart AS (SELECT o.*, s.order_cost, s.order_items_subtotal, s.count_food_items, s.count_drink_items, s.count_order_items,
  s.count_food_items > 0 AS is_food_order, s.count_drink_items > 0 AS is_drink_order,
  row_number() OVER (PARTITION BY customer_id ORDER BY ordered_at, order_id) AS customer_order_number
  FROM stg_orders o LEFT JOIN items_summary s USING (order_id)),
customer_summary AS (SELECT customer_id, count(DISTINCT order_id) AS count_lifetime_orders, min(ordered_at) AS first_ordered_at,
  max(ordered_at) AS last_ordered_at, {_dec('subtotal')} AS lifetime_spend_pretax, {_dec('tax_paid')} AS lifetime_tax_paid,
  {_dec('order_total')} AS lifetime_spend FROM orders_mart GROUP BY 1),
customers_mart AS (SELECT c.*, s.count_lifetime_orders, s.first_ordered_at, s.last_ordered_at, s.lifetime_spend_pretax,
  s.lifetime_tax_paid, s.lifetime_spend, CASE WHEN s.count_lifetime_orders > 1 THEN 'returning' ELSE 'new' END AS customer_type
  FROM stg_customers c LEFT JOIN customer_summary s USING (customer_id))"""


def mart_sql(body: str) -> str:
    return f"WITH {MARTS_SQL}\n{body}"


@query("mart_order_items", mart_sql("SELECT * FROM order_items"))
def mart_order_items(spark, d):
    return portable(Shop(spark, d).order_items)


@query("mart_orders", mart_sql("SELECT * FROM orders_mart"))
def mart_orders(spark, d):
    return portable(Shop(spark, d).orders)


@query("mart_customers", mart_sql("SELECT * FROM customers_mart"))
def mart_customers(spark, d):
    return portable(Shop(spark, d).customers)


@query(
    "mart_passthrough",
    mart_sql(
        """SELECT 'products' AS mart, CAST(product_id AS VARCHAR) AS id, product_price AS amount FROM stg_products
UNION ALL SELECT 'locations', CAST(location_id AS VARCHAR), tax_rate FROM stg_locations
UNION ALL SELECT 'supplies', supply_uuid, supply_cost FROM stg_supplies"""
    ),
)
def mart_passthrough(spark, d):
    shop = Shop(spark, d)

    def part(name, df, key, amount):
        return df.select(F.lit(name).alias("mart"), F.col(key).cast("string").alias("id"), F.col(amount).cast("double").alias("amount"))

    return (
        part("products", marts.products(shop.products_stg), "product_id", "product_price")
        .unionByName(part("locations", marts.locations(shop.locations_stg), "location_id", "tax_rate"))
        .unionByName(part("supplies", marts.supplies(shop.supplies_stg), "supply_uuid", "supply_cost"))
    )


@query("materialize", mart_sql("SELECT order_id, customer_id, count_order_items, order_items_subtotal FROM orders_mart"))
def materialized(spark, d):
    """Staged orders and items as views, the orders mart as a bucketed table."""
    shop = Shop(spark, d)
    run = uuid.uuid4().hex
    orders = materialize(shop.orders_stg, f"stg_orders_{run}", VIEW)
    items = materialize(shop.order_items, f"shop_order_items_{run}", TABLE, scratch_path(spark, "order-items"), ["order_id"], 8)
    mart = materialize(marts.orders(orders, items), f"shop_orders_{run}", TABLE, scratch_path(spark, "orders"))
    return portable(mart.select("order_id", "customer_id", "count_order_items", "order_items_subtotal"))


# ------------------------------------------------- aggregates and windows


@query(
    "aggregates_by_customer",
    """SELECT o_custkey, count(DISTINCT o_orderdate) AS order_days, min(o_orderkey) AS first_o_orderkey, max(o_orderkey) AS last_o_orderkey,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS spend, CAST(sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished,
  count(status) AS known FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders) GROUP BY 1""",
)
def aggregates_by_customer(spark, d):
    orders = (
        table(spark, d, "orders")
        .withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
        .withColumn("spend", F.col("o_totalprice").cast("decimal(18,2)"))
    )
    found = orders.groupBy("o_custkey").agg(
        a.count_distinct("o_orderdate").alias("order_days"),
        *a.first_and_last("o_orderkey"),
        F.sum("spend").alias("spend"),
        a.count_flag(F.col("status") == "F").alias("finished"),
        a.count_col("status").alias("known"),
    )
    return portable(found)


@query(
    "median",
    """SELECT o_orderpriority, median(o_totalprice) AS median_price, CAST(NULL AS VARCHAR) AS total FROM orders GROUP BY 1
UNION ALL SELECT NULL, median(o_totalprice), 'all' FROM orders
UNION ALL SELECT NULL, median(l_quantity), 'quantity' FROM lineitem""",
)
def median(spark, d):
    orders = table(spark, d, "orders")
    by_priority = a.exact_median(orders, ["o_orderpriority"], "o_totalprice", "median_price")
    overall = a.exact_median(orders, [], "o_totalprice", "median_price").withColumn("total", F.lit("all"))
    quantity = a.exact_median(table(spark, d, "lineitem"), [], "l_quantity", "median_price")
    total = overall.unionByName(quantity.withColumn("total", F.lit("quantity")))
    return by_priority.unionByName(total, allowMissingColumns=True)


@query(
    "order_ordinal",
    """SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS number FROM orders""",
)
def order_ordinal(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return portable(ordinal(orders, "o_custkey", ["o_orderdate", "o_orderkey"], "number").drop("o_orderdate"))


@query(
    "order_ordinal_split",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_returnflag
  ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS number FROM lineitem""",
)
def order_ordinal_split(spark, d):
    """Three partitions hold all items, so their numbering is cut in ranges."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    items = table(spark, d, "lineitem").select(*keys, "l_returnflag", "l_shipdate")
    numbered = ordinal(items, "l_returnflag", ["l_shipdate", *keys], "number", min_rows=1000)
    return portable(numbered.select(*keys, "number"))


@query(
    "running_total",
    """SELECT event_type, day, value, CAST(sum(cents) OVER (PARTITION BY event_type ORDER BY day) AS BIGINT) AS upto FROM (
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value FROM events GROUP BY 1, 2)""",
)
def running_total(spark, d):
    daily = (
        table(spark, d, "events")
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("value"))
    )
    return portable(running_sum(daily, ["event_type"], ["day"], "value", "upto"))


# ---------------------------------------------------------------- metrics

DAILY = "GROUP BY ordered_at"


# Quotients are compared to six decimals.
QUOTIENTS = ("food_revenue_pct", "drink_revenue_pct", "average_order_value", "revenue_growth_mom")


def _rounded(df: DataFrame) -> DataFrame:
    return portable(df.withColumns({c: F.round(c, 6) for c in QUOTIENTS if c in df.columns}))


def _metric(name: str, metrics: list[str], group_by: list, sql: str) -> None:
    query(name, mart_sql(sql))(
        lambda spark, d: _rounded(Shop(spark, d).catalog.query_metrics(metrics, group_by))
    )


_metric(
    "metric_simple",
    ["revenue", "food_revenue", "drink_revenue"],
    [TimeDimension("day")],
    f"""SELECT ordered_at AS metric_time, {_dec('product_price')} AS revenue,
  {_dec('CASE WHEN is_food_item THEN product_price ELSE 0 END')} AS food_revenue,
  {_dec('CASE WHEN is_drink_item THEN product_price ELSE 0 END')} AS drink_revenue FROM order_items {DAILY}""",
)
_metric(
    "metric_orders",
    ["orders", "order_total", "order_cost", "tax_paid"],
    [TimeDimension("month")],
    f"""SELECT substr(ordered_at, 1, 8) || '01' AS metric_time, count(*) AS orders, {_dec('order_total')} AS order_total,
  {_dec('order_cost')} AS order_cost, {_dec('tax_paid')} AS tax_paid FROM orders_mart GROUP BY 1""",
)
_metric(
    "metric_median",
    ["median_revenue", "revenue"],
    [TimeDimension("day")],
    f"""SELECT ordered_at AS metric_time, median(product_price) AS median_revenue, {_dec('product_price')} AS revenue
FROM order_items {DAILY}""",
)
_metric(
    "metric_customers",
    ["customers", "count_lifetime_orders", "lifetime_spend_pretax", "lifetime_spend"],
    [Key("customer_type")],
    f"""SELECT customer_type, count(DISTINCT customer_id) AS customers, CAST(sum(count_lifetime_orders) AS BIGINT) AS count_lifetime_orders,
  {_dec('lifetime_spend_pretax')} AS lifetime_spend_pretax, {_dec('lifetime_spend')} AS lifetime_spend FROM customers_mart GROUP BY 1""",
)
_metric(
    "metric_average",
    ["average_tax_rate"],
    [Key("location")],
    "SELECT location_id AS location, avg(tax_rate) AS average_tax_rate FROM stg_locations GROUP BY 1",
)
_metric(
    "metric_filtered",
    ["new_customer_orders", "large_orders", "food_orders", "drink_orders"],
    [TimeDimension("day")],
    f"""SELECT ordered_at AS metric_time, CAST(sum(1) FILTER (WHERE customer_order_number = 1) AS BIGINT) AS new_customer_orders,
  CAST(sum(1) FILTER (WHERE order_total >= 20) AS BIGINT) AS large_orders, CAST(sum(1) FILTER (WHERE is_food_order) AS BIGINT) AS food_orders,
  CAST(sum(1) FILTER (WHERE is_drink_order) AS BIGINT) AS drink_orders FROM orders_mart {DAILY}""",
)
_metric(
    "metric_ratio",
    ["food_revenue_pct", "drink_revenue_pct"],
    [Key("order_id")],
    f"""SELECT order_id, round({_dec('CASE WHEN is_food_item THEN product_price ELSE 0 END')} / {_dec('product_price')}, 6) AS food_revenue_pct,
  round({_dec('CASE WHEN is_drink_item THEN product_price ELSE 0 END')} / {_dec('product_price')}, 6) AS drink_revenue_pct
FROM order_items GROUP BY 1""",
)
_metric(
    "metric_aov",
    ["average_order_value"],
    [Key("customer")],
    f"""SELECT customer_id AS customer, round({_dec('lifetime_spend_pretax')} / sum(count_lifetime_orders), 6) AS average_order_value
FROM customers_mart GROUP BY 1""",
)
_metric(
    "metric_profit",
    ["order_gross_profit"],
    [TimeDimension("day")],
    f"""SELECT ordered_at AS metric_time, CAST(CAST(r.revenue AS DECIMAL(18, 2)) - CAST(c.order_cost AS DECIMAL(18, 2)) AS DOUBLE) AS order_gross_profit
FROM (SELECT ordered_at, {_dec('product_price')} AS revenue FROM order_items {DAILY}) r
FULL JOIN (SELECT ordered_at, {_dec('order_cost')} AS order_cost FROM orders_mart {DAILY}) c USING (ordered_at)""",
)
REVENUE_SQL = f"(SELECT CAST(ordered_at AS DATE) AS day, {_dec('product_price')} AS revenue FROM order_items {DAILY})"
_metric(
    "metric_mom",
    ["revenue", "revenue_growth_mom"],
    [TimeDimension("day")],
    f"""SELECT strftime(cur.day, '%Y-%m-%d') AS metric_time, cur.revenue,
  round((cur.revenue - prev.revenue) * 100 / prev.revenue, 6) AS revenue_growth_mom
FROM {REVENUE_SQL} cur LEFT JOIN {REVENUE_SQL} prev ON prev.day = CAST(cur.day - INTERVAL 1 MONTH AS DATE)""",
)
_metric(
    "metric_cumulative",
    ["revenue", "cumulative_revenue"],
    [TimeDimension("day")],
    f"""SELECT strftime(day, '%Y-%m-%d') AS metric_time, revenue,
  CAST(sum(CAST(revenue AS DECIMAL(18, 2))) OVER (ORDER BY day) AS DOUBLE) AS cumulative_revenue FROM {REVENUE_SQL}""",
)
FILLED_SQL = f"""(SELECT s.day, r.revenue FROM (
  SELECT CAST(unnest(generate_series(last - INTERVAL 3650 DAY, last, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT CAST(max(o_orderdate) AS DATE) AS last FROM orders)) s LEFT JOIN {REVENUE_SQL} r ON r.day = s.day)"""


def _filled_metric(name: str, metrics: list[str], sql: str) -> None:
    """A daily metric with a row for every day up to the newest order."""

    def run(spark, d):
        newest = table(spark, d, "orders").agg(F.max("o_orderdate")).scalar()
        return _rounded(Shop(spark, d).catalog.query_metrics(metrics, [TimeDimension("day")], date_spine(spark, newest)))

    query(name, mart_sql(sql))(run)


_filled_metric(
    "metric_cumulative_filled",
    ["revenue", "cumulative_revenue"],
    f"""SELECT strftime(day, '%Y-%m-%d') AS metric_time, revenue,
  CAST(sum(CAST(revenue AS DECIMAL(18, 2))) OVER (ORDER BY day) AS DOUBLE) AS cumulative_revenue FROM {FILLED_SQL}""",
)
_filled_metric(
    "metric_mom_filled",
    ["revenue", "revenue_growth_mom"],
    f"""SELECT strftime(cur.day, '%Y-%m-%d') AS metric_time, cur.revenue,
  round((cur.revenue - prev.revenue) * 100 / prev.revenue, 6) AS revenue_growth_mom
FROM {FILLED_SQL} cur LEFT JOIN {FILLED_SQL} prev ON prev.day = CAST(cur.day - INTERVAL 1 MONTH AS DATE)""",
)
SPEND_SQL = f"""(SELECT customer_id, CAST(ordered_at AS DATE) AS day, {_dec('order_total')} AS spend FROM stg_orders GROUP BY 1, 2)"""


@query(
    "metric_cumulative_filled_by_customer",
    mart_sql(f"""SELECT customer_id AS customer, count(*) AS days, count(spend) AS days_with_orders,
  max(upto) AS spend_in_all, CAST(sum(CAST(upto AS DECIMAL(18, 2))) AS DOUBLE) AS sum_of_totals
FROM (SELECT customer_id, spend, CAST(sum(CAST(spend AS DECIMAL(18, 2))) OVER (PARTITION BY customer_id ORDER BY day) AS DOUBLE) AS upto
  FROM (SELECT customer_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM {SPEND_SQL} GROUP BY 1)
  LEFT JOIN {SPEND_SQL} USING (customer_id, day)) GROUP BY 1"""),
)
def cumulative_by_customer(spark, d):
    """Each customer's spending so far on every day between their first and last order, summed up per customer."""
    catalog = Shop(spark, d).catalog.extended([Cumulative("spend_so_far", "order_total")])
    series = catalog.query_metrics(["order_total", "spend_so_far"], [TimeDimension("day"), Key("customer")], fill=True)
    return portable(
        series.groupBy("customer").agg(
            F.count(F.lit(1)).alias("days"), F.count("order_total").alias("days_with_orders"),
            F.max("spend_so_far").alias("spend_in_all"), F.sum("spend_so_far").alias("sum_of_totals"),
        )
    )


_metric(
    "metric_grains_by_month",
    ["revenue", "food_revenue", "order_cost", "order_total"],
    [TimeDimension("month")],
    f"""SELECT * FROM (SELECT substr(ordered_at, 1, 8) || '01' AS metric_time, {_dec('product_price')} AS revenue,
  {_dec('CASE WHEN is_food_item THEN product_price ELSE 0 END')} AS food_revenue FROM order_items GROUP BY 1)
FULL JOIN (SELECT substr(ordered_at, 1, 8) || '01' AS metric_time, {_dec('order_cost')} AS order_cost, {_dec('order_total')} AS order_total
  FROM orders_mart GROUP BY 1) USING (metric_time)""",
)
_metric(
    "metric_by_entity",
    ["order_total", "orders"],
    [Key("location"), TimeDimension("year")],
    f"""SELECT location_id AS location, substr(ordered_at, 1, 4) || '-01-01' AS metric_time, {_dec('order_total')} AS order_total,
  count(*) AS orders FROM orders_mart GROUP BY 1, 2""",
)
_metric("metric_total", ["revenue", "order_cost", "cumulative_revenue"], [],
    f"""SELECT (SELECT {_dec('product_price')} FROM order_items) AS revenue, (SELECT {_dec('order_cost')} FROM orders_mart) AS order_cost,
  (SELECT {_dec('product_price')} FROM order_items) AS cumulative_revenue""")

SAVED_SQL = {
    "customer_order_metrics": f"""SELECT customer_id AS customer, CAST(sum(count_lifetime_orders) AS BIGINT) AS count_lifetime_orders,
  {_dec('lifetime_spend_pretax')} AS lifetime_spend_pretax,
  round({_dec('lifetime_spend_pretax')} / sum(count_lifetime_orders), 6) AS average_order_value FROM customers_mart GROUP BY 1""",
    "revenue_metrics": f"""SELECT ordered_at AS metric_time, {_dec('product_price')} AS revenue,
  {_dec('CASE WHEN is_food_item THEN product_price ELSE 0 END')} AS food_revenue,
  {_dec('CASE WHEN is_drink_item THEN product_price ELSE 0 END')} AS drink_revenue FROM order_items {DAILY}""",
    "order_metrics": f"""SELECT ordered_at AS metric_time, count(*) AS orders,
  CAST(sum(1) FILTER (WHERE customer_order_number = 1) AS BIGINT) AS new_customer_orders, {_dec('order_total')} AS order_total,
  CAST(sum(1) FILTER (WHERE is_food_order) AS BIGINT) AS food_orders, CAST(sum(1) FILTER (WHERE is_drink_order) AS BIGINT) AS drink_orders
FROM orders_mart {DAILY}""",
}


def _saved(name: str):
    metrics, group_by = SAVED_QUERIES[name]

    def run(spark, d):
        # Table names are shared by all sessions of a catalog, so each run has its own.
        own = f"{name}_{uuid.uuid4().hex}"
        exported = Shop(spark, d).catalog.saved_query(name, metrics, group_by, scratch_path(spark, name), own)
        return _rounded(exported)

    return run


for _name, _sql in SAVED_SQL.items():
    query(f"saved_query_{_name}", mart_sql(_sql))(_saved(_name))


# ------------------------------------------- series, spine and combinations


def _daily(spark: SparkSession, d: str) -> DataFrame:
    """Orders and their value in cents per order day."""
    return (
        table(spark, d, "orders")
        .groupBy(F.to_date("o_orderdate").alias("day"))
        .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    )


DAILY_SQL = "(SELECT CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1)"


@query(
    "date_spine",
    f"""SELECT strftime(s.day, '%Y-%m-%d') AS day, cents FROM (
  SELECT CAST(unnest(generate_series(last - INTERVAL 3650 DAY, last, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT CAST(max(o_orderdate) AS DATE) AS last FROM orders)) s LEFT JOIN {DAILY_SQL} r ON r.day = s.day""",
)
def spine_series(spark, d):
    newest = table(spark, d, "orders").agg(F.max("o_orderdate")).scalar()
    return portable(on_spine(_daily(spark, d), date_spine(spark, newest), "day"))


@query(
    "offset_join",
    f"""SELECT strftime(cur.day, '%Y-%m-%d') AS day, cur.cents, prev.cents AS cents_before,
  round((cur.cents - prev.cents) * CAST(100 AS DOUBLE) / prev.cents, 6) AS growth
FROM {DAILY_SQL} cur LEFT JOIN {DAILY_SQL} prev ON prev.day = CAST(cur.day - INTERVAL 2 MONTH AS DATE)""",
)
def offset_series(spark, d):
    joined = offset_join(_daily(spark, d), "day", "cents", "cents_before", months=2)
    return portable(joined.withColumn("growth", F.round(growth_pct("cents", "cents_before"), 6)))


@query(
    "cumulative",
    f"SELECT strftime(day, '%Y-%m-%d') AS day, cents, CAST(sum(cents) OVER (ORDER BY day) AS BIGINT) AS upto FROM {DAILY_SQL}",
)
def cumulative_series(spark, d):
    return portable(cumulative(_daily(spark, d), "day", "cents", "upto"))


@query(
    "combine_metrics",
    f"""SELECT strftime(coalesce(o.day, e.day), '%Y-%m-%d') AS day, cents, shipped FROM {DAILY_SQL} o
FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS shipped FROM lineitem GROUP BY 1) e ON o.day = e.day""",
)
def combined_series(spark, d):
    shipped = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("shipped"))
    return portable(combine_metrics(_daily(spark, d), shipped, ["day"]))
