"""Mart models built from staging models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import customer_type
from ..operators.aggregates import count_col, count_distinct, count_flag, sum_by
from ..operators.windows import ordinal


def priced_items(items: DataFrame, products: DataFrame, supplies: DataFrame) -> DataFrame:
    """One row per order item with product attributes and supply cost."""
    attributes = products.select("product_id", "product_name", "product_price", "is_food_item", "is_drink_item")
    return items.join(attributes, "product_id", "left").join(
        sum_by(supplies, ["product_id"], "supply_cost"), "product_id", "left"
    )


def order_items(items: DataFrame, orders: DataFrame, products: DataFrame, supplies: DataFrame) -> DataFrame:
    """One row per order item with order date, product attributes and supply cost.

    The order comes last, so that a grouping by order finds the rows already
    partitioned by it.
    """
    enriched = priced_items(items, products, supplies).join(orders.select("order_id", "ordered_at"), "order_id", "left")
    return enriched.select(
        *items.columns, "ordered_at", "product_name", "product_price", "is_food_item", "is_drink_item", "supply_cost"
    )


def order_items_summary(items: DataFrame) -> DataFrame:
    """Per order: cost, subtotal and item counts."""
    return items.groupBy("order_id").agg(
        F.sum("supply_cost").alias("order_cost"),
        F.sum("product_price").alias("order_items_subtotal"),
        count_flag("is_food_item").alias("count_food_items"),
        count_flag("is_drink_item").alias("count_drink_items"),
        count_col("order_item_id").alias("count_order_items"),
    )


def orders(stg_orders: DataFrame, items: DataFrame, **limits) -> DataFrame:
    """One row per order with its items summed up and the customer's order number.

    An order without items keeps NULL counts and flags. Orders of one day are
    numbered by order id. Hot customers are looked for in the staged orders, a
    narrow scan. ``limits`` as in :func:`~tablecheck.operators.windows.ordinal`.
    """
    joined = stg_orders.join(order_items_summary(items), "order_id", "left")
    flagged = joined.select(
        *stg_orders.columns,
        "order_cost",
        "order_items_subtotal",
        "count_food_items",
        "count_drink_items",
        "count_order_items",
        (F.col("count_food_items") > 0).alias("is_food_order"),
        (F.col("count_drink_items") > 0).alias("is_drink_order"),
    )
    by = ["ordered_at", "order_id"]
    return ordinal(flagged, "customer_id", by, "customer_order_number", cells_from=stg_orders, **limits)


def order_facts(stg_orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order that exists or has items: both grains of a sale from one grouping of the items.

    ``items`` are :func:`priced_items`. Sums of items (``item_*``) hold for items
    without an order too, those of orders (``order_*`` and the staged amounts) are
    NULL there.
    """
    sums = items.groupBy(F.col("order_id").alias("items_of")).agg(
        F.sum("product_price").alias("item_revenue"),
        F.sum(F.when(F.col("is_food_item"), F.col("product_price")).otherwise(0)).alias("item_food_revenue"),
        F.sum(F.when(F.col("is_drink_item"), F.col("product_price")).otherwise(0)).alias("item_drink_revenue"),
        F.sum("supply_cost").alias("item_cost"),
    )
    joined = stg_orders.join(sums, stg_orders["order_id"] == sums["items_of"], "full_outer")
    known = F.col("order_id").isNotNull()
    return joined.withColumn("order_cost", F.when(known, F.col("item_cost"))).withColumn(
        "order_id", F.coalesce("order_id", "items_of")
    ).drop("items_of")


def customers(stg_customers: DataFrame, order_mart: DataFrame) -> DataFrame:
    """One row per customer with lifetime totals and a new/returning label."""
    summary = order_mart.groupBy("customer_id").agg(
        count_distinct("order_id").alias("count_lifetime_orders"),
        F.min("ordered_at").alias("first_ordered_at"),
        F.max("ordered_at").alias("last_ordered_at"),
        F.sum("subtotal").alias("lifetime_spend_pretax"),
        F.sum("tax_paid").alias("lifetime_tax_paid"),
        F.sum("order_total").alias("lifetime_spend"),
    )
    joined = stg_customers.join(summary, "customer_id", "left").select(*stg_customers.columns, *summary.columns[1:])
    return joined.withColumn("customer_type", customer_type(F.col("count_lifetime_orders") > 1))


def products(stg_products: DataFrame) -> DataFrame:
    """Passthrough of staging."""
    return stg_products


def locations(stg_locations: DataFrame) -> DataFrame:
    """Passthrough of staging."""
    return stg_locations


def supplies(stg_supplies: DataFrame) -> DataFrame:
    """Passthrough of staging."""
    return stg_supplies
