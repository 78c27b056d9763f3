"""Staging models: raw inputs renamed and cleaned, one function per input.

All are plain projections, so they melt into the scan of whatever reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cents_to_dollars, flag_eq, surrogate_key, trunc_day

# The names of the staged columns, which marts and metrics build on.


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))


def stg_locations(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        "tax_rate",
        trunc_day("opened_at").alias("opened_date"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("order_item_id"), "order_id", F.col("sku").alias("product_id"))


def stg_orders(raw: DataFrame) -> DataFrame:
    amounts = ["subtotal", "tax_paid", "order_total"]
    return raw.select(
        F.col("id").alias("order_id"),
        F.col("store_id").alias("location_id"),
        F.col("customer").alias("customer_id"),
        *[F.col(a).alias(f"{a}_cents") for a in amounts],
        *[cents_to_dollars(a).alias(a) for a in amounts],
        trunc_day("ordered_at").alias("ordered_at"),
    )


def stg_products(raw: DataFrame, food_type: str, drink_type: str) -> DataFrame:
    """``food_type`` and ``drink_type`` are the product types that count as such."""
    return raw.select(
        F.col("sku").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("type").alias("product_type"),
        F.col("description").alias("product_description"),
        cents_to_dollars("price").alias("product_price"),
        flag_eq("type", food_type).alias("is_food_item"),
        flag_eq("type", drink_type).alias("is_drink_item"),
    )


def stg_supplies(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("id", "sku").alias("supply_uuid"),
        F.col("id").alias("supply_id"),
        F.col("sku").alias("product_id"),
        F.col("name").alias("supply_name"),
        cents_to_dollars("cost").alias("supply_cost"),
        F.col("perishable").alias("is_perishable_supply"),
    )
