"""Scans, sinks and materialisation over the given tables.

Each round trip writes a whole table below the shared folder and reads it back.
A JDBC scan needs a running database, so it has no query here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.windows import preview
from ..sources.files import load_seed, normalize_nulls, read_csv, read_json
from ..sources.json_array import read_json_array
from ..sources.scratch import scratch_path
from .data import portable, query, table

# Texts written in place of one priority, to be read as NULL.
TOKEN_SQL = "nullif(o_orderpriority, '5-LOW')"


def _with_tokens(orders):
    token = F.when(F.col("o_orderkey") % 2 == 0, F.lit("NULL")).otherwise(F.lit("NaN"))
    return orders.withColumn(
        "o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", token).otherwise(F.col("o_orderpriority"))
    )


@query(
    "csv_roundtrip",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  {TOKEN_SQL} AS "order priority", strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def csv_roundtrip(spark, d):
    orders = _with_tokens(table(spark, d, "orders")).select(
        F.col("o_orderkey"),
        F.col("o_totalprice"),
        F.col("o_orderpriority").alias("order priority"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    path = scratch_path(spark, "orders-csv")
    orders.write.option("header", True).option("delimiter", ";").csv(path)
    return read_csv(spark, path)


@query(
    "json_roundtrip",
    f"SELECT o_orderkey, o_totalprice, {TOKEN_SQL} AS \"prioridad año\" FROM orders",
)
def json_roundtrip(spark, d):
    orders = _with_tokens(table(spark, d, "orders")).select(
        "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("prioridad año")
    )
    path = scratch_path(spark, "orders-json")
    orders.write.json(path)
    return read_json(spark, path, lines=True)


@query("json_array", f"SELECT o_orderkey, o_totalprice, {TOKEN_SQL} AS \"prioridad año\" FROM orders")
def json_array(spark, d):
    """Files that hold one array of objects each; their number grows with the rows, as such a file is read whole."""
    orders = _with_tokens(table(spark, d, "orders"))
    files = orders.count() // 5000 + 1
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(files)).alias("part")
    rows = F.struct("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("prioridad año"))
    path = scratch_path(spark, "orders-array")
    arrays = orders.groupBy(part).agg(F.to_json(F.collect_list(rows)).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return read_json(spark, path).drop("part")


@query(
    "seed_load",
    "SELECT s_suppkey, s_name || ', \"' || s_nationkey || '\"' AS description, s_acctbal FROM supplier",
)
def seed_load(spark, d):
    suppliers = table(spark, d, "supplier").select(
        "s_suppkey",
        F.concat("s_name", F.lit(', "'), F.col("s_nationkey").cast("string"), F.lit('"')).alias("description"),
        "s_acctbal",
    )
    path = scratch_path(spark, "supplier-seed")
    suppliers.write.option("header", True).option("escape", '"').csv(path)
    return load_seed(spark, path, "s_suppkey bigint, description string, s_acctbal double", name=f"raw_suppliers_{uuid.uuid4().hex}")


@query(
    "normalize_nulls",
    "SELECT user_id, nullif(nullif(event_type, 'view'), 'click') AS kind, value, count(*) AS n FROM events GROUP BY 1, 2, 3",
)
def null_tokens(spark, d):
    token = F.when(F.col("event_type") == "view", F.lit("null")).when(F.col("event_type") == "click", F.lit(""))
    events = table(spark, d, "events").withColumn("kind", F.coalesce(token, "event_type"))
    return normalize_nulls(events).groupBy("user_id", "kind", "value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "preview_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def preview_limit(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return portable(preview(orders.orderBy(F.desc("o_totalprice"), "o_orderkey"), 5))


@query("json_array_split", f"SELECT o_orderkey, o_totalprice, {TOKEN_SQL} AS \"prioridad año\", o_orderstatus || ' }},{{ \"x\"' AS note FROM orders")
def json_array_split(spark, d):
    """One array file of all orders, read in splits of 256 KB; notes hold what looks like the end of an element."""
    orders = _with_tokens(table(spark, d, "orders")).select(
        "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("prioridad año"),
        F.concat("o_orderstatus", F.lit(' },{ "x"')).alias("note"),
    )
    path = scratch_path(spark, "orders-array")
    # One file, as the array is one text: its first line opens it, the last one closes it.
    line = F.to_json(F.struct(*orders.columns))
    numbered = orders.select(F.concat(F.when(F.monotonically_increasing_id() == 0, F.lit("[")).otherwise(F.lit(",")), line).alias("value"))
    end = spark.range(1).select(F.lit("]").alias("value"))
    numbered.coalesce(1).union(end).coalesce(1).write.text(path)
    return normalize_nulls(read_json_array(spark, path, split_bytes=256 << 10))
