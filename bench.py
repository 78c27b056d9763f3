"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query writes its whole result to the noop sink. It runs once to warm up
and once on the clock. ``plans`` gives the table reads and hash shuffles of each
planned query. ``metrics_on_tables`` are metrics over marts that were written
before, the items bucketed by order.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablecheck.catalog import QUERIES  # noqa: E402
from tablecheck.catalog.quality import PLAN, plan_frame, resolver  # noqa: E402
from tablecheck.catalog.shop import Shop  # noqa: E402
from tablecheck.operators import bitmaps, keys  # noqa: E402
from tablecheck.operators.aggregates import frequencies  # noqa: E402
from tablecheck.operators.joins import key_match  # noqa: E402
from tablecheck.plans import marts  # noqa: E402
from tablecheck.plans.quality import run_plan  # noqa: E402
from tablecheck.plans.semantic import Key, TimeDimension, shop_metrics  # noqa: E402
from tablecheck.sources.tables import TABLE, materialize  # noqa: E402

HEADLINE = (
    "plan_run", "report", "check_status", "precision_decimals", "currency_date", "referential_integrity", "uniqueness",
    "constraints", "suite", "violation_counts", "expect_unique", "test_relationships", "rows_in", "satisfies",
    "mart_order_items", "mart_orders", "mart_customers", "order_ordinal", "order_ordinal_split", "median",
    "metric_simple", "metric_filtered", "metric_profit", "metric_mom", "metric_cumulative", "metric_aov",
)

#: Timed too, but not part of the total, which stays comparable over rounds.
FURTHER = (
    "integrity_bitmaps", "uniqueness_two_pass", "constraints_two_pass", "suite_guarded", "json_array_split", "metric_median",
    "metric_grains_by_month", "metrics_from_states", "footer_summary",
)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def plan_size(df: DataFrame) -> dict[str, int]:
    """Table reads and hash shuffles of the planned query."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return {"reads": sum("FileScan" in x for x in lines), "shuffles": sum("Exchange hashpartitioning" in x for x in lines)}


def metrics_on_tables(spark: SparkSession, sf_dir: str, buckets: int) -> dict[str, float]:
    """Seconds of metrics over marts that are tables, as a deployment keeps them."""
    shop = Shop(spark, sf_dir)
    items = materialize(shop.order_items, "bench_order_items", TABLE, cluster_by=["order_id"], buckets=buckets)
    orders = materialize(marts.orders(shop.orders_stg, items), "bench_orders", TABLE)
    people = materialize(marts.customers(shop.customers_stg, orders), "bench_customers", TABLE)
    catalog = shop_metrics(items, orders, people, shop.locations_stg)
    seconds = {}
    for name, metrics, group in (
        ("revenue_by_day", ["revenue", "food_revenue", "drink_revenue"], [TimeDimension("day")]),
        ("profit_by_day", ["order_gross_profit"], [TimeDimension("day")]),
        ("share_by_order", ["food_revenue_pct"], [Key("order_id")]),
        ("value_by_customer", ["average_order_value"], [Key("customer")]),
    ):
        drain(catalog.query_metrics(metrics, group))
        start = time.perf_counter()
        drain(catalog.query_metrics(metrics, group))
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def shuffled_bytes(df: DataFrame) -> int:
    """Bytes that the exchanges of a frame write when it runs."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def bytes_of_keys(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """What references and uniqueness move: whole keys against bitmaps, and whole keys against hashes."""
    items, orders, docs = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "documents"))
    one = F.count(F.lit(1))
    return {
        "reference_by_keys": shuffled_bytes(key_match(items, orders, "l_orderkey", "o_orderkey").groupBy("matched").agg(one)),
        "reference_by_bitmaps": shuffled_bytes(bitmaps.key_bits(items, orders, "l_orderkey", "o_orderkey").agg(
            F.sum("n"), *[F.sum(F.bitmap_count(c)) for c in ("every", "theirs")]
        )),
        "unique_texts_by_keys": shuffled_bytes(frequencies(docs, ["text"]).agg(one)),
        "unique_texts_by_hashes": shuffled_bytes(keys.hash_counts(docs, ["text"]).agg(one)),
    }


def one_job_per_test(spark: SparkSession, sf_dir: str) -> float:
    """The plan the way it costs one table read and one job per test."""
    start = time.perf_counter()
    for test in PLAN:
        drain(run_plan(spark, plan_frame(spark, [test]), resolver(spark, sf_dir)))
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, plans = {}, {}
    for name in HEADLINE:
        plans[name] = plan_size(QUERIES[name](spark, sf_dir))
        drain(QUERIES[name](spark, sf_dir))
        start = time.perf_counter()
        drain(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    further = {}
    for name in FURTHER:
        drain(QUERIES[name](spark, sf_dir))
        start = time.perf_counter()
        drain(QUERIES[name](spark, sf_dir))
        further[name] = round(time.perf_counter() - start, 3)
    single = round(one_job_per_test(spark, sf_dir), 3)
    on_tables = metrics_on_tables(spark, sf_dir, int(cpus))
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plan_one_job_per_test": single,
                "metrics_on_tables": on_tables,
                "plans": plans,
                "bytes_of_keys": bytes_of_keys(spark, sf_dir),
                "further": further,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
