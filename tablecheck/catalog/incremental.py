"""Metrics that do not read a table again: from merged states and from file footers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import states as st
from ..operators.windows import union_frames
from ..sources.footers import table_summary
from ..sources.scratch import saved, scratch_path
from .data import portable, query, table

STATE_METRICS = """SELECT 'Size' AS name, '*' AS instance, CAST(count(*) AS DOUBLE) AS value FROM orders
UNION ALL SELECT 'Completeness', 'status', CAST(count(nullif(o_orderstatus, 'P')) AS DOUBLE) / count(*) FROM orders
UNION ALL SELECT 'Compliance', 'large', CAST(count(*) FILTER (WHERE o_totalprice > 200000) AS DOUBLE) / count(*) FROM orders
UNION ALL SELECT 'PatternMatch', 'o_orderpriority', CAST(count(*) FILTER (WHERE regexp_matches(o_orderpriority, '^[12]-')) AS DOUBLE) / count(*) FROM orders
UNION ALL SELECT 'Minimum', 'o_totalprice', min(o_totalprice) FROM orders
UNION ALL SELECT 'Maximum', 'o_custkey', CAST(max(o_custkey) AS DOUBLE) FROM orders
UNION ALL SELECT 'Mean', 'o_totalprice', round(avg(o_totalprice), 4) FROM orders"""


def _metrics():
    return [
        st.size(), st.completeness("status"), st.compliance("large", "o_totalprice > 200000"),
        st.pattern_match("o_orderpriority", "^[12]-"), st.minimum("o_totalprice"), st.maximum("o_custkey"), st.mean("o_totalprice"),
    ]


def _sliced(spark, d):
    """Orders with a NULL-bearing status and their quarter, by which runs come in."""
    return table(spark, d, "orders").withColumns(
        {"status": F.nullif("o_orderstatus", F.lit("P")), "quarter": F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy-MM")}
    )


@query("metrics_from_states", STATE_METRICS)
def metrics_from_states(spark, d):
    """Three runs, each over what came in since the last one: two years, two more, and the rest; then the states merged."""
    orders, path = _sliced(spark, d), scratch_path(spark, "states")
    years = F.year("o_orderdate")
    first = orders.agg(F.min(years)).scalar()
    for last in (1, 3, 99):
        found = st.refresh_states(orders.filter(years <= first + last), _metrics(), "quarter", path)
    return st.metrics_from_states(found).withColumn("value", F.when(F.col("name") == "Mean", F.round("value", 4)).otherwise(F.col("value")))


@query(
    "states_by_sketch",
    """SELECT 'ApproxCountDistinct' AS name, 'o_custkey' AS instance, true AS near UNION ALL SELECT 'ApproxCountDistinct', 'o_orderkey', true
UNION ALL SELECT 'ApproxQuantile-0.5', 'o_totalprice', true UNION ALL SELECT 'ApproxQuantile-0.9', 'o_totalprice', true""",
)
def states_by_sketch(spark, d):
    """Sketches of all quarters, merged, against exact values: distinct keys within five percent, quantiles within two percent of rank."""
    orders = _sliced(spark, d)
    asked = [
        st.approx_distinct("o_custkey"), st.approx_distinct("o_orderkey"), st.approx_quantile("o_totalprice", 0.5), st.approx_quantile("o_totalprice", 0.9),
    ]
    found = saved(st.metrics_from_states(st.metric_states(orders, asked, "quarter")), "found")
    distinct = orders.agg(F.count_distinct("o_custkey").alias("o_custkey"), F.count_distinct("o_orderkey").alias("o_orderkey"))
    near = _near_ranks(orders, found, "o_totalprice", {"ApproxQuantile-0.5": (0.48, 0.52), "ApproxQuantile-0.9": (0.88, 0.92)})
    both = found.withColumn("one", F.lit(1)).join(distinct.withColumn("one", F.lit(1)), "one").join(near, "name", "left")
    share = F.when(F.col("instance") == "o_custkey", F.col("o_custkey")).otherwise(F.col("o_orderkey"))
    close = F.when(F.col("name") == "ApproxCountDistinct", F.abs(F.col("value") / share - 1) < 0.05).otherwise(F.col("near"))
    return both.select("name", "instance", close.alias("near"))


def _near_ranks(df, found, col, ranks):
    """Whether each value in ``found`` lies between the exact, interpolated quantiles of two ranks: ``name``, ``near``.

    The values below it and up to it are counted, which merges map-side, where a
    quantile itself would need all distinct values in one task. Value number k of
    n, from 0, is at most the quantile of rank p exactly if k <= p * (n - 1).
    """
    asked = found.filter(F.col("name").isin(list(ranks))).select("name", "value")
    counted = df.select(F.col(col).alias("x")).join(F.broadcast(asked)).groupBy("name").agg(
        F.count("x").alias("n"), F.count_if(F.col("x") < F.col("value")).alias("below"),
        F.count_if(F.col("x") <= F.col("value")).alias("upto"), F.first("value").alias("value"),
    )
    last, at = F.col("n") - 1, {i: F.element_at(F.create_map(*[F.lit(x) for n, r in ranks.items() for x in (n, r[i])]), F.col("name")) for i in (0, 1)}
    inside = (F.col("below") <= last * at[1]) & (F.col("upto") - 1 >= last * at[0])
    return counted.select("name", F.when(F.col("value").isNotNull() & (F.col("n") > 0), inside).alias("near"))


@query(
    "footer_summary",
    """SELECT 'lineitem' AS source, count(*) AS n, min(l_orderkey) AS least, max(l_orderkey) AS greatest FROM lineitem
UNION ALL SELECT 'orders', count(*), min(o_custkey), max(o_custkey) FROM orders""",
)
def footer_summary(spark, d):
    """Rows and extremes of whole tables, answered by their footers."""
    asked = {"lineitem": "l_orderkey", "orders": "o_custkey"}
    frames = [
        table_summary(spark, f"{d}/{t}.parquet", [c]).select(
            F.lit(t).alias("source"), "n", F.col(f"min_{c}").alias("least"), F.col(f"max_{c}").alias("greatest")
        )
        for t, c in asked.items()
    ]
    return union_frames(frames)


@query(
    "footer_freshness",
    """SELECT count(*) AS n, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS newest, max(o_totalprice) AS largest FROM orders""",
)
def footer_freshness(spark, d):
    """The newest order, whose time needs a scan of its column, beside what the footers know."""
    found = table_summary(spark, f"{d}/orders.parquet", ["o_totalprice", "o_orderdate"])
    return portable(found.select("n", F.col("max_o_orderdate").alias("newest"), F.col("max_o_totalprice").alias("largest")))
