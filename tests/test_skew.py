"""Operators whose hot groups are split must give the same rows as the plain ones."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablecheck.operators import joins
from tablecheck.operators.aggregates import exact_median
from tablecheck.operators.windows import ordinal, running_sum

TIGHT = {"share": 0.02, "min_rows": 5}


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows on one key, a tenth without key, many exact copies."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        draw = rng.random()
        key = 1 if draw < 0.34 else None if draw < 0.44 else rng.randrange(2, 60)
        rows.append((key, rng.randrange(30), rng.randrange(5)))
    return spark.createDataFrame(rows, "k int, day int, v int").repartition(6)


@pytest.fixture(scope="module")
def dim(spark):
    rows = [(k, f"name {k}") for k in range(1, 50)] + [(7, "second 7"), (None, "no key")]
    return spark.createDataFrame(rows, "k int, label string")


def bag(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(fact, dim, how):
    hot = joins.hot_keys(fact, ["k"], **TIGHT)
    assert 1 in [k for k, _ in hot]
    salted = joins.salted_join(fact, dim, ["k"], how, hot, salt_on=["day", "v"])
    assert bag(salted) == bag(fact.join(dim, "k", how))


def test_salt_count_is_bounded(fact):
    hot = joins.hot_keys(fact, ["k"], **TIGHT)
    assert len(hot) <= 1 / TIGHT["share"]
    assert sum(n for _, n in hot) <= 2 / TIGHT["share"]
    with_null = joins.hot_keys(fact, ["k"], nulls=True, **TIGHT)
    assert {k for k, _ in with_null} == {k for k, _ in hot} | {None}


def test_hot_rows_spread_over_salts(fact):
    """Even identical rows of a hot key do not all share one salt."""
    salts = dict(joins.hot_keys(fact, ["k"], **TIGHT))[1]
    copies = fact.filter("k = 1").withColumn("day", F.lit(0)).withColumn("v", F.lit(0))
    spread = copies.select(F.pmod(F.xxhash64("day", "v", F.spark_partition_id()), F.lit(salts))).distinct().count()
    assert spread > 1


@pytest.mark.parametrize("limits", [TIGHT, {}])
def test_join_dimension_with_and_without_hot_keys(fact, dim, limits):
    joined = joins.join_dimension(fact, dim, ["k"], "left", ["day", "v"], **limits)
    assert bag(joined) == bag(fact.join(dim, "k", "left"))


def test_orphans_and_rows_in(fact, dim):
    rows = [r.asDict() for r in fact.collect()]
    known = {r["k"] for r in dim.collect() if r["k"] is not None}
    lost = joins.orphans(fact, dim, "k", "k")
    assert lost.count() == sum(r["k"] is not None and r["k"] not in known for r in rows)
    kept = joins.rows_in(fact, dim, ["k"])
    assert kept.count() == sum(r["k"] in known for r in rows)
    keys = {r["key"]: r["n"] for r in joins.orphan_keys(fact, dim, "k", "k").collect()}
    assert sum(keys.values()) == lost.count()


def test_ordinal_equals_row_number(fact):
    df = fact.select("k", "day", F.row_number().over(Window.orderBy("k", "day", "v")).alias("id"))
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("day", "id")).cast("bigint"))
    assert bag(ordinal(df, "k", ["day", "id"], "n", **TIGHT)) == bag(plain)
    assert bag(ordinal(df, "k", ["day", "id"], "n")) == bag(plain)


def largest_range(spark, folder):
    """The most rows in a file of the ranges written last."""
    import glob
    import os

    root = f"{spark.conf.get('spark.checkpoint.dir')}/tablecheck"
    last = max(glob.glob(f"{root}/{folder}-*"), key=os.path.getmtime)
    counts = [spark.read.parquet(f).count() for f in glob.glob(f"{last}/*.parquet")]
    return max(counts), sum(counts)


def test_one_hot_day_of_one_customer_is_cut(spark):
    df = spark.range(20_000).selectExpr("if(id % 10 = 0, id, 7) AS customer", "date'2024-02-03' AS day", "id")
    df = df.withColumn("place", F.xxhash64("id"))
    found = ordinal(df, "customer", ["day", "place"], "n", share=0.01, min_rows=100)
    w = Window.partitionBy("customer").orderBy("day", "place")
    assert found.exceptAll(df.withColumn("n", F.row_number().over(w).cast("bigint"))).count() == 0
    most, total = largest_range(spark, "ranges")
    assert total == 18_000 and most < total / 3


def test_median_of_values_in_a_narrow_band(spark):
    df = spark.range(200_001).selectExpr("1.0e9D + id / 2.0D AS v")
    assert exact_median(df, [], "v", "m").first()["m"] == 1.0e9 + 50_000


def test_median_keeps_few_values_and_starts_no_job(spark):
    spark.sparkContext.setJobGroup("median", "median")
    df = spark.range(400_000).selectExpr("id % 3 AS g", "cast(xxhash64(id) AS double) AS v", "repeat('x', 100) AS wide")
    try:
        out = exact_median(df, ["g"], "v", "m")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("median")
        found = {r["g"]: r["m"] for r in out.collect()}
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    values = {}
    for g, v in df.select("g", "v").collect():
        values.setdefault(g, []).append(v)
    assert found == {g: statistics.median(v) for g, v in values.items()}
    # What the window ranks: one row for all below, and what lies between the two values of the sketch.
    ranked = [int(n) for n in re.findall(r"Window.*?number of output rows: ([0-9,]+)", metrics(out), re.S)]
    assert ranked and max(ranked) < 400_000 / 1000


def metrics(df):
    """Row counts of the windows of the executed plan, as text."""
    lines, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "WindowExec":
            child = node.child()
            while not child.metrics().contains("numOutputRows"):
                child = child.children().apply(0) if child.children().size() else child.plan()
            lines.append(f"Window number of output rows: {child.metrics().apply('numOutputRows').value()}")
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return "\n".join(lines)


def test_hot_keys_take_one_job(spark, fact):
    spark.sparkContext.setJobGroup("hot", "hot")
    try:
        assert joins.hot_keys(fact, ["k"], **TIGHT)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("hot")
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    # Adaptive execution runs the grouping, the ordering and the result as a job each; the rows are read once.
    assert len(jobs) <= 3


def test_running_sum_in_buckets(fact):
    daily = fact.groupBy("k", "day").agg(F.sum("v").alias("v"))
    w = Window.partitionBy("k").orderBy("day")
    plain = daily.withColumn("upto", F.sum("v").over(w)).withColumn("all", F.sum("v").over(Window.partitionBy("k")))
    split = running_sum(daily, ["k"], ["day"], "v", "upto", total="all", split=True, share=0.001, min_rows=5)
    assert bag(split) == bag(plain)
    assert bag(running_sum(daily, ["k"], ["day"], "v", "upto", total="all")) == bag(plain)


def test_exact_median(spark):
    rng = random.Random(3)
    rows = [("hot", rng.choice([-2.5, 0.0, 1e-9, 3.0, 1e12, -7e-5])) for _ in range(501)]
    rows += [("even", float(v)) for v in (4, 1, 3, 2)] + [("one", 9.0), (None, 5.0), (None, 8.0), ("null", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r["g"]: r["m"] for r in exact_median(df, ["g"], "v", "m").collect()}
    want = {}
    for g in {g for g, _ in rows}:
        present = [v for h, v in rows if h == g and v is not None]
        if present:
            want[g] = statistics.median(present)
    assert found == want
    everything = exact_median(df, [], "v", "m").first()["m"]
    assert everything == statistics.median([v for _, v in rows if v is not None])
