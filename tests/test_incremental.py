"""States that merge and answers from footers."""

import datetime as dt
import os
import random

import pytest

from tablecheck.catalog import QUERIES
from tablecheck.catalog.incremental import _near_ranks
from tablecheck.operators import metrics as m
from tablecheck.operators import states as st
from tablecheck.sources.footers import footer_reads, table_summary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trips_by_day(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 5, 9]), rng.choice(["x1", "y", None]), i) for i in range(300)]
    return spark.createDataFrame(rows, "day string, n int, code string, id int")


@pytest.fixture(scope="module")
def asked(spark):
    return [
        st.size(), st.completeness("n"), st.compliance("big", "n > 4"), st.pattern_match("code", "[0-9]"), st.minimum("n"), st.maximum("n"), st.mean("n"),
        st.approx_distinct("id"), st.approx_quantile("id", 0.5),
    ]


def values(df):
    return {(r["name"], r["instance"]): r["value"] for r in df.collect()}


def test_merged_states_equal_a_run_over_everything(spark, trips_by_day, asked):
    whole = values(st.metrics_from_states(st.metric_states(trips_by_day, asked)))
    merged = values(st.metrics_from_states(st.metric_states(trips_by_day, asked, "day")))
    for key in whole:
        assert merged[key] == pytest.approx(whole[key], rel=0.05 if "Approx" in key[0] else 1e-12), key
    plain = [m.completeness("n"), m.compliance("big", "n > 4"), m.pattern_match("code", "[0-9]"), m.minimum("n")]
    for r in m.run_metrics(trips_by_day, plain).collect():
        assert merged[r["name"], r["instance"]] == r["value"]


def test_a_run_measures_only_new_slices(spark, trips_by_day, asked, tmp_path):
    path = str(tmp_path / "states")
    assert st.read_states(spark, path).collect() == []
    seen = st.refresh_states(trips_by_day.filter("day = 'a' OR day IS NULL"), asked, "day", path)
    assert {r["slice"] for r in seen.collect()} == {"a", None}
    # What changed in a measured slice is not looked at; new slices are.
    changed = trips_by_day.selectExpr("day", "if(day = 'b' OR day = 'c', n, NULL) AS n", "code", "id")
    again = st.refresh_states(changed, asked, "day", path)
    assert values(st.metrics_from_states(again)) == pytest.approx(values(st.metrics_from_states(st.metric_states(trips_by_day, asked, "day"))))
    assert again.count() == 4 * len(asked)
    # Saving a slice again replaces it.
    st.save_states(st.metric_states(trips_by_day.filter("day = 'a'").limit(0), asked, "day"), path)
    assert st.read_states(spark, path).count() == 4 * len(asked)


def test_nothing_to_measure(spark, trips_by_day, asked):
    found = values(st.metrics_from_states(st.metric_states(trips_by_day.limit(0), asked)))
    assert found["Size", "*"] == 0 and found["Completeness", "n"] is None and found["Minimum", "n"] is None
    assert found["ApproxCountDistinct", "id"] == 0 and found["ApproxQuantile-0.5", "id"] is None


def test_footers_answer_without_data_pages(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, float(i), dt.date(2020, 1, 1 + i % 28), f"s{i}", dt.datetime(2020, 1, 1, i % 24)) for i in range(500)]
    spark.createDataFrame(rows, "k long, x double, d date, s string, t timestamp").repartition(4).write.parquet(path)
    with footer_reads(spark):
        plan = spark.read.parquet(path).groupBy().agg({"k": "max", "*": "count"})._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [" in plan and "MAX(k)" in plan
    row = table_summary(spark, path, ["k", "d", "s", "t"]).first()
    assert (row["n"], row["min_k"], row["max_k"], row["max_d"]) == (500, 0, 499, dt.date(2020, 1, 28))
    assert (row["min_s"], row["max_s"], row["max_t"]) == ("s0", "s99", dt.datetime(2020, 1, 1, 23))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_footers_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], "k long, s string").write.parquet(path)
    assert tuple(table_summary(spark, path, ["k", "s"]).first()) == (0, None, None, None, None)


def test_ranks_counted_equal_interpolated_quantiles(spark):
    for seed, size in enumerate((1, 2, 3, 50, 51, 100)):
        rng = random.Random(seed)
        values = [float(rng.randint(0, size)) for _ in range(size)] + [None]
        df = spark.createDataFrame([(v,) for v in values], "x double")
        low, high = df.selectExpr("percentile(x, 0.4)", "percentile(x, 0.6)").first()
        ranks = {f"q{i}": (0.4, 0.6) for i in range(size)}
        found = spark.createDataFrame([(f"q{i}", values[i]) for i in range(size)] + [("other", 1.0)], "name string, value double")
        near = {r["name"]: r["near"] for r in _near_ranks(df, found, "x", ranks).collect()}
        assert near == {f"q{i}": low <= values[i] <= high for i in range(size)}, size


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_sketches_are_held_against_counts(spark):
    """An exact quantile would bring all distinct values into one task."""
    df = QUERIES["states_by_sketch"](spark, SF_DIR)
    assert "percentile(" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r["near"] for r in df.collect()] == [True] * 4
