import pytest
from pyspark.sql import functions as F

from tablecheck.operators import checks as ck
from tablecheck.operators import metrics as m


def values(df, metrics):
    return [r["value"] for r in m.run_metrics(df, metrics).collect()]


def test_boat_rules(boats, trips):
    found = values(
        boats,
        [
            m.size(),
            m.minimum("boat_id", where="harbour = 'Skye'"),
            m.completeness("harbour"),
            m.satisfies("length(hull) = 2 AND 2 * boat_id > crew", "hull and crew"),
            m.accuracy("berth", pattern=r"^B-\d{3}$"),
            m.credibility("class", values="motor , sail"),
            m.credibility("contact", pattern=r" @\w+\.boat$ "),
            m.completeness("crew"),
        ],
    )
    assert found == [7.0, 4.0, 5 / 7, 5 / 7, 5 / 7, 6 / 7, 4 / 7, 6 / 7]
    assert values(boats, [m.uniqueness("title")]) == [1.0]
    assert values(boats, [m.uniqueness("hull")]) == [5 / 7]
    assert values(boats, [m.uniqueness(["crew", "harbour"], digest=True)]) == [5 / 7]
    assert values(trips, [m.referential_integrity(boats, "boat", "boat_id")]) == [4 / 6]
    assert values(boats, [m.referential_integrity(trips, "boat_id", "boat")]) == [3 / 7]


def test_single_scan_metrics_share_one_aggregation(boats):
    df = m.run_metrics(boats, [m.completeness(c) for c in boats.columns] + [m.minimum("crew")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("as_text", [True, False])
def test_integrity_between_text_and_typed_keys(spark, as_text):
    texts = spark.createDataFrame([("1",), ("x",), ("2",), (None,), ("7",)], "k string")
    numbers = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    child, parent, expected = (texts, numbers, 2 / 5) if as_text else (numbers, texts, 2 / 3)
    assert values(child, [m.referential_integrity(parent, "k", "k")]) == [expected]


def test_minimum_that_is_no_number_gets_a_message(boats):
    days = boats.withColumn("day", F.to_date("launched"))
    rows = m.run_metrics(days, [m.minimum("day"), m.minimum("title"), m.minimum("crew"), m.completeness("title")]).collect()
    got = {(r["name"], r["instance"]): (r["value"], r["message"]) for r in rows}
    assert got["Minimum", "crew"] == (1.0, None) and got["Completeness", "title"] == (1.0, None)
    assert got["Minimum", "title"] == (None, m.NOT_A_NUMBER)
    assert got["Minimum", "day"][0] is None and got["Minimum", "day"][1]


def test_failing_expressions_are_kept_apart(boats):
    metrics = [m.completeness("title"), m.satisfies("cast(title as int) > 0", "raises"), m.size(), m.uniqueness("hull")]
    got = {r["instance"]: (r["value"], r["message"]) for r in m.run_isolated(boats, metrics).collect()}
    assert got["title"] == (1.0, None) and got["*"] == (7.0, None) and got["hull"] == (5 / 7, None)
    assert got["raises"][0] is None and got["raises"][1]
    assert m.run_isolated(boats, []).collect() == []


def test_null_policies(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "c string")
    assert values(df, [m.credibility("c", values="a")]) == [0.5]  # strict
    assert values(df, [m.is_contained_in("c", "a")]) == [0.75]  # pass
    assert values(df, [m.credibility("c", pattern="a|b")]) == [0.75]
    assert values(df, [m.satisfies("c = 'a'", "is a")]) == [0.5]


def test_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "c string")
    assert values(df, [m.completeness("c"), m.credibility("c", pattern=".+"), m.is_contained_in("c", "a")]) == [0, 0, 1]
    # A group in which every key is NULL is left out, so nothing is measured.
    assert values(df, [m.uniqueness("c")]) == [None]


def test_uniqueness_keeps_partly_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None), (None, None)], "a int, b int")
    assert values(df, [m.uniqueness(["a", "b"])]) == [1 / 3]


@pytest.mark.parametrize(
    ("n", "expected"),
    [(0, 0.0), (1, 3 / 6), (2, 2 / 6), ("3", 1 / 6)],
)
def test_precision_judges_the_text(spark, n, expected):
    numbers = [(1.5,), (2.25,), (3.125,), (-4.55,), (None,), (1.2345678e9,)]
    df = spark.createDataFrame(numbers, "x double")
    assert values(df, [m.precision("x", n)]) == [expected]


def test_precision_of_integers(spark):
    df = spark.createDataFrame([(1,), (-2,), (None,), (30,)], "x int")
    assert values(df, [m.precision("x", "0")]) == [0.5]


def test_currency_formats_mix_per_row(spark):
    rows = [("2014-07-09",), ("08/07/2014",), ("01/08/2014",), ("2014-07-08 23:59:59",), ("nonsense",), (None,)]
    df = spark.createDataFrame(rows, "`the day` string")
    assert values(df, [m.currency_date("the day", "2014-07-09")]) == [2 / 6]
    assert values(df, [m.currency_date("the day", "09/07/2014")]) == [2 / 6]
    stamps = [("2014-07-09 06:00:00",), ("09/07/2014 06:00:01",), ("08/07/2014 23:59:59",)]
    df = spark.createDataFrame(stamps, "t string")
    assert values(df, [m.currency_ts("t", "09/07/2014 06:00:00")]) == [2 / 3]


def test_integrity_with_repeated_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (1,), (None,)], "other int")
    assert values(child, [m.referential_integrity(parent, "k", "other")]) == [1 / 4]


def test_empty_input_has_a_message(boats):
    none = boats.filter("boat_id < 0")
    metrics = [
        m.completeness("title"), m.uniqueness("hull"), m.referential_integrity(boats, "boat_id", "boat_id"), m.minimum("crew"),
    ]
    rows = m.run_metrics(none, metrics).collect()
    assert [r["value"] for r in rows] == [None] * 4
    assert {r["message"] for r in rows} == {m.EMPTY_INPUT}


def test_broken_metrics_do_not_stop_the_others(boats):
    rows = m.run_metrics(
        boats,
        [
            m.completeness("mast"),
            m.completeness("boat_id"),
            m.pattern_match("contact", "[a-"),
            m.satisfies("no_such(crew)", "bad sql"),
            m.uniqueness("mast"),
            m.referential_integrity(boats, "boat_id", "no_key"),
            m.minimum("crew"),
        ],
    ).collect()
    by_name = {(r["name"], r["instance"]): (r["value"], r["message"]) for r in rows}
    assert by_name["Completeness", "boat_id"] == (1.0, None)
    assert by_name["Minimum", "crew"] == (1.0, None)
    failed = [v for v in by_name.values() if v[0] is None]
    assert len(failed) == 5
    assert all(message for _, message in failed)


def test_checks(boats):
    rows = ck.run_checks(
        boats,
        [
            ck.Check(ck.WARNING, "classes", m.is_contained_in("class", ["sail", "motor", "barge"]), lambda v: v >= 1.0),
            ck.Check(ck.ERROR, "harbours", m.completeness("harbour")),
            ck.Check(ck.WARNING, "most harbours", m.completeness("harbour"), lambda v: v > 0.7),
            ck.Check(ck.WARNING, "hulls", m.uniqueness("hull")),
            ck.Check(ck.ERROR, "missing", m.completeness("mast")),
        ],
    ).collect()
    status = {r["check"]: (r["status"], r["level"], r["instance"]) for r in rows}
    assert status == {
        "classes": ("Success", "Warning", "class"),
        "harbours": ("Error", "Error", "harbour"),
        "most harbours": ("Success", "Warning", "harbour"),
        "hulls": ("Warning", "Warning", "hull"),
        "missing": ("Error", "Error", "mast"),
    }


def test_where_restricts_the_rows(boats):
    found = values(boats, [m.completeness("harbour", where="boat_id > 3"), m.size(F.col("crew") > 3)])
    assert found == [3 / 4, 4.0]


def test_credibility_needs_one_rule():
    with pytest.raises(ValueError):
        m.credibility("c")
    with pytest.raises(ValueError):
        m.credibility("c", pattern="a", values="b")
