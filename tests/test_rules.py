from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tablecheck.operators import constraints as c
from tablecheck.operators import data_tests as dt
from tablecheck.operators import expectations as e


def suite():
    return [
        e.expect_between("crew", low=2),
        e.expect_in_set("class", ["sail"], mostly=0.5),
        e.expect_match_regex("contact", r"@\w+\.boat$"),
        e.expect_match_regex("harbour", "^O", mostly=0.6),
        e.expect_not_null("boat_id"),
        e.expect_not_null("harbour"),
        e.expect_unique("hull"),
        e.expect_unique("title"),
    ]


def test_summary(boats):
    rows = {r["rule"]: r for r in e.summarize(boats, suite()).collect()}
    assert rows["not_null(boat_id)"]["success"]
    harbour = rows["not_null(harbour)"]
    assert (harbour["element_count"], harbour["missing_count"], harbour["unexpected_count"]) == (7, 2, 2)
    assert not harbour["success"]
    assert harbour["unexpected_percent"] == 200 / 7
    # NULL cells leave the denominator: 3 of 5 harbours begin with O.
    regex = rows["match_regex(harbour)"]
    assert (regex["unexpected_count"], regex["success"]) == (2, True)
    assert regex["unexpected_percent"] == 200 / 5
    assert regex["unexpected_percent_total"] == 200 / 7
    between = rows["between(crew)"]
    assert (between["unexpected_count"], between["element_count"], between["success"]) == (1, 7, False)
    assert rows["in_set(class)"]["success"]
    assert rows["unique(title)"]["success"]
    assert rows["unique(hull)"]["unexpected_count"] == 2


def test_violations_are_complete(boats):
    found = e.violations(boats, suite(), ["boat_id"])
    got = {(r["rule"], r["boat_id"], r["value"]) for r in found.collect()}
    want = {("not_null(harbour)", i, None) for i in (2, 5)}
    want |= {("match_regex(harbour)", i, "Skye") for i in (4, 6)}
    want |= {("match_regex(contact)", 2, "brisk.boat"), ("match_regex(contact)", 6, "me@fjord"), ("between(crew)", 4, "1")}
    want |= {("in_set(class)", 3, "motor"), ("in_set(class)", 5, "barge"), ("in_set(class)", 6, "motor")}
    want |= {("unique(hull)", i, "H3") for i in (3, 7)}
    assert got == want
    counts = {(r["rule"], r["value"]): r["n"] for r in e.violation_counts(found).collect()}
    assert counts["match_regex(harbour)", "Skye"] == 2
    assert counts["not_null(harbour)", None] == 2


def test_row_level_violations_share_one_scan(boats, tmp_path):
    path = str(tmp_path / "boats")
    boats.write.parquet(path)
    df = boats.sparkSession.read.parquet(path)
    rules = [r for r in suite() if r.unexpected is not None]
    plan = e.violations(df, rules, ["boat_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan


def test_a_rule_on_a_missing_column_does_not_stop_the_suite(boats):
    rules = [*suite(), e.expect_not_null("mast"), e.expect_unique("mast")]
    rows = {r["rule"]: r for r in e.run_suite(boats, "boats", rules).collect()}
    assert rows["unique(hull)"]["unexpected_count"] == 2 and rows["unique(hull)"]["message"] is None
    for rule in ("not_null(mast)", "unique(mast)"):
        assert rows[rule]["message"] and not rows[rule]["success"] and rows[rule]["element_count"] is None
    assert e.violations(boats, rules, ["boat_id"]).count() == e.violations(boats, suite(), ["boat_id"]).count()
    assert e.violations(boats, rules[-2:], ["boat_id"]).count() == 0


def test_text_cells_without_a_value_fail_their_rule(spark):
    df = spark.createDataFrame([("2",), ("9",), ("two",), (None,), ("3.5",)], "t string")
    rules = [e.expect_between("t", 1, 5), e.expect_in_set("t", [2, 9]), e.expect_between("t", dt_day(2020), None)]
    assert [r["unexpected_count"] for r in e.summarize(df, rules).collect()] == [2, 2, 4]
    found = c.validate_constraints(df, "t", [c.check_age("t", 1, "2030-01-01"), c.not_null("gone"), c.not_null("t"), c.pk("gone")])
    got = {r["constraint"]: (r["violations"], r["message"] is None) for r in found.collect()}
    assert got["not_null(t)"] == (1, True) and got["not_null(gone)"] == (None, False) and got["pk(gone)"] == (None, False)
    assert got["check_age(t)"][1]


def dt_day(year):
    return date(year, 1, 1)


def test_duplicated_rows_by_digest_and_by_shuffle(spark):
    rows = [(i, t) for i, t in enumerate(["x", "y", "x", None, None, "z", "y", "x"])]
    df = spark.createDataFrame(rows, "id int, t string")
    for kwargs in ({}, {"digest": True}):
        got = {r["id"] for r in e.duplicated_rows(df, "t", **kwargs).collect()}
        assert got == {0, 2, 7, 1, 6}


def test_empty_table_meets_every_expectation(boats):
    rows = e.run_suite(boats.filter("boat_id < 0"), "none", suite()).collect()
    assert len(rows) == 8
    assert all(r["success"] and r["suite_success"] and r["element_count"] == 0 for r in rows)
    assert {r["unexpected_percent"] for r in rows} == {0.0}


def test_suite_success(boats):
    rows = e.run_suite(boats, "boats", suite()).collect()
    assert {r["suite_success"] for r in rows} == {False}
    assert {r["suite"] for r in rows} == {"boats"}


def test_data_tests(boats, trips):
    assert dt.not_null(boats, "harbour").count() == 2
    assert [(r["hull"], r["n"]) for r in dt.unique(boats, "hull").collect()] == [("H3", 2)]
    assert dt.unique(boats, "harbour").count() == 2
    assert {(r["class"], r["n"]) for r in dt.accepted_values(boats, "class", ["sail"]).collect()} == {("motor", 2), ("barge", 1)}
    # A NULL outcome passes.
    assert dt.expression_is_true(boats, "sold < '2021-01-01'").count() == 1
    assert [r["boat"] for r in dt.relationships(trips, "boat", boats, "boat_id").collect()] == [12]
    lost = dt.relationships(boats, "boat_id", trips, "boat")
    assert sorted(r["boat_id"] for r in lost.collect()) == [2, 4, 5, 6]
    assert lost.columns == boats.columns


def test_relationships_of_text_keys(spark, boats):
    child = spark.createDataFrame([("1",), ("none",), (None,), ("7",), ("70",)], "boat string")
    assert sorted(r["boat"] for r in dt.relationships(child, "boat", boats, "boat_id").collect()) == ["70", "none"]


def test_relationships_ignores_null_keys(spark):
    child = spark.createDataFrame([(1,), (None,), (5,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert [r["k"] for r in dt.relationships(child, "k", parent, "id").collect()] == [5]


def test_freshness(spark):
    df = spark.createDataFrame([("2025-01-01 00:00:00",), ("2025-01-02 12:00:00",), (None,)], "t string")
    loaded = df.select(F.to_timestamp("t").alias("t"))

    def status(now, **kwargs):
        return dt.freshness(loaded, "t", now, **kwargs).first()

    assert status("2025-01-03 12:00:00")["status"] == "pass"
    late = status("2025-01-03 12:00:01")
    assert (late["status"], late["age_seconds"]) == ("warn", 24 * 3600 + 1)
    assert status("2025-01-02 13:00:01", warn_after=timedelta(hours=1))["status"] == "warn"
    assert dt.freshness(loaded.filter("t IS NULL"), "t", "2025-01-01").first()["status"] == "warn"


def test_constraints(spark, boats):
    born = [(1, "2000-01-01", Decimal("99999999.99")), (2, "2007-06-30", Decimal("100000000.00")), (None, None, None),
            (3, "2007-07-01", Decimal("1.999")), (3, "1990-01-01", Decimal("-3"))]
    df = spark.createDataFrame(born, "id int, born string, amount decimal(20,3)")
    rows = c.validate_constraints(
        df,
        "t",
        [
            c.pk("id"),
            c.unique("id"),
            c.not_null("id"),
            c.check("amount >= 0", "amount"),
            c.check_in("id", [1, 2]),
            c.check_age("born", 18, "2025-06-30"),
            c.fits_decimal("amount", 10, 2),
            c.max_length("born", 9),
            c.fk("id", spark.createDataFrame([(1,), (2,), (2,)], "k int"), "k"),
        ],
    )
    got = {r["constraint"]: r["violations"] for r in rows.collect()}
    assert got == {
        "pk(id)": 2,
        "unique(id)": 1,
        "not_null(id)": 1,
        "check(amount)": 1,
        "check_in(id)": 2,
        "check_age(born)": 1,
        "fits_decimal(amount,10,2)": 1,
        "max_length(born,9)": 4,
        "fk(id)": 2,
    }
    none = c.validate_constraints(df.filter("id = 99"), "t", [c.pk("id"), c.not_null("id"), c.fk("id", boats, "boat_id")])
    assert {r["violations"] for r in none.collect()} == {0}
