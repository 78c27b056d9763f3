"""One bad rule never ends the rest."""

import pytest
from pyspark.sql import functions as F

from tablecheck.operators import constraints as c
from tablecheck.operators import expectations as e
from tablecheck.operators import metrics as m
from tablecheck.operators.planning import isolated, non_raising


@pytest.fixture(scope="module")
def codes(spark):
    return spark.createDataFrame([(1, "5"), (2, "x"), (3, None), (4, "70"), (5, "")], "id int, code string")


def test_empty_lists_give_empty_tables(spark, codes):
    for found in (
        e.summarize(codes, []), e.summarize_isolated(codes, []), e.summarize_guarded(codes, []), e.run_suite(codes, "s", []),
        m.run_metrics(codes, []), m.run_isolated(codes, []), c.validate_constraints(codes, "t", []), c.validate_isolated(codes, "t", []),
    ):
        assert found.collect() == []


def test_bounds_and_patterns_are_looked_at_before_a_run(codes):
    rules = [
        e.expect_between("id", "a", "z"), e.expect_between("id", "1", "4"), e.expect_match_regex("code", "("), e.expect_not_null("code"),
    ]
    found = {r["rule"] + str(i): r for i, r in enumerate(sorted(e.summarize(codes, rules).collect(), key=lambda r: (r["rule"], r["message"] or "")))}
    good, bad, broken, plain = (found[k] for k in ("between(id)0", "between(id)1", "match_regex(code)2", "not_null(code)3"))
    assert (good["unexpected_count"], plain["unexpected_count"]) == (1, 1)
    assert bad["unexpected_count"] is None and "'a' is no int" in bad["message"]
    assert broken["unexpected_count"] is None and broken["message"] and not broken["success"]
    assert {r["rule"] for r in e.violations(codes, rules, ["id"]).collect()} == {"between(id)", "not_null(code)"}


def test_guarded_rules_tell_unjudged_cells_from_missing_ones(codes):
    rule = e.expect_true("cast(code AS int) < 50", "code", "small")
    row = e.summarize_guarded(codes, [rule]).first()
    counts = ("element_count", "missing_count", "unexpected_count", "unjudged_count", "unexpected_percent", "success")
    assert [row[x] for x in counts] == [5, 1, 1, 2, 50.0, False]
    assert sorted(r["id"] for r in e.unjudged_rows(codes, [rule], ["id"]).collect()) == [2, 5]


def test_division_and_index_do_not_raise_when_guarded(spark, codes):
    before = spark.conf.get("spark.sql.ansi.enabled")
    found = c.validate_guarded(codes, "t", [c.check("10 / (id - 1) > 3", "quotient"), c.check("array(1, 2)[id] = 2", "item"), c.pk("id")])
    assert {(r["constraint"], r["violations"], r["unjudged"]) for r in found.collect()} == {
        ("check(quotient)", 1, 1), ("check(item)", 0, 4),
    }
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_settings_return_after_an_error(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    with pytest.raises(RuntimeError), non_raising(spark):
        raise RuntimeError
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_isolation_halves_only_where_something_fails():
    tried = []

    def run(items):
        tried.append(len(items))
        if 13 in items:
            raise RuntimeError("unlucky\nmore")
        return [(i, None) for i in items]

    assert isolated(list(range(16)), run, lambda i, p: [(i, p)]) == [(i, "unlucky" if i == 13 else None) for i in range(16)]
    assert len(tried) == 9


def test_a_source_that_fails_while_read_is_one_message(spark, codes):
    broken = codes.withColumn("boom", F.raise_error(F.lit("gone")).cast("int"))
    found = {r["constraint"]: r for r in c.validate_isolated(broken, "t", [c.check("boom > 0", "boom"), c.not_null("code")]).collect()}
    assert found["not_null(code)"]["violations"] == 1 and "gone" in found["check(boom)"]["message"]
