"""Column names with spaces, dots, accents and quotes work everywhere."""

import pytest

from tablecheck.operators import constraints as c
from tablecheck.operators import data_tests as dt
from tablecheck.operators import expectations as e
from tablecheck.operators import joins
from tablecheck.operators import metrics as m
from tablecheck.operators.aggregates import exact_median, frequencies, sum_by
from tablecheck.operators.windows import ordinal
from tablecheck.sources.files import normalize_nulls, read_csv

KEY, TEXT, NUM = "id.cliente", "Nombre del `año`", "valor total"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "a", 1.5), (2, "b", 2.5), (2, "NaN", 3.5), (3, None, None)]
    return spark.createDataFrame(rows, [KEY, TEXT, NUM])


def test_metrics(odd):
    metrics = [
        m.completeness(TEXT), m.pattern_match(TEXT, "^[ab]$"), m.credibility(TEXT, values="a"), m.precision(NUM, 1),
        m.minimum(NUM), m.currency_date(TEXT, "2020-01-01"), m.uniqueness([KEY]), m.referential_integrity(odd, KEY, KEY),
    ]
    assert [r["value"] for r in m.run_metrics(odd, metrics).collect()] == [0.75, 0.5, 0.25, 0.75, 1.5, 0.0, 0.5, 1.0]


def test_rules(odd):
    rules = [e.expect_not_null(TEXT), e.expect_between(NUM, 2), e.expect_unique(KEY)]
    assert [r["unexpected_count"] for r in e.summarize(odd, rules).collect()] == [1, 1, 2]
    assert e.violations(odd, rules, [KEY]).count() == 4
    assert dt.unique(odd, KEY).count() == 1
    assert dt.relationships(odd, KEY, odd.filter(f"`{KEY}` = 2"), KEY).count() == 2
    found = c.validate_constraints(odd, "t", [c.pk(KEY), c.not_null(TEXT), c.fk(KEY, odd, KEY), c.max_length(TEXT, 2)])
    by_name = {r["constraint"].split("(")[0]: r["violations"] for r in found.collect()}
    assert by_name == {"pk": 1, "not_null": 1, "fk": 0, "max_length": 1}


def test_aggregates_and_windows(odd):
    assert frequencies(odd, [KEY, TEXT], digest=True).count() == 4
    assert sum_by(odd, [KEY], NUM).count() == 3
    assert exact_median(odd, [KEY], NUM, "m").count() == 2
    rows = ordinal(odd, KEY, [NUM], "n", min_rows=1).collect()
    assert sorted(r["n"] for r in rows) == [1, 1, 1, 2]
    assert joins.offset_join(odd.selectExpr("date'2024-03-31' AS day", f"`{NUM}`"), "day", NUM, "before").count() == 4


def test_null_tokens(spark, odd, tmp_path):
    assert normalize_nulls(odd).filter(f"`{TEXT.replace('`', '``')}` IS NULL").count() == 2
    path = tmp_path / "odd.csv"
    path.write_text("a.b;c d\nNaN;1\n", encoding="utf-8")
    assert tuple(read_csv(spark, str(path)).first()) == (None, "1")
