import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablecheck import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2006-01-31", dt.date(2006, 1, 31)),
        ("31/01/2006", dt.date(2006, 1, 31)),
        ("2006-01-31 10:00:00", dt.date(2006, 1, 31)),
        ("31-01-2006", None),
        ("99/99/2006", None),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, expected):
    assert one(spark, fn.parse_date(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2006-01-31 10:11:12", dt.datetime(2006, 1, 31, 10, 11, 12)),
        ("31/01/2006 10:11:12", dt.datetime(2006, 1, 31, 10, 11, 12)),
        ("2006-01-31", dt.datetime(2006, 1, 31)),
        ("31/01/2006 25:00:00", None),
    ],
)
def test_parse_ts(spark, text, expected):
    assert one(spark, fn.parse_ts(F.lit(text))) == expected


@pytest.mark.parametrize(
    ("value", "expected"), [(0.29, "28%"), (0.5849, "58%"), (0.9999, "99%"), (1.0, "100%"), (0.0, "0%")]
)
def test_pct_truncates(spark, value, expected):
    assert one(spark, fn.pct(F.lit(value))) == expected


def test_cents(spark):
    assert one(spark, fn.cents_to_dollars(F.lit(1199))) == Decimal("11.99")
    assert one(spark, fn.cents_to_dollars(F.lit(None).cast("int"))) is None
    assert spark.range(1).select(fn.cents_to_dollars("id").alias("v")).dtypes == [("v", "decimal(16,2)")]


def test_surrogate_key_keeps_null_parts_apart(spark):
    expected = hashlib.md5(b"SUP-1-JA-2").hexdigest()
    assert one(spark, fn.surrogate_key(F.lit("SUP-1"), F.lit("JA-2"))) == expected
    null = F.lit(None).cast("string")
    marked = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert one(spark, fn.surrogate_key(F.lit("a"), null)) == marked
    assert one(spark, fn.surrogate_key(F.lit("a"), null)) != one(spark, fn.surrogate_key(null, F.lit("a")))


def test_flags_and_labels(spark):
    null = F.lit(None)
    assert one(spark, fn.flag_eq(null.cast("string"), "x")) is False
    assert one(spark, fn.customer_type(null.cast("boolean"))) == "new"
    assert one(spark, fn.customer_type(F.lit(True))) == "returning"
    assert one(spark, fn.indicator("Exactitud", "Sintactica", "t", "c")) == "Exactitud_Sintactica_t_c"
    assert one(spark, fn.run_stamp("2024-11-05 07:08:59")) == "2024-11-05_07:08"
    assert one(spark, fn.as_text(F.lit(12345678.0))) == "1.2345678E7"
    assert one(spark, fn.trunc_day(F.lit("2031-12-08T22:10:00.75").cast("timestamp"))) == dt.date(2031, 12, 8)


def test_matches_finds_and_needs_a_non_empty_match(spark):
    assert one(spark, fn.matches(F.lit("xx12"), r"\d+")) is True
    assert one(spark, fn.matches(F.lit("xx"), r"\d*")) is False
    assert one(spark, fn.matches(F.lit("a b"), "  a b ")) is False
    assert one(spark, fn.matches(F.lit("a "), " $")) is True
    assert one(spark, fn.matches(F.lit("a"), " $")) is False
    assert one(spark, fn.matches(F.lit(None).cast("string"), "a")) is None


def test_in_set_trims_and_survives_quotes(spark):
    assert fn.split_values(" a, ,b ,") == ["a", "b"]
    assert one(spark, fn.in_set(F.lit("O'Brien"), "x, O'Brien")) is True
    assert one(spark, fn.in_set(F.lit("A"), "a")) is False
    assert one(spark, fn.in_set(F.lit(3), "1,3")) is True


def test_between_open_sides(spark):
    assert one(spark, fn.between(F.lit(2), low=2)) is True
    assert one(spark, fn.between(F.lit(2), high=1)) is False
    assert one(spark, fn.between(F.lit(2), 1, 3)) is True
    assert one(spark, fn.between(F.lit(None).cast("int"))) is False


def test_quoted_names(spark):
    df = spark.createDataFrame([(1,)], ["odd `name` with. everything á"])
    assert df.select(fn.as_column(df.columns[0])).first()[0] == 1
