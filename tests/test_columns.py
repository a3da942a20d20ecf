import datetime as dt
import hashlib
from decimal import Decimal

import pytest

from lakemart import functions as fn


def one(spark, column, sql="select 1 as one"):
    return spark.sql(sql).select(column).first()[0]


def test_stable_key_matches_md5(spark):
    for text in ("abc", "o1|2", ""):
        expected = int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
        assert one(spark, fn.stable_key("t"), f"select '{text}' as t") == expected
    null_key = int(hashlib.md5(b"_dbt_null_").hexdigest()[:15], 16)
    assert one(spark, fn.stable_key("t"), "select cast(null as string) as t") == null_key
    pair = "select 'o1' as a, 2 as b, cast(null as string) as c"
    assert one(spark, fn.stable_key("a", "b"), pair) == int(hashlib.md5(b"o1|2").hexdigest()[:15], 16)
    assert one(spark, fn.stable_key("a", "c"), pair) == null_key


def test_text(spark):
    row = "select '  A b ' as a, '   ' as blank, '\t' as tab, cast(null as string) as nothing, '\u00a0\u2003' as wide"
    assert one(spark, fn.identifier("a"), row) == "A b"
    assert one(spark, fn.code("a"), row) == "a b"
    assert one(spark, fn.blank_to_null("blank"), row) is None
    assert one(spark, fn.blank_to_null("tab"), row) == "\t"
    assert [one(spark, fn.is_blank(c), row) for c in ("a", "blank", "tab", "nothing", "wide")] == [
        False,
        True,
        True,
        True,
        True,
    ]


@pytest.mark.parametrize(
    ("text", "number"),
    [("1", 1.0), (" -2.5 ", -2.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("1d", None), ("x", None), ("", None)],
)
def test_parsed_number(spark, text, number):
    assert one(spark, fn.parsed_number("t"), f"select '{text}' as t") == number


def test_strict_cast_aborts(spark):
    assert one(spark, fn.strict_cast("t", "int"), "select '' as t") is None
    assert one(spark, fn.strict_cast("t", "int"), "select ' 12 ' as t") == 12
    assert one(spark, fn.strict_cast("t", fn.MONEY), "select '1.005' as t") == Decimal("1.01")
    for bad in ("12.7", "abc"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            one(spark, fn.strict_cast("t", "int"), f"select '{bad}' as t")


def test_dates(spark):
    row = "select timestamp_ntz'2018-12-31 23:59:59' as t, cast(null as timestamp_ntz) as n"
    assert one(spark, fn.date_key("t"), row) == 20181231
    assert one(spark, fn.date_key("n"), row) is None
    day = spark.sql("select date'2018-12-31' as d").selectExpr(*fn.calendar_columns("d")).first()
    assert day.asDict() == {
        "date_key": 20181231,
        "full_date": dt.date(2018, 12, 31),
        "day_of_month": 31,
        "day_of_week": 1,
        "day_name": "Monday",
        "week_of_year": 1,
        "month_number": 12,
        "month_name": "December",
        "quarter_number": 4,
        "year_number": 2018,
        "is_weekend": False,
    }


def test_durations(spark):
    row = (
        "select timestamp_ntz'2018-01-01 00:00:00' as a, timestamp_ntz'2018-01-01 01:30:30.5' as b,"
        " cast(null as timestamp_ntz) as n"
    )
    assert one(spark, fn.elapsed("a", "b", 60), row) == Decimal("90.508333")
    assert one(spark, fn.elapsed("b", "a", 3600), row) == Decimal("-1.508472")
    assert one(spark, fn.elapsed("a", "n", 60), row) is None
    flags = [fn.late_flag("b", "a"), fn.late_flag("a", "b"), fn.late_flag("n", "a"), fn.late_flag("a", "n")]
    assert [one(spark, f, row) for f in flags] == [True, False, None, None]


def test_exact_division(spark):
    rows = "select cast(x as decimal(12,2)) as x from values (552520.70), (0.00), (0.00), (0.00) as t(x)"
    assert one(spark, fn.mean_money("x"), rows) == Decimal("138130.18")
    assert one(spark, fn.rate("1", "3")) == Decimal("0.3333")
    assert one(spark, fn.rate("1", "0")) is None


def test_newest_ignores_null(spark):
    row = "select 1 as a, cast(null as int) as b, 3 as c"
    assert one(spark, fn.newest("a", "b", "c"), row) == 3
