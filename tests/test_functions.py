"""Text, date, audit and distance functions on hand-written rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradeledger.functions import audit, dates, geo, text

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("as_of", "quarter", "two_months", "month", "year"),
    [
        (D(2016, 7, 1), (D(2016, 4, 1), D(2016, 7, 1)), (D(2016, 5, 1), D(2016, 7, 1)), (D(2016, 6, 1), D(2016, 7, 1)), D(2015, 1, 1)),
        (D(2016, 2, 29), (D(2015, 10, 1), D(2016, 1, 1)), (D(2015, 12, 1), D(2016, 2, 1)), (D(2016, 1, 1), D(2016, 2, 1)), D(2015, 1, 1)),
        (D(2015, 3, 31), (D(2014, 10, 1), D(2015, 1, 1)), (D(2015, 1, 1), D(2015, 3, 1)), (D(2015, 2, 1), D(2015, 3, 1)), D(2014, 1, 1)),
        (D(2016, 1, 1), (D(2015, 10, 1), D(2016, 1, 1)), (D(2015, 11, 1), D(2016, 1, 1)), (D(2015, 12, 1), D(2016, 1, 1)), D(2015, 1, 1)),
    ],
)
def test_closed_periods(spark, as_of, quarter, two_months, month, year):
    def bounds(name):
        return tuple(one(spark, c) for c in dates.period_bounds(F.lit(as_of), name))

    assert bounds("Quarter") == quarter
    assert bounds("Bi-Monthly") == two_months
    assert bounds("Monthly") == month
    assert bounds("Annual") == (year, D(year.year + 1, 1, 1))


def test_month_and_year_starts():
    assert dates.month_start(D(2016, 1, 15), 2) == D(2015, 11, 1)
    assert dates.month_start(D(2016, 12, 31)) == D(2016, 12, 1)
    assert dates.year_start(D(2016, 2, 29), 1) == D(2015, 1, 1)


@pytest.mark.parametrize(
    ("utc", "local"),
    [
        ("2020-01-15 07:59:59", "2020-01-14 23:59:59"),
        ("2020-01-15 08:00:00", "2020-01-15 00:00:00"),
        ("2020-07-15 06:59:59", "2020-07-14 23:59:59"),
        ("2020-07-15 07:00:00", "2020-07-15 00:00:00"),
        ("2020-03-08 09:59:59", "2020-03-08 01:59:59"),
        ("2020-03-08 10:00:00", "2020-03-08 03:00:00"),
        ("2020-11-01 08:30:00", "2020-11-01 01:30:00"),
        ("2020-11-01 09:30:00", "2020-11-01 01:30:00"),
    ],
)
@pytest.mark.parametrize("tz", ["America/Los_Angeles", "PST"])
def test_local_time_over_clock_changes(spark, utc, local, tz):
    assert one(spark, dates.local_time(dates.ntz(utc), tz)) == dt.datetime.fromisoformat(local)


@pytest.mark.parametrize("day", [D(2020, 1, 15), D(2020, 3, 8), D(2020, 7, 1), D(2020, 11, 1)])
def test_utc_bounds_select_exactly_one_local_day(spark, day):
    tz = "America/Los_Angeles"
    low, high = dates.local_day_bounds(day, day + dt.timedelta(days=1), tz)
    minutes = F.sequence(dates.ntz(day - dt.timedelta(days=1)), dates.ntz(day + dt.timedelta(days=3)), F.expr("interval 1 minute"))
    df = spark.range(1).select(F.explode(minutes).alias("t"))
    inside = df.withColumn("bounds", (F.col("t") >= low) & (F.col("t") < high)).withColumn("own", dates.local_date(F.col("t"), tz) == F.lit(day))
    assert inside.filter("bounds <> own").count() == 0


def test_month_label(spark):
    assert one(spark, dates.month_label(F.lit(D(2016, 7, 6)))) == "Jul-16"


AUDITS = [
    (1, '{"status":"1"}'),
    (2, '{"status":["1","2"],"other":["a","b"]}'),
    (3, '{"other":["a","b"]}'),
    (4, '{"status":["1",null]}'),
    (5, '{"status":[0,3]}'),
    (6, '{"status":["",""]}'),
    (7, "not json"),
    (8, '{"status":null}'),
    (9, '{"status":["a"]}'),
]


def test_audited_values(spark):
    df = spark.createDataFrame(AUDITS, "id int, j string")
    got = df.select("id", audit.audit_new_value(F.col("j"), "status"), audit.audit_old_value(F.col("j"), "status"))
    assert rows(got) == [
        (1, "1", None),
        (2, "2", "1"),
        (3, None, None),
        (4, None, "1"),
        (5, "3", "0"),
        (6, None, None),
        (7, None, None),
        (8, None, None),
        (9, None, "a"),
    ]


def test_recurrence_rules(spark):
    rules = [(1, "FREQ=WEEKLY;BYDAY=MO,WE;UNTIL=20200131"), (2, "FREQ=DAILY"), (3, ""), (4, "FREQ=WEEKLY;UNTIL=20201399;BYDAY=SU"), (5, None)]
    df = spark.createDataFrame(rules, "id int, r string")
    r = F.col("r")
    got = df.select("id", audit.rrule_frequency(r), audit.rrule_days(r), audit.rrule_until(r))
    assert rows(got) == [
        (1, "Weekly", "MO,WE", D(2020, 1, 31)),
        (2, "Daily", None, None),
        (3, "One Day", None, None),
        (4, "Weekly", "SU", None),
        (5, "One Day", None, None),
    ]


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("section_name:Deals,listing_id:42,position:3",), ("position:1,xlisting_id:9",), ("listing_id:,a:b",), (None,)], "s string"
    )
    s = F.col("s")
    got = df.select(text.count_char(s, ":"), text.value_after_key(s, "listing_id"), text.value_after_key(s, "position", 1))
    assert [tuple(r) for r in got.collect()] == [(3, "42", "3"), (2, None, "1"), (2, "", None), (None, None, None)]
    assert one(spark, text.strip_brackets(F.lit('["{a}"]'))) == "a"
    assert one(spark, text.null_if_blank(F.lit(""))) is None


@pytest.mark.parametrize(
    ("value", "plain", "long_only"),
    [("12345678", 12345678, None), ("123456789", 123456789, 123456789), ("null", None, None), ("none_of_it", None, None), (None, None, None)],
)
def test_numbers_in_text(spark, value, plain, long_only):
    column = F.lit(value).cast("string")
    assert one(spark, text.number_from_text(column)) == plain
    assert one(spark, text.number_from_text(column, 9)) == long_only


@pytest.mark.parametrize(("miles", "whole"), [(0.0, 0), (4.9, 4), (5.0, 5), (5.9, 5), (6.0, 6)])
def test_distance_along_a_meridian(spark, miles, whole):
    degrees = miles / geo.EARTH_RADIUS_MILES * geo.DEGREES_PER_RADIAN
    args = [F.lit(v) for v in (40.0, -100.0, 40.0 + degrees, -100.0)]
    assert one(spark, geo.great_circle_miles(*args)) == pytest.approx(miles, abs=1e-9)
    assert one(spark, geo.great_circle_miles(*args, literal=True)) == whole


def test_identical_points_are_not_nan(spark):
    df = spark.range(0, 9000).select((F.col("id") / 100).alias("a"))
    far = df.withColumn("d", geo.great_circle_miles(F.col("a"), F.col("a"), F.col("a"), F.col("a")))
    assert not math.isnan(far.agg(F.max("d")).first()[0])
