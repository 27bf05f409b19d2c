"""History rebuilt from audit rows, on hand-written rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tradeledger.plans import history

D = dt.date


def at(day, hour=20, month=1, year=2020):
    """A time that is the same day in UTC and on the west coast."""
    return dt.datetime(year, month, day, hour)


def deals(spark, *changes):
    data = [(i, 1, 7, when, action, json.dumps(change)) for i, (when, action, change) in enumerate(changes)]
    return spark.createDataFrame(data, "audit_id int, deal_date_id int, deal_id int, created_at timestamp_ntz, action string, changes string")


def days(spark, *changes, **kw):
    found = history.deal_days(deals(spark, *changes), D(2020, 2, 1), 30, **kw)
    return [r[2].day for r in rows(found)]


CREATE = {"listing_id": "5", "listing_type": "Dispensary", "dtstart": "2020-01-06T00:00:00", "rrule": "FREQ=WEEKLY;BYDAY=MO,WE;UNTIL=20200120"}


def test_weekly_rule_on_its_weekdays(spark):
    assert days(spark, (at(2), "create", CREATE)) == [6, 8, 13, 15, 20]
    assert days(spark, (at(2), "create", CREATE), literal=True) == [6, 8, 13, 15, 20]


def test_daily_and_one_day_rules(spark):
    daily = CREATE | {"rrule": "FREQ=DAILY"}
    assert days(spark, (at(2), "create", daily)) == list(range(6, 32))
    assert days(spark, (at(2), "create", CREATE | {"rrule": ""})) == [6]
    # Literally a rule without weekdays falls back to its first day.
    assert days(spark, (at(2), "create", daily), literal=True) == [6]
    assert days(spark, (at(2), "create", CREATE | {"rrule": ""}), literal=True) == [6]


def test_weekly_rule_without_end(spark):
    weekly = CREATE | {"rrule": "FREQ=WEEKLY;BYDAY=TU"}
    assert days(spark, (at(2), "create", weekly)) == [7, 14, 21, 28]
    # Literally it lasts two days: Monday the 6th and Tuesday the 7th.
    assert days(spark, (at(2), "create", weekly), literal=True) == [7]
    # Without a list it repeats on the weekday of the first day.
    plain = CREATE | {"rrule": "FREQ=WEEKLY;UNTIL=20200121"}
    assert days(spark, (at(2), "create", plain)) == [6, 13, 20]
    assert days(spark, (at(2), "create", plain), literal=True) == [6]
    none = CREATE | {"rrule": "FREQ=WEEKLY;BYDAY=SA"}
    assert days(spark, (at(2), "create", none), literal=True) == [6]


def test_an_update_replaces_the_schedule(spark):
    update = (at(10), "update", {"rrule": ["FREQ=WEEKLY;BYDAY=MO,WE;UNTIL=20200120", "FREQ=DAILY;UNTIL=20200112"]})
    assert days(spark, (at(2), "create", CREATE), update) == [6, 8, 10, 11, 12]
    # Literally the update has no start date and only ends the first schedule.
    assert days(spark, (at(2), "create", CREATE), update, literal=True) == [6, 8]
    moved = (at(10), "update", {"dtstart": ["2020-01-06T00:00:00", "2020-01-14T00:00:00"]})
    assert days(spark, (at(2), "create", CREATE), moved) == [6, 8, 15, 20]


def test_destroy_ends_a_deal(spark):
    assert days(spark, (at(2), "create", CREATE), (at(9), "destroy", {})) == [6, 8]


def test_deal_window_and_count(spark):
    long_ago = CREATE | {"dtstart": "2019-12-01T00:00:00", "rrule": "FREQ=DAILY"}
    audits = deals(spark, (at(1, month=12, year=2019), "create", long_ago))
    got = history.deal_active_days(audits, D(2020, 2, 1), 30)
    assert rows(got) == [("5", "Dispensary", 30)]
    assert rows(history.deal_active_days(audits, D(2020, 2, 1), 30, hot_rows=0)) == [("5", "Dispensary", 30)]


def owners(spark, created, changes, as_of=D(2017, 5, 10), **kw):
    accounts = spark.createDataFrame([(f"c{i}", c) for i, c in enumerate(created)], "account_id string, created_at timestamp_ntz")
    tops = spark.createDataFrame([(f"c{i}", "top") for i in range(len(created))], "account_id string, top_level_id string")
    log = spark.createDataFrame(
        [("top", "Owner", w, o, n) for w, o, n in changes] + [("top", "Name", at(3, year=2017), "x", "y")],
        "account_id string, field string, changed_at timestamp_ntz, old_value string, new_value string",
    )
    users = spark.createDataFrame([("u1", "Ann"), ("u2", "Bob"), ("u3", "Cy")], "user_id string, user_name string")
    got = history.account_owner_history(accounts, tops, log, users, as_of, **kw)
    return [(r[0].strftime("%m"), r[1]) for r in rows(got, "month_start", "owner")]


@pytest.mark.parametrize("hot_rows", [10**9, 0])
def test_owner_per_month(spark, hot_rows):
    changes = [(at(15, month=2, year=2017), "u1", "u2"), (at(20, month=2, year=2017), "u2", "u3")]
    # The second child account, created later, does not add rows; a repeated change is dropped.
    got = owners(spark, [at(1, year=2016), at(5, year=2017)], [*changes, changes[0]], hot_rows=hot_rows)
    assert got == [("01", "Ann"), ("02", "Cy"), ("03", "Cy"), ("04", "Cy")]


def test_repeated_change_with_named_and_raw_users(spark):
    changes = [(at(15, month=2, year=2017), "u1", "u2"), (at(15, month=2, year=2017), "Ann", "Bob")]
    got = owners(spark, [at(1, year=2016)], changes)
    assert got == [("01", "Ann"), ("02", "Bob"), ("03", "Bob"), ("04", "Bob")]


def test_account_without_history_has_one_row_per_month(spark):
    assert owners(spark, [at(5, month=3, year=2017)], []) == [("03", None), ("04", None)]


def test_account_without_top_level_is_kept(spark):
    accounts = spark.createDataFrame([("x", at(1, year=2017))], "account_id string, created_at timestamp_ntz")
    tops = spark.createDataFrame([], "account_id string, top_level_id string")
    log = spark.createDataFrame([], "account_id string, field string, changed_at timestamp_ntz, old_value string, new_value string")
    users = spark.createDataFrame([], "user_id string, user_name string")
    got = history.account_owner_history(accounts, tops, log, users, D(2017, 3, 2))
    assert [(r[0], r[1].month) for r in rows(got, "top_level_id", "month_start")] == [(None, 1), (None, 2)]


STATUS = "vr_id int, status int, brand_id int, listing_id int, listing_type string, created_at timestamp_ntz"


def test_retailer_status_intervals(spark):
    retailers = spark.createDataFrame([(1, 1, 8, 10, "Dispensary", at(1)), (2, 0, 8, 11, "Delivery", at(1)), (3, 9, 9, 12, "Delivery", at(1))], STATUS)
    log = [
        (1, 1, at(2), "VerifiedRetailer", '{"status":"0"}'),
        (2, 1, at(5), "VerifiedRetailer", '{"status":["0","1"]}'),
        (3, 1, at(7), "Other", '{"status":["1","2"]}'),
        (4, 1, at(9), "VerifiedRetailer", '{"name":["a","b"]}'),
    ]
    audits = spark.createDataFrame(log, "audit_id int, auditable_id int, created_at timestamp_ntz, auditable_type string, changes string")
    got = history.retailer_status_history(retailers, audits, brand_ids=[8])
    found = [(r[0], r[1].day, r[2] and r[2].day, r[3]) for r in rows(got, "vr_id", "start_date", "end_date", "status_label")]
    # A change of another field keeps the current status; retailers without audit keep theirs.
    assert found == [(1, 2, 5, "Pending"), (1, 5, 9, "Approved"), (1, 9, None, "Approved"), (2, 1, None, "Pending")]
    assert history.retailer_status_history(retailers, audits).count() == 5
    assert rows(history.retailer_status_history(retailers, audits, hot_rows=0)) == rows(history.retailer_status_history(retailers, audits))


@pytest.fixture(scope="module")
def menu(spark):
    log = [
        (1, 1, "Dispensary", at(5), "update", '{"menu_override_id":[null,100000002]}'),
        (2, 1, "Dispensary", at(9), "update", '{"x":1,"menu_override_id":[100000002,99999999]}'),
        (3, 1, "Dispensary", at(12), "update", '{"menu_override_id":[99999999,null]}'),
        (4, 1, "Dispensary", at(3), "create", '{"menu_override_id":100000009}'),
        (5, 1, "Dispensary", at(4), "update", '{"name":["a","b"]}'),
    ]
    audits = spark.createDataFrame(log, "audit_id int, core_id int, core_type string, created_at timestamp_ntz, action string, changes string")
    stores = spark.createDataFrame(
        [(1, "Dispensary", 100000001, 0, None), (2, "Delivery", 100000002, 0, 100000001), (3, "Delivery", 99999999, 0, None)],
        "core_id int, core_type string, wmid long, region_id int, menu_override_id long",
    )
    return stores, audits


def test_menu_overrides(menu):
    stores, audits = menu
    got = rows(history.menu_override_history(stores, audits), "core_id", "update_date", "end_date", "old_override", "new_override")
    found = [(r[0], r[1] and r[1].day, r[2] and r[2].day, r[3], r[4]) for r in got]
    assert found == [
        (1, 5, 9, None, 100000002),
        (1, 9, 12, 100000002, 99999999),
        (1, 12, None, 99999999, None),
        (2, None, None, None, None),
        (3, None, None, None, None),
    ]
    literal = history.menu_override_history(stores, audits, min_length=9)
    assert [r[3] for r in rows(literal, "core_id", "update_date", "old_override", "new_override")][1] is None


@pytest.mark.parametrize("hot_rows", [10**9, 0])
def test_sales_with_the_status_of_their_day(spark, menu, hot_rows):
    stores, audits = menu
    sales = spark.createDataFrame(
        [(n, D(2020, 1, d), c, t, m) for n, d, c, t, m in [(1, 4, 1, "Dispensary", None), (2, 6, 1, "Dispensary", None), (3, 10, 1, "Dispensary", None),
         (4, 20, 1, "Dispensary", None), (5, 6, 2, "Delivery", 100000001), (6, 6, 3, "Delivery", None)]],
        "order_id int, order_date date, core_id int, core_type string, menu_override_id long",
    )
    overrides = history.menu_override_history(stores, audits)
    spans = [(1, "Dispensary", at(1), at(5), "Pending"), (1, "Dispensary", at(5), None, "Approved"), (2, "Delivery", at(6, 0), None, "Rejected")]
    status = spark.createDataFrame(spans, "listing_id int, listing_type string, start_date timestamp_ntz, end_date timestamp_ntz, status_label string")
    got = history.sales_at_retailer_status(sales, overrides, status, stores, hot_rows)
    assert rows(got, "order_id", "has_audit", "new_override", "listing_id", "status_label") == [
        (1, True, None, 1, "Pending"),  # before the first change: its old value, none
        (2, True, 100000002, 2, "Rejected"),
        (3, True, 99999999, 3, None),
        (4, True, None, 1, "Approved"),
        (5, False, None, 1, "Approved"),  # no audit: the store's own override
        (6, False, None, 3, None),
    ]


def test_status_intervals_of_a_retailer_do_not_overlap(spark):
    from __spark_entry__ import queries
    from conftest import SMALL

    spans = queries()["retailer_status_history"](spark, SMALL)
    w = Window.partitionBy("vr_id").orderBy("start_date", F.col("end_date").asc_nulls_last())
    assert spans.withColumn("before", F.lag("end_date").over(w)).filter("before > start_date").count() == 0
