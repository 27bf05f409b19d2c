"""Steps that must not shuffle, gather or sort more than they need on large tables."""

import datetime as dt

import pytest

from conftest import rows
from test_sales import T0, cleaned
from tradeledger import session
from tradeledger.plans import opportunity, pricing, release_notes
from tradeledger.session import ADVISORY_CONF, ADVISORY_SIZE, apply_skew_settings

DAY = dt.date(2016, 1, 4)
LOOKUP = "day date, customer_id long, salesperson string, cuc string, car_id long, core_type string"
SALE = "customer_id long, sale_date date, salesperson string, cuc string, car_id long, core_type string, so_number long, item string, jobber_price int, item_cost int, sale_price int, quant_sold int"
FACT = (
    "week int, month int, customer_id long, so_number long, _coupon boolean, _admin boolean, _adjusted boolean, "
    + ", ".join(f"{c} long" for c in opportunity._ADDED)
)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def facts(spark):
    made = [
        (1, 1, 7, 100, True, False, False, 2),
        (2, 1, 7, 100, False, True, False, 3),
        (2, 1, 8, 101, False, False, True, 5),
        (2, 1, 8, None, False, False, False, 0),
        (None, None, 9, 102, False, False, False, 11),
        (None, None, None, None, False, False, False, 1),
    ]
    return spark.createDataFrame([(*r[:7], *[r[7]] * len(opportunity._ADDED)) for r in made], FACT)


@pytest.mark.parametrize("period", ["week", "month"])
def test_sums_are_not_kept_by_order(spark, period):
    plan = optimized(opportunity.order_counts(facts(spark), period))
    by_order = [x for x in plan.splitlines() if x.split("Aggregate [")[-1].split("]")[0].count("so_number")]
    assert by_order and not any("units_sold" in x for x in by_order if "Aggregate" in x)


def test_counts_and_sums_of_periods(spark):
    names = ["ext_quant", "units_sold", "transactions", "coupon_transactions", "admins", "adjustments", "customers"]
    weeks = opportunity.order_counts(facts(spark), "week")
    assert rows(weeks, "week", *names) == [(None, 12, 12, 1, 0, 0, 0, 1), (1, 2, 2, 1, 1, 0, 0, 1), (2, 8, 8, 2, 0, 1, 1, 2)]
    months = opportunity.order_counts(facts(spark), "month")
    assert rows(months, "month", *names) == [(None, 12, 12, 1, 0, 0, 0, 1), (1, 10, 10, 2, 1, 1, 1, 2)]


def sale(so, qty, customer=1, car=1, user="bob"):
    return (customer, DAY, user, "A", car, "x", so, "a", 1, 1, 10, qty)


def matched(spark):
    sold = [sale(1, 1), sale(2, -1), sale(3, 0), sale(4, None), sale(5, 2, customer=None), sale(6, 1, car=None), sale(7, 1)]
    asked = [(DAY, 1, "bob", "A", 1, "y"), (DAY, None, "bob", "A", 1, "y"), (DAY, 2, "bob", "A", None, "y")]
    return opportunity.lookup_sale_match(spark.createDataFrame(sold, SALE), spark.createDataFrame(asked, LOOKUP))


def test_lookups_are_joined_once(spark):
    got = matched(spark)
    assert optimized(got).count("Join ") == 1
    assert rows(got, "so_number", "customer_id", "car_id", "core_type", "is_lookup", "is_sale") == [
        (None, None, 1, "y", True, False),
        (None, 2, None, "y", True, False),
        (1, 1, 1, "y", True, True),
        (2, 1, 1, "x", False, True),
        (5, None, 1, "x", False, True),
        (6, 1, None, "x", False, True),
        (7, 1, 1, "y", True, True),
    ]


def test_visits_are_not_joined_back(spark):
    stocked = matched(spark).selectExpr("*", "int(1) AS in_stock")
    stages = session.cut_lineage(stocked)
    got = opportunity.in_stock_opportunity(stages, [], "ec")
    assert "Join " not in optimized(got)
    assert rows(got, "so_number", "customer_id", "car_id", "sales_opp", "in_stock_opp", "opp_converted") == [
        (None, None, 1, 1, 1, 1),
        (None, 2, None, 1, 1, 0),
        (1, 1, 1, 1, 1, 1),
        (2, 1, 1, 0, 0, 0),
        (5, None, 1, 0, 0, 0),
        (6, 1, None, 1, 1, 1),
        (7, 1, 1, 0, 0, 0),
    ]


def test_the_model_is_known_before_rows_are_dealt(spark):
    rows_of = spark.createDataFrame([("A", 1, 1, 1, 2, 0.5, 5)], "cuc string, fiscal_week int, in_stock_opp int, opp_converted int, quant_sold int, coupon_quant double, ext_sold int")
    model = spark.createDataFrame([("A", 1, 30, 1), ("A", 1, 30, 3)], "cuc string, fiscal_week int, warehouse_id int, roh int")
    got = opportunity.dashboard_rows(rows_of, model)
    assert "Aggregate" not in optimized(got)
    assert rows(got, "cuc", "in_model_opp") == [("A", 1)]


def test_annotated_lines_are_not_gathered_twice(spark):
    uploads = spark.createDataFrame([("f", "1", "1", "p"), ("f", "1", "1", "p"), ("f", "2", "2", "q")], "source_file string, release_name string, release_version string, part_number string")
    # Two products that are not listed give one line; one without name, and lines without release, meet those without name.
    releases = spark.createDataFrame([("1", "1", "B", "n"), ("1", "1", "C", "n"), ("1", "1", None, "n")], "releasename string, releaseversion string, productname string, rmnotes string")
    products = spark.createDataFrame([("A", "a"), (None, None), (None, "z")], "productname string, rmnotes string")
    got = release_notes.annotated_uploads(uploads, releases, products)
    assert not optimized(got).startswith("Aggregate")
    assert rows(got, "part_number", "product_name", "release_notes", "product_notes") == [
        ("p", None, "n", None),
        ("p", None, "n", "z"),
        ("q", None, None, None),
        ("q", None, None, "z"),
    ]


def test_days_of_price_rows_are_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(pricing, "cut_lineage", lambda df: written.append(df.columns) or session.cut_lineage(df))
    got = cleaned(spark, [(1, "a", 1, "b9", "bob", 1), (2, "a", 1, "b9", "bob", 1)], [(1, 2, 6)])
    assert ["source", "day"] in written
    assert rows(got, "so_number", "first_so_date") == [(2, T0.date() + dt.timedelta(days=1))]


def test_shuffle_of_one_task_is_bounded_unless_stated(spark):
    kept = spark.conf.get(ADVISORY_CONF, None)
    try:
        spark.conf.unset(ADVISORY_CONF)
        apply_skew_settings(spark)
        assert spark.conf.get(ADVISORY_CONF) == ADVISORY_SIZE
        spark.conf.set(ADVISORY_CONF, "8m")
        apply_skew_settings(spark)
        assert spark.conf.get(ADVISORY_CONF) == "8m"
    finally:
        spark.conf.unset(ADVISORY_CONF) if kept is None else spark.conf.set(ADVISORY_CONF, kept)
