"""Sales, opportunities and rebates on hand-written rows."""

import datetime as dt
from decimal import Decimal

import pytest

from conftest import rows
from tradeledger.operators.chains import resolve_chain
from tradeledger.plans import opportunity, pricing, rebates, sales

D = dt.date
T0 = dt.datetime(2016, 1, 4, 10)


def orders(spark, *ids):
    return spark.createDataFrame(
        [(i, i, 70 + i, T0 + dt.timedelta(days=i), "bob", Decimal(100)) for i in ids],
        "order_id long, so_number long, customer_id long, ordered_at timestamp_ntz, salesperson string, total decimal(12,2)",
    )


def lines(spark, *data):
    """(order, item, quantity, price)"""
    return spark.createDataFrame(
        [(o, i, 1, Decimal(q), Decimal(p), Decimal(9), Decimal(5)) for o, i, q, p in data],
        "order_id long, item string, car_id long, quantity decimal(9,2), sale_price decimal(12,2), jobber_price decimal(12,2), item_cost decimal(12,2)",
    )


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([("a", "A", "cat", "x"), ("b", "B", "cat", "x"), ("p", "P1", "promo", "x"), ("q", "P2", "promo", "x")], "item string, cuc string, category string, core_type string")


def relations(spark, *data):
    return spark.createDataFrame([(s, t, k, T0 + dt.timedelta(days=n)) for n, (s, t, k) in enumerate(data)], "source long, target long, relation_type int, related_at timestamp_ntz")


def test_several_relations_do_not_multiply_sales(spark, items):
    links = relations(spark, (1, 2, 6), (1, 3, 6), (1, 4, 5), (9, 1, 6))
    got = sales.sales_lines(lines(spark, (1, "a", 2, 10), (1, "a", 3, 10), (2, "b", 1, 7)), orders(spark, 1, 2), items, links, "cat", "2015-01-01")
    assert rows(got, "so_number", "quant_sold", "ext_sold", "was_admin", "was_adjust") == [(1, 5, 50, 1, 1), (2, 1, 7, 0, 0)]
    assert sales.sales_lines(lines(spark, (1, "a", 2, 10)), orders(spark, 1), items, links, "cat", "2016-02-01").count() == 0


def test_all_promo_amounts_are_spread(spark, items):
    data = lines(spark, (1, "a", 1, 10), (1, "b", 1, 20), (1, "p", 1, -4), (1, "q", 1, -2), (2, "a", -1, 10), (2, "p", 1, 3), (3, "p", 1, -1))
    sold = sales.sales_lines(data, orders(spark, 1, 2, 3), items, relations(spark, (8, 9, 4)), "cat", "2015-01-01")
    coupons = sales.order_coupons(data, orders(spark, 1, 2, 3), items, "promo")
    got = rows(sales.sales_with_coupons(sold, coupons), "so_number", "item", "coupon_code", "coupon_quant", "coupon_amount")
    # A positive amount is a return: its quantity turns negative.
    assert got == [(1, "a", "P1", 1.0, -3.0), (1, "b", "P1", 1.0, -3.0), (2, "a", "P1", -1.0, 3.0)]


def test_rollout_restates_the_date_and_joins_once(spark, items):
    links = relations(spark, (1, 2, 6), (2, 3, 6), (3, 50, 4), (3, 51, 4))
    sold = sales.sales_lines(lines(spark, *[(n, "a", 1, 10) for n in (1, 2, 3)]), orders(spark, 1, 2, 3), items, links, "cat", "2015-01-01")
    coupons = spark.createDataFrame([(3, "P", 0.5, -1.0)], "so_number long, coupon_code string, coupon_quant double, coupon_amount double")
    chains = resolve_chain(links.filter("relation_type = 6"))
    final = sales.sales_without_adjustments(sales.sales_with_coupons(sold, coupons), links, chains)
    pickups = spark.createDataFrame([(1, 3, 9, None), (2, 3, 9, 0), (3, 3, 9, 1), (4, 3, 3, 0)], "pickup_id int, so_number long, pickup_type int, deleted int")
    pickup_lines = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", 3), (4, "a", 3), (2, "b", 1)], "pickup_id int, item string, reason_id int")
    reasons = spark.createDataFrame([(1, "late"), (2, "broken"), (3, "aaa")], "reason_id int, reason_name string")
    found = sales.return_reasons(pickups, pickup_lines, reasons)
    calendar = spark.createDataFrame([(D(2016, 1, 5), 1, 1)], "day date, fiscal_week int, fiscal_month int")
    got = sales.sales_rollout(sold, final, chains, links, found, calendar)
    names = ["so_number", "sale_date", "week_of_first_sale", "adjustments", "credit_count", "return_reason", "coupon_quant"]
    assert rows(got, *names) == [(3, D(2016, 1, 5), 1, 2, 2, "broken", 1.0)]


def test_newest_history_wins(spark, items):
    schema = "item string, warehouse_id int, effective_date date, on_hand int"
    new = spark.createDataFrame([("a", 30, D(2016, 1, 2), 5), ("a", 31, D(2016, 1, 2), 9), ("p", 30, D(2016, 1, 2), 9)], schema)
    old = spark.createDataFrame([("a", 30, D(2016, 1, 2), 7), ("a", 30, D(2016, 1, 1), 3), ("a", 30, D(2015, 1, 1), -1)], schema)
    got = opportunity.opening_inventory([new, old], items, 30, "cat")
    assert rows(got) == [("A", D(2016, 1, 2), 3), ("A", D(2016, 1, 3), 5)]


SALE = "customer_id long, sale_date date, salesperson string, cuc string, car_id long, core_type string, so_number long, item string, jobber_price int, item_cost int, sale_price int, quant_sold int"


def sale(so, qty, customer=1, day=1, user="bob", cuc="A", car=1, item="a"):
    return (customer, D(2016, 1, day), user, cuc, car, "x", so, item, 1, 1, 10, qty)


@pytest.fixture
def matched(spark):
    sold = [sale(1, 1), sale(2, 2, day=2), sale(3, -1), sale(4, 0), sale(5, 1, customer=9), sale(6, 1), sale(7, 3, user="ec1")]
    asked = [(D(2016, 1, 1), 1, "bob", "A", 1, "x"), (D(2016, 1, 3), 1, "bob", "A", 1, "x"), (D(2016, 1, 3), 1, "bob", "B", 1, "x")]
    lookups = spark.createDataFrame(asked, "day date, customer_id long, salesperson string, cuc string, car_id long, core_type string")
    return opportunity.lookup_sale_match(spark.createDataFrame(sold, SALE), lookups)


def test_lookups_sales_and_returns(matched):
    assert rows(matched, "day", "so_number", "cuc", "is_lookup", "is_sale") == [
        (D(2016, 1, 1), 1, "A", True, True),
        (D(2016, 1, 1), 3, "A", False, True),
        (D(2016, 1, 1), 5, "A", False, True),
        (D(2016, 1, 1), 6, "A", True, True),
        (D(2016, 1, 1), 7, "A", False, True),
        (D(2016, 1, 2), 2, "A", False, True),
        (D(2016, 1, 3), None, "A", True, False),
        (D(2016, 1, 3), None, "B", True, False),
    ]


def test_one_opportunity_per_visit(spark, matched):
    stock = spark.createDataFrame([("A", D(2016, 1, 1), 4), ("B", D(2016, 1, 3), 1)], "cuc string, inventory_date date, on_hand int")
    calendar = spark.createDataFrame([(D(2016, 1, d), 1, 1) for d in (1, 2, 3)], "day date, fiscal_week int, fiscal_month int")
    stocked = opportunity.with_stock(matched, stock, calendar)
    got = opportunity.in_stock_opportunity(stocked, [9], "ec")
    names = ["day", "so_number", "cuc", "in_stock", "sales_opp", "in_stock_opp", "opp_converted"]
    assert rows(got, *names) == [
        (D(2016, 1, 1), 1, "A", 1, 1, 1, 1),
        (D(2016, 1, 1), 3, "A", 0, 0, 0, 0),  # a return carries nothing
        (D(2016, 1, 1), 5, "A", 1, 0, 0, 0),  # own customer
        (D(2016, 1, 1), 6, "A", 1, 0, 0, 0),
        (D(2016, 1, 1), 7, "A", 1, 0, 0, 0),  # web user
        (D(2016, 1, 2), 2, "A", 0, 1, 0, 1),
        (D(2016, 1, 3), None, "A", 0, 1, 1, 0),  # stock of the visit's other product counts
        (D(2016, 1, 3), None, "B", 1, 0, 0, 0),
    ]


def test_vehicle_zero_is_an_ordinary_vehicle(spark):
    sold = spark.createDataFrame([sale(1, 1, car=0), sale(2, 1, car=0), sale(3, 1, car=4)], SALE)
    asked = spark.createDataFrame([(D(2016, 1, 1), 1, "bob", "A", 0, "x")], "day date, customer_id long, salesperson string, cuc string, car_id long, core_type string")
    stock = spark.createDataFrame([("A", D(2016, 1, 1), 4)], "cuc string, inventory_date date, on_hand int")
    calendar = spark.createDataFrame([(D(2016, 1, 1), 1, 1)], "day date, fiscal_week int, fiscal_month int")
    stocked = opportunity.with_stock(opportunity.lookup_sale_match(sold, asked), stock, calendar)
    got = opportunity.in_stock_opportunity(stocked)
    assert rows(got, "so_number", "car_id", "is_lookup", "sales_opp", "opp_converted") == [
        (1, 0, True, 1, 1),
        (2, 0, True, 0, 0),
        (3, 4, False, 1, 1),
    ]


def test_null_keys_are_ordinary_rows(spark):
    df = spark.createDataFrame([(None, "bob"), (1, None), (None, None), (9, None), (None, "ec2")], "customer_id int, salesperson string")
    assert [r[2] for r in rows(df.select("*", opportunity.is_house_row([9], "ec")))] == [False, False, True, False, True]


AS_OF = D(2016, 7, 6)


@pytest.fixture(scope="module")
def club(spark):
    members = spark.createDataFrame([(1, 2, D(2014, 1, 1), None), (2, 13, D(2014, 1, 1), None), (3, 2, D(2014, 1, 1), D(2016, 1, 1)), (4, 25, D(2014, 1, 1), None), (5, 5, D(2014, 1, 1), None)], "customer_id long, group_id int, activated date, deactivated date")
    groups = spark.createDataFrame([(2, "m", Decimal(1)), (13, "y", Decimal(5)), (25, "q", Decimal(3)), (5, "none", Decimal(9))], "group_id int, group_name string, rebate_pct decimal(5,2)")
    customers = spark.createDataFrame([(i, 30, f"c{i}", 1) for i in range(1, 6)], "customer_id long, warehouse_id int, company_name string, status int")
    made = [
        (1, 1, dt.datetime(2016, 6, 30, 23, 59)),  # last evening of the period
        (2, 1, dt.datetime(2016, 7, 1)),  # after it
        (3, 1, dt.datetime(2016, 5, 31)),
        (4, 2, dt.datetime(2015, 1, 1)),
        (5, 2, dt.datetime(2014, 12, 31)),
        (6, 4, dt.datetime(2016, 4, 2)),
        (7, 4, dt.datetime(2016, 5, 2)),
        (8, 4, dt.datetime(2016, 3, 2)),
        (9, 3, dt.datetime(2016, 6, 2)),
        (10, 5, dt.datetime(2016, 6, 2)),
    ]
    sold = spark.createDataFrame([(n, n, c, w, "x", Decimal(1000 + n)) for n, c, w in made], "order_id long, so_number long, customer_id long, ordered_at timestamp_ntz, salesperson string, total decimal(12,2)")
    charges = spark.createDataFrame([(1, 113, Decimal(10)), (1, 110, Decimal(5)), (1, 111, Decimal(2)), (1, 999, Decimal(99)), (6, 104, Decimal(7))], "so_number long, fee_code int, amount decimal(12,2)")
    return members, groups, customers, sold, charges


def test_rebates_of_closed_periods(club):
    members, groups, customers, sold, charges = club
    monthly = rebates.member_monthly_sales(members, groups, customers, sold, charges, AS_OF)
    assert rows(monthly, "customer_id", "year", "month", "sales", "roy") == [
        (1, 2016, 5, 1003, 0),
        (1, 2016, 6, 1001, 10),
        (2, 2015, 1, 1004, 0),
        (4, 2016, 3, 1008, 0),
        (4, 2016, 4, 1006, 7),
        (4, 2016, 5, 1007, 0),
        (5, 2016, 6, 1010, 0),
    ]
    periods = rebates.member_period_sales(monthly, AS_OF)
    # April to June are all present in the table as a whole, so the second quarter is complete.
    assert [(r[0], r[1], float(r[2])) for r in rows(periods, "frequency", "customer_id", "sales") if r[1] != 5] == [
        ("Annual", 2, 1004.0),
        ("Bi-Monthly", 1, 2004.0),
        ("Bi-Monthly", 4, 1007.0),
        ("Monthly", 1, 1001.0),
        ("Quarter", 1, 2004.0),
        ("Quarter", 4, 2013.0),
    ]
    rates = rebates.rebate_rates(members, groups, customers, periods, {"q": 2.0})
    got = rows(rates, "customer_id", "frequency", "sales", "new_rebate_pct")
    assert [(c, f, float(s), p) for c, f, s, p in got] == [(1, "Monthly", 1001.0, 1.0), (2, "Annual", 1004.0, 0.0), (4, "Quarter", 2013.0, 2.0)]
    paid = rebates.rebate_transactions(rates, sold, AS_OF)
    assert rows(paid, "customer_id", "so_number") == [(1, 1), (2, 4), (4, 6), (4, 7)]
    summary = rebates.rebate_summary(rates, [2])
    assert [tuple(r) for r in summary.select("rebate", "roy_rebate", "ntl_rebate", "loc_rebate").collect()] == [pytest.approx((10.01, 0.1, 0.05, 0.02))]


def test_incomplete_quarter_is_skipped(spark):
    from tradeledger.operators.periods import keep_latest_complete_quarter

    data = [(1, 2015, 4, m) for m in (10, 11, 12)] + [(1, 2016, 1, 1), (2, 2016, 1, 2)]
    df = spark.createDataFrame(data, "c int, year int, quarter int, month int")
    assert {(r["year"], r["quarter"]) for r in keep_latest_complete_quarter(df).collect()} == {(2015, 4)}


def priced(spark, *data):
    """(order, item, customer, plan, user, quantity)"""
    return spark.createDataFrame(
        [(o, T0.date() + dt.timedelta(days=o), c, i, p, u, q, "comp") for o, i, c, p, u, q in data],
        "so_number long, priced_on date, customer_id long, item string, pricing_plan string, quote_user string, sales_qty int, category string",
    )


def cleaned(spark, data, links=((8, 9, 4),), pickups=((1, 99, 9, 0),), age=30, **kw):
    shops = spark.createDataFrame([(1, "Sh", "Shop"), (2, "Re", "Shop"), (3, "Sh", "my TEST shop"), (4, None, "Shop")], "customer_id long, shop_type string, company_name string")
    edges = relations(spark, *links)
    log = spark.createDataFrame([(*p, T0 + dt.timedelta(days=age)) for p in pickups], "pickup_id int, so_number long, pickup_type int, deleted int, created_at timestamp_ntz")
    picked = spark.createDataFrame([(1, "a", 1), (2, "a", 2)], "pickup_id int, item string, reason_id int")
    reasons = spark.createDataFrame([(1, "Phone mistake"), (2, "other")], "reason_id int, reason_name string")
    resolved = resolve_chain(edges.filter("relation_type = 6"))
    kw = {"excluded_users": ["ecom"]} | kw
    return pricing.pricing_noise_cleanup(priced(spark, *data), edges, resolved, shops, log, picked, reasons, **kw)


def test_plans_users_and_shops_are_filtered(spark):
    data = [(1, "a", 1, "b9", "bob", 1), (2, "a", 1, "B1", "bob", 1), (3, "a", 1, "b9", "ECOM", 1), (4, "a", 2, "b9", "bob", 1), (5, "a", 3, "b9", "bob", 1), (6, "a", 4, "b9", "bob", 1), (7, "a", 1, None, "bob", 1)]
    assert [r[0] for r in rows(cleaned(spark, data), "so_number")] == [1]


def test_chain_links_admins_and_returns_are_dropped(spark):
    row = lambda n, q=1: (n, "a", 1, "b9", "bob", q)
    data = [row(1), row(2), row(3), row(5), row(6, None), row(10), (10, "b", 1, "b9", "bob", 1), row(11), row(12), row(20)]
    links = [(1, 2, 6), (2, 3, 6), (5, 90, 5), (6, 91, 5), (20, 20, 6)]
    pickups = [(1, 10, 9, None), (2, 11, 9, 0), (1, 12, 9, 1)]
    got = cleaned(spark, data, links, pickups)
    # 10/a was returned for a listed reason; 6 is an admin order without sale; 20 never resolves.
    assert rows(got, "so_number", "item", "first_so_date") == [
        (3, "a", D(2016, 1, 5)),
        (6, "a", None),
        (10, "b", None),
        (11, "a", None),
        (12, "a", None),
        (20, "a", None),
    ]
    # Returns before the first remaining date do not count.
    assert cleaned(spark, data, links, pickups, age=0).count() == 7
    strict = cleaned(spark, data, links, pickups, keep_unresolved=False)
    assert 20 not in [r[0] for r in rows(strict, "so_number")]
    assert [r[0] for r in rows(pricing.pricing_sample(got, "comp", ["so_number", "item"], 2), "so_number")] == [3, 6]


def test_customers_near_their_warehouse(spark):
    # 0.0867 degrees of latitude are 6.0 miles, 0.0853 are 5.9, 0.0723 are 5.0.
    people = [(1, 30, "a", "a", 40.0723), (2, 30, "B", "a", 40.0853), (3, 30, "a", "X", 40.0), (4, 4, "a", "a", 40.0), (5, 30, "z", "a", 40.0), (6, 30, "a", "a", 40.0867)]
    customers = spark.createDataFrame([(i, w, f"shop {i}", r, s) for i, w, r, s, _ in people], "customer_id long, warehouse_id int, company_name string, route_code string, status string")
    places = spark.createDataFrame([(i, lat, -100.0, 1) for i, _, _, _, lat in people], "customer_id long, latitude double, longitude double, geocode_status_id int")
    houses = spark.createDataFrame([(30, 40.0, -100.0), (4, 40.0, -100.0)], "warehouse_id int, warehouse_latitude double, warehouse_longitude double")
    status = spark.createDataFrame([(1,)], "geocode_status_id int")
    near = lambda literal: [r[0] for r in rows(pricing.customers_within_radius(customers, houses, places, status, literal=literal), "customer_id")]
    assert near(False) == [1]
    assert near(True) == [1, 2]
