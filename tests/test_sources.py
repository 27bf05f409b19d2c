"""Readers, sinks, impressions, release notes and prices."""

import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradeledger import session
from tradeledger.plans import impressions, prices, release_notes
from tradeledger.session import cut_lineage, shared_root, stage_scope
from tradeledger.sources import read, write


def test_headers():
    class Frame:
        columns = ["Release Name", "RM_Comments", "PRODUCT_Name"]

        def toDF(self, *names):
            return list(names)

    assert read.normalise_headers(Frame()) == ["releasename", "rmnotes", "productname"]


def test_ragged_tables_are_stacked(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    assert rows(read.append_ragged(a, b), "k", "a", "b") == [(1, "x", None), (2, None, "y")]


def test_file_set_by_sheet_name_or_position(tmp_path, spark):
    books = {"one": ["1 Release", "2 Product"], "two": ["a first", "b second", "c third"]}
    for book, sheets in books.items():
        (tmp_path / book).mkdir()
        for n, sheet in enumerate(sheets):
            (tmp_path / book / f"{sheet}.csv").write_text(f"v\n{book}{n}\n")
        (tmp_path / book / "notes.txt").write_text("v\nno\n")

    def found(hint, fallback):
        return rows(read.scan_file_set(spark, str(tmp_path), ".csv", "v string", hint, fallback), "source_file", "v")

    assert found("Release", "last") == [("one", "one0"), ("two", "two2")]
    assert found("Product", "second_to_last") == [("one", "one1"), ("two", "two1")]
    assert found("Release", None) == [("one", "one0")]
    everything = read.scan_file_set(spark, str(tmp_path), ".csv", "v string")
    assert everything.count() == 5


def test_files_of_several_layouts_are_stacked_by_name(tmp_path, spark):
    (tmp_path / "in").mkdir()
    files = {
        "1 first.csv": "Part_Number,Comments\n7,x\n8,y\n",
        "a+b.csv": "comments,part number\nz,9\n",
        "only header.csv": "Part_Number,Extra\n",
        "nothing.csv": "",
        "other.txt": "part,number\n1,2\n",
    }
    for name, text in files.items():
        (tmp_path / "in" / name).write_text(text)
    got = read.stack_file_set(spark, str(tmp_path / "in"), ".csv")
    assert rows(got, "source_file", "partnumber", "notes", "extra") == [
        ("1 first.csv", "7", "x", None),
        ("1 first.csv", "8", "y", None),
        ("a+b.csv", "9", "z", None),
    ]
    (tmp_path / "none").mkdir()
    assert read.stack_file_set(spark, str(tmp_path / "none"), ".csv").count() == 0


def test_stages_go_with_their_scope(tmp_path, spark):
    root = Path(shared_root(spark).removeprefix("file:"))
    before = set(root.iterdir())
    outer = cut_lineage(spark.range(3))
    with pytest.raises(ZeroDivisionError), stage_scope(spark):
        kept = cut_lineage(spark.range(5))
        with stage_scope(spark):
            assert cut_lineage(spark.range(4)).count() == 4
        assert kept.count() == 5
        assert len(set(root.iterdir()) - before) == 2
        raise ZeroDivisionError
    assert outer.count() == 3
    assert len(set(root.iterdir()) - before) == 1


def test_csv_with_schema(tmp_path, spark):
    (tmp_path / "x.csv").write_text("a,b\n1,2020-01-05\n,\n")
    got = read.scan_csv(spark, str(tmp_path / "x.csv"), "a int, b date")
    assert rows(got) == [(None, None), (1, dt.date(2020, 1, 5))]


def test_appending_a_day_twice_does_not_repeat_it(tmp_path, spark):
    # 07:59 UTC is still the day before on the west coast.
    times = ["2020-01-10 07:59:00", "2020-01-10 08:00:00", "2020-01-11 07:59:00", "2020-01-11 08:00:00"]
    df = spark.createDataFrame([(i, dt.datetime.fromisoformat(t)) for i, t in enumerate(times)], "id int, ts timestamp_ntz")
    path = str(tmp_path / "out")
    for as_of in (11, 11, 12):
        back = write.sink_incremental_append(df, path, "ts", dt.date(2020, 1, as_of))
    assert [(i, d.day) for i, d in rows(back, "id", "local_day")] == [(1, 10), (2, 10), (3, 11)]


def test_reports_per_file(tmp_path, spark):
    one = spark.createDataFrame([("007", 1), ("b", 2)], "source_file string, x int")
    two = spark.createDataFrame([("007", "n")], "source_file string, note string")
    back = write.sink_multi_report({"all": one, "noted": two}, str(tmp_path / "reports"))
    assert rows(back, "report", "source_file", "x", "note") == [
        ("all", "007", 1, None),
        ("all", "b", 2, None),
        ("noted", "007", None, "n"),
    ]


def test_stages(spark):
    df = spark.range(5)
    assert write.materialise_stage(df).count() == 5
    kept = write.materialise_stage(df, "persist")
    assert kept.storageLevel.useMemory
    kept.unpersist()
    with pytest.raises(ValueError):
        write.materialise_stage(df, "other")


def test_empty_stage_keeps_its_schema(spark):
    df = spark.range(5).filter("id > 9").withColumn("x", F.lit("a"))
    assert session.cut_lineage(df).dtypes == df.dtypes and session.cut_lineage(df).count() == 0


def test_scratch_is_below_the_named_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_root(Session())


BATCH = "location string, region_name string, batch_time timestamp_ntz, anonymous_id string, events string"


def batch(spark, *texts, location="Home"):
    t = dt.datetime(2020, 7, 1)
    return spark.createDataFrame([(location, "r", t, f"u{i}", e) for i, e in enumerate(texts)], BATCH)


def shown(n, **extra):
    return {"section_name": "Deals Nearby", "listing_id": str(n), "position": n} | extra


@pytest.mark.parametrize("n", [0, 1, 100, 101, 250])
def test_batches_of_any_size(spark, n):
    got = impressions.impression_flatten(batch(spark, json.dumps([shown(i) for i in range(n)])))
    assert got.count() == n


def test_sections_decide_which_ids_are_kept(spark):
    ids = {"listing_id": "1", "listing_type": "d", "deal_id": "2", "brand_id": "3", "product_id": "4"}
    sections = ["Deals Nearby", "Doctors", "Featured Brands", "Trending"]
    text = json.dumps([ids | {"section_name": s, "timestamp": "2020-07-01T07:00:00.123Z"} for s in sections] + [{"section_name": "Trending", "nested": {"a": {"b": 1}}}])
    got = impressions.impression_flatten(batch(spark, text))
    names = ["impression_index", "listing_id", "listing_type", "deal_id", "brand_id", "product_id", "section_position"]
    assert rows(got, *names) == [
        (0, "1", "d", "2", None, None, None),
        (1, "1", "d", None, None, None, None),
        (2, None, None, None, "3", None, None),
        (3, None, None, None, "3", "4", None),
        (4, None, None, None, None, None, None),
    ]
    times = [r[1] for r in rows(got, "impression_index", "impression_time")]
    assert times[0] == dt.datetime(2020, 7, 1, 0, 0, 0, 123000) and times[4] is None


def test_the_time_may_have_another_name(spark):
    text = json.dumps([{"section_name": "Doctors", "shown_at": "2020-01-01T08:00:00.000Z", "position": 1}])
    got = impressions.impression_flatten(batch(spark, text), time_field="shown_at")
    assert got.first()["impression_time"] == dt.datetime(2020, 1, 1)


def test_other_locations_and_days_are_left_out(spark):
    text = json.dumps([shown(1)])
    assert impressions.impression_flatten(batch(spark, text, location="Search")).count() == 0
    assert impressions.impression_flatten(batch(spark, text, location="Search"), None).count() == 1
    tz = "America/Los_Angeles"
    # Midnight UTC of 1 July is 30 June on the west coast.
    assert impressions.batches_of_days(batch(spark, text), dt.date(2020, 6, 30), dt.date(2020, 7, 1), tz).count() == 1
    assert impressions.batches_of_days(batch(spark, text), dt.date(2020, 7, 1), dt.date(2020, 7, 2), tz).count() == 0


def test_release_notes_match_column_by_column(spark):
    uploads = spark.createDataFrame(
        [("f", "1", "12", "p1"), ("f", "11", "2", "p2"), ("f", None, None, "p3"), ("f", "1", "12", "p1"), ("g", "x", "y", "p4")],
        "source_file string, release_name string, release_version string, part_number string",
    )
    releases = spark.createDataFrame([("1", "12", "A", "note"), ("1", "12", "A", "note"), (None, None, "B", None)], "releasename string, releaseversion string, productname string, rmnotes string")
    products = spark.createDataFrame([("A", None), ("B", "product note")], "productname string, rmnotes string")
    got = release_notes.release_note_crosscheck(uploads, releases, products)
    names = ["source_file", "part_number", "product_name", "release_notes", "product_notes"]
    assert rows(got["annotated"], *names) == [
        ("f", "p1", "A", "note", None),
        ("f", "p2", None, None, None),
        ("f", "p3", "B", None, "product note"),
        ("g", "p4", None, None, None),
    ]
    assert [r[1] for r in rows(got["lines_with_notes"], *names)] == ["p1", "p3"]
    assert got["uploads"].count() == 5


PRICES = "priced_on date, customer_id int, app_id int, warehouse_id int, style string, category string, pricing_plan string, cuc string, in_stock int, sales_qty decimal(9,2), sale_price decimal(12,2)"


def price(customer=1, day=1, app=1, style="G", cuc="A", qty=None, amount=None, stock=1):
    return (dt.date(2020, 1, day), customer, app, 1, style, "c", "p", cuc, stock, qty and Decimal(qty), amount and Decimal(amount))


def test_price_sum_and_revenue_are_separate(spark):
    df = spark.createDataFrame([price(qty=2, amount=10), price(qty=3, amount=20), price()], PRICES)
    got = prices.price_summary(df).first()
    assert (got["lookups"], got["transactions"], float(got["price_sum"]), float(got["revenue"])) == (3, 2, 30.0, 80.0)
    assert (got["avg_price"], got["avg_sell_price"], got["conversion"]) == pytest.approx((6.0, 16.0, 2 / 3))


def test_a_missing_price_makes_the_mean_and_the_customer_score_null(spark):
    data = [price(cuc="A", qty=1, amount=10), price(cuc="A", qty=1), price(cuc="B", qty=5, amount=30), price(customer=2, cuc="B", qty=5, amount=50), price(customer=2, cuc="C", qty=1, amount=70)]
    df = spark.createDataFrame(data, PRICES)
    means = {r["cuc"]: r["mean_price"] for r in prices.product_price_scores(df).collect()}
    assert means == {"A": None, "B": 40.0, "C": 70.0}
    scores = {r["customer_id"]: r["price_score"] for r in prices.customer_price_scores(df).collect()}
    assert scores[1] is None
    # (40, 70) scale to (-0.7071, 0.7071); weights 5/6 and 1/6.
    assert scores[2] == pytest.approx((-5 / 6 + 1 / 6) * 0.5**0.5)


def test_repeated_lookups_count_once(spark):
    df = spark.createDataFrame([price(), price(qty=1, amount=5), price(app=2), price(day=2), price(customer=2)], PRICES)
    assert rows(prices.customer_conversion(df)) == [(1, pytest.approx(1 / 3)), (2, 0.0)]


def test_small_customers_are_left_out(spark):
    df = spark.createDataFrame([price(customer=1, qty=4, amount=5), price(customer=2, qty=5, amount=6)], PRICES)
    assert [r[0] for r in rows(prices.customer_price_scores(df), "customer_id")] == [2]


def test_only_stocked_prices_inside_the_bounds(spark):
    data = [price(qty=1, amount=a, stock=s) for a, s in [(50, 1), (51, 1), (399, 1), (400, 1), (100, 0), (None, 1)]]
    assert [float(r[1]) for r in rows(prices.stocked_prices(spark.createDataFrame(data, PRICES)))] == [51.0, 399.0]
