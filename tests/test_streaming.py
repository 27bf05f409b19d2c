import datetime as dt
import json

import pytest
from conftest import rows
from tradeledger.plans.impressions import impression_flatten
from tradeledger.streaming import impressions
from tradeledger.streaming.impressions import BATCH_SCHEMA, append_impressions, read_batches


def test_stream_appends_each_impression_once(tmp_path, spark):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))

    def arrive(*batches):
        data = [("Home", "r", dt.datetime(2020, 7, d, h), u, json.dumps([{"section_name": "Doctors", "listing_id": str(i)} for i in range(n)])) for d, h, u, n in batches]
        df = spark.createDataFrame(data, BATCH_SCHEMA)
        df.write.mode("append").parquet(source)
        append_impressions(read_batches(spark, source), target, marks).awaitTermination()
        return df

    first = arrive((2, 12, "a", 2), (2, 5, "b", 1))
    # One batch is sent again; a new one arrives late for the day before.
    second = arrive((2, 12, "a", 2), (1, 20, "c", 3))
    want = first.unionByName(second).distinct()
    got = spark.read.parquet(target)
    names = ["anonymous_id", "impression_index", "listing_id"]
    assert rows(got, *names) == rows(impression_flatten(want), *names)
    assert {(r["anonymous_id"], r["local_day"].day) for r in got.collect()} == {("a", 2), ("b", 1), ("c", 1)}


def test_stream_keeps_good_batches_beside_others_of_their_key(tmp_path, spark):
    """Batches of another location, unreadable, empty and NULL ones share user and time with good ones."""
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    good = json.dumps([{"section_name": "Doctors", "listing_id": "1"}])
    others = [("Away", good), ("Home", "no json"), ("Home", "[]"), ("Home", None)]
    data = []
    for i in range(40):
        pair = [("Home", good), others[i % 4]]
        data += [(place, "r", dt.datetime(2020, 7, 2, 12), f"u{i}", events) for place, events in pair[:: 1 if i % 8 < 4 else -1]]
    spark.createDataFrame(data, BATCH_SCHEMA).coalesce(1).write.parquet(source)
    append_impressions(read_batches(spark, source), target, marks).awaitTermination()
    got = spark.read.parquet(target)
    assert rows(got, "anonymous_id", "location") == sorted((f"u{i}", "Home") for i in range(40))
    assert spark.read.parquet(f"{target}-rejects").count() == 10


def test_stream_of_all_locations_keeps_each(tmp_path, spark):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    good = json.dumps([{"section_name": "Doctors", "listing_id": "1"}])
    for place in ("Home", "Away"):
        spark.createDataFrame([(place, "r", dt.datetime(2020, 7, 2, 12), "u", good)], BATCH_SCHEMA).write.mode("append").parquet(source)
        append_impressions(read_batches(spark, source), target, marks, location=None).awaitTermination()
    assert rows(spark.read.parquet(target), "location") == [("Away",), ("Home",)]


@pytest.mark.parametrize("broken", [1, 2])
@pytest.mark.parametrize("when", ["before", "after"])
def test_an_epoch_run_again_leaves_everything_once(tmp_path, spark, monkeypatch, broken, when):
    """The run breaks off before or after each of its writes, and is started again."""
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    good = json.dumps([{"section_name": "Doctors", "listing_id": str(i)} for i in range(3)])

    def arrive(day, *texts):
        data = [("Home", "r", dt.datetime(2020, 7, day, 12), f"u{i}", x) for i, x in enumerate(texts)]
        spark.createDataFrame(data, BATCH_SCHEMA).write.mode("append").parquet(source)

    def run():
        append_impressions(read_batches(spark, source), target, marks).awaitTermination()

    arrive(2, good, "no json", good)
    run()
    arrive(2, good, good, good)  # The first and third are sent again, the second is new.
    arrive(3, "no json", good)
    plain, calls = impressions._replace_load, []

    def breaking(*args):
        calls.append(1)
        if len(calls) == broken and when == "before":
            raise RuntimeError("lost")
        plain(*args)
        if len(calls) == broken and when == "after":
            raise RuntimeError("lost")

    monkeypatch.setattr(impressions, "_replace_load", breaking)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(impressions, "_replace_load", plain)
    run()
    got = rows(spark.read.parquet(target), "local_day", "anonymous_id", "impression_index")
    want = [(dt.date(2020, 7, d), u, i) for d, u in ((2, "u0"), (2, "u1"), (2, "u2"), (3, "u1")) for i in range(3)]
    assert got == want
    lost = spark.read.schema(BATCH_SCHEMA).parquet(f"{target}-rejects")
    assert [(b.day, u) for b, u in rows(lost, "batch_time", "anonymous_id")] == [(2, "u1"), (3, "u0")]
    # A new checkpoint reads everything again and finds all of it known.
    append_impressions(read_batches(spark, source), target, marks + "-new").awaitTermination()
    assert spark.read.parquet(target).count() == len(want)


def test_different_batches_of_one_key_both_arrive(tmp_path, spark):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    texts = [json.dumps([{"section_name": "Doctors", "listing_id": i}]) for i in ("1", "2")]
    for batch in ([texts[0], texts[1], texts[0]], [texts[1], texts[0]]):
        data = [("Home", "r", dt.datetime(2020, 7, 2, 12), "u", x) for x in batch]
        spark.createDataFrame(data, BATCH_SCHEMA).write.mode("append").parquet(source)
        append_impressions(read_batches(spark, source), target, marks).awaitTermination()
    assert rows(spark.read.parquet(target), "listing_id") == [("1",), ("2",)]
