"""Windows cut into slices give what plain windows give."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tradeledger.operators import intervals, ordered
from tradeledger.session import hadoop_exists, stage_scope


@pytest.fixture(scope="module")
def marks(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(1200):
        # Key "a" holds well over a third of the rows; some times and keys are missing.
        key = rng.choice(["a", "a", "a", "b", "c", None, "d"])
        at = None if rng.random() < 0.02 else start + dt.timedelta(hours=rng.randrange(24 * 20))
        data.append((i, key, at, None if rng.random() < 0.6 else rng.randrange(50)))
    return spark.createDataFrame(data, "id int, key string, at timestamp_ntz, value int").cache()


@pytest.mark.parametrize("hot_rows", [10**9, 300, 20])
@pytest.mark.parametrize("current", [True, False])
def test_carry_equals_plain_window(marks, hot_rows, current):
    slices = ordered.slices_needed(marks, ["key"], hot_rows)
    assert slices == {10**9: None, 300: 4, 20: 60}[hot_rows]
    got = ordered.carry(
        marks,
        ["key"],
        ["at", "id"],
        following={"next_at": "at", "next_value": "value"},
        known={"known": "value"},
        include_current=current,
        index="n",
        running={"total": "value"},
        slices=slices,
    )
    w = Window.partitionBy("key").orderBy(F.col("at").asc_nulls_first(), "id")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if current else -1)
    want = marks.withColumns(
        {
            "next_at": F.lead("at").over(w),
            "next_value": F.lead("value").over(w),
            "known": F.last("value", ignorenulls=True).over(upto),
            "n": F.row_number().over(w).cast("bigint"),
            "total": F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    names = ["id", "next_at", "next_value", "known", "n", "total"]
    assert rows(got, *names) == rows(want, *names)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_key_in_one_instant_spreads_evenly(spark):
    """All rows of one key at one time, a part of them at no time at all; ids alone tell them apart."""
    at = F.when(F.col("id") % 5 > 0, F.lit(dt.datetime(2024, 1, 1)))
    data = spark.range(200_000).select("id", F.lit("k").alias("key"), at.cast("timestamp_ntz").alias("at"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("value"))
    slices = ordered.slices_needed(data, ["key"], 10_000)
    sliced = ordered.range_slices(data, ["key"], ["at", "id"], slices)
    sizes = [r["count"] for r in sliced.groupBy("__slice").count().collect()]
    assert slices == 20 and len(sizes) == 20 and sum(sizes) == 200_000 and max(sizes) < 2 * 10_000
    asked = dict(following={"next": "id"}, known={"last": "value"}, index="n", running={"sum": "id"})
    got = ordered.carry(data, ["key"], ["at", "id"], **asked, slices=slices)
    want = ordered.carry(data, ["key"], ["at", "id"], **asked)
    names = ["id", "next", "last", "n", "sum"]
    assert got.select(names).exceptAll(want.select(names)).isEmpty() and got.count() == 200_000
    # Slices are read where they were written: no shuffle, no list of keys, one summary row or two per slice.
    plan = plan_of(got)
    assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("slices", [2, 7, 50])
def test_keys_over_many_slices_and_slices_of_many_keys(spark, slices):
    """Keys of every size, NULL keys and NULL places among them."""
    rng = random.Random(slices)
    data, n = [], 0
    for key, size in [(None, 90), ("a", 1), ("b", 300), ("c", 2), ("d", 2), ("e", 150), *[(f"k{i}", 3) for i in range(40)]]:
        for _ in range(size):
            data.append((n, key, None if rng.random() < 0.1 else rng.randrange(5), None if rng.random() < 0.9 else n))
            n += 1
    rng.shuffle(data)
    df = spark.createDataFrame(data, "id int, key string, at int, value int").repartition(5)
    asked = dict(following={"next": "id"}, known={"last": "value"}, index="n", running={"sum": "value"})
    for current in (True, False):
        got = ordered.carry(df, ["key"], ["at", "id"], **asked, include_current=current, slices=slices)
        want = ordered.carry(df, ["key"], ["at", "id"], **asked, include_current=current)
        assert rows(got, "id", "next", "last", "n", "sum") == rows(want, "id", "next", "last", "n", "sum")
    empty = ordered.carry(df.limit(0), ["key"], ["at", "id"], **asked, slices=slices)
    assert empty.collect() == []


def test_facts_of_one_instant_are_cut(spark):
    noon = dt.datetime(2024, 1, 1, 12)
    facts = spark.range(5000).select("id", F.lit("k").alias("key"), F.lit(noon).cast("timestamp_ntz").alias("at"))
    history = spark.createDataFrame([("k", noon, None, 1)], "key string, s timestamp_ntz, e timestamp_ntz, v int")
    slices = ordered.slices_needed(facts, ["key"], 500)
    got = intervals.join_asof(facts, history, ["key"], "at", "s", "e", {"v": "v"}, slices)
    assert got.groupBy("v").count().collect()[0][:] == (1, 5000)


def test_an_order_is_required(marks):
    with pytest.raises(ValueError):
        ordered.carry(marks, ["key"], [], index="n")
    with pytest.raises(ValueError):
        ordered.first_per_key(marks, ["key"], [])


@pytest.mark.parametrize("hot_rows", [10**9, 100])
def test_asof_equals_range_join(spark, marks, hot_rows):
    starts = marks.filter("id % 5 = 0 AND at IS NOT NULL").select("key", F.col("at").alias("start"), F.col("id").alias("span"))
    starts = starts.groupBy("key", "start").agg(F.min("span").alias("span"))
    history = intervals.lead_intervals(starts, ["key"], "start", ["span"], "end")
    # Every third interval ends early, so that there are gaps.
    history = history.withColumn("end", F.when(F.col("span") % 3 == 0, F.least("end", F.col("start") + F.expr("interval 2 hours"))).otherwise(F.col("end")))
    facts = marks.filter("id % 5 <> 0").select("id", "key", "at")
    slices = ordered.slices_needed(marks, ["key"], hot_rows)
    got = intervals.join_asof(facts, history, ["key"], "at", "start", "end", {"span": "span", "begun": "start"}, slices)
    f, h = facts.alias("f"), history.alias("h")
    inside = (F.col("f.key") == F.col("h.key")) & (F.col("at") >= F.col("start")) & (F.col("end").isNull() | (F.col("at") < F.col("end")))
    want = f.join(h, inside, "left").select("id", "span", F.col("start").alias("begun"))
    assert rows(got, "id", "span", "begun") == rows(want, "id", "span", "begun")


def test_asof_before_on_and_after_the_bounds(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    history = spark.createDataFrame([(1, day(5), day(10), "x"), (1, day(10), day(12), "y")], "k int, s timestamp_ntz, e timestamp_ntz, v string")
    facts = spark.createDataFrame([(1, day(n)) for n in (4, 5, 9, 10, 11, 12)] + [(2, day(6))], "k int, t timestamp_ntz")
    got = intervals.join_asof(facts, history, ["k"], "t", "s", "e", {"v": "v"})
    assert [(r[0], r[1].day, r[2]) for r in rows(got, "k", "t", "v")] == [
        (1, 4, None),
        (1, 5, "x"),
        (1, 9, "x"),
        (1, 10, "y"),
        (1, 11, "y"),
        (1, 12, None),
        (2, 6, None),
    ]


def test_intervals_of_a_key_do_not_overlap(marks):
    spans = intervals.lead_intervals(marks.filter("at IS NOT NULL"), ["key"], "at", ["id"], "end")
    w = Window.partitionBy("key").orderBy("at", "id")
    assert spans.withColumn("before", F.lag("end").over(w)).filter("before > at OR end < at").count() == 0


@pytest.mark.parametrize(("count", "left"), [(29, 0), (30, 1), (31, 2)])
def test_rolling_needs_full_windows_and_counts_rows_not_days(spark, count, left):
    # A gap of 100 days in the middle does not shorten a window of rows.
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i + (100 if i > 10 else 0)) for i in range(count)]
    df = spark.createDataFrame([(d, 1) for d in days], "day date, x int")
    got = rows(ordered.rolling_rows(df, "day", {"total": "x"}, 30))
    assert len(got) == left and all(r[2] == 30 for r in got)


@pytest.mark.parametrize("hot_rows", [10**9, 40, 0])
def test_positions_and_order_statistics(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(ordered.counted_positions, "__defaults__", ((), hot_rows))
    monkeypatch.setattr(ordered.value_positions, "__defaults__", ((), hot_rows))
    rng = np.random.default_rng(1)
    # One value is a third of all rows.
    values = np.concatenate([np.full(700, 5.0), np.round(rng.normal(10, 4, 1400), 1)])
    df = spark.createDataFrame([(float(v), "g" if i % 2 else "h") for i, v in enumerate(values)], "v double, g string")
    ordered_values = np.sort(values)
    got = ordered.order_statistic(df, "v", {"first": 0, "k": 50, "hot": 300, "p95": 0.95}).first()
    assert tuple(got) == (ordered_values[0], ordered_values[50], ordered_values[300], ordered_values[int(len(values) * 0.95)])
    by_group = {r["g"]: r["k"] for r in ordered.order_statistic(df, "v", {"k": 10}, ["g"]).collect()}
    assert by_group == {"g": np.sort(values[1::2])[10], "h": np.sort(values[::2])[10]}
    places = ordered.value_positions(df, "v")
    quartiles = ordered.exact_quantiles(places, "v", {"a": 0.25, "b": 0.75}).first()
    assert tuple(quartiles) == pytest.approx(tuple(np.quantile(values, [0.25, 0.75])))


def test_order_statistic_is_not_a_percentile(spark):
    # Of 1,000 values, 5 % is the 51st smallest, not the 50th.
    df = spark.range(1000).selectExpr("cast(id as double) v")
    assert ordered.order_statistic(df, "v", {"low": int(1000 * 0.05), "high": int(1000 * 0.95)}).first()[:] == (50.0, 950.0)


def test_dense_index_has_no_gaps(spark):
    got = ordered.dense_index(spark.range(0, 5000, 3, 7), "id").select("row_index").collect()
    assert sorted(r[0] for r in got) == list(range(1667))


def test_slices_go_with_their_scope(spark):
    """Tables and files of slices are there inside the scope and gone after it, also after an error."""
    data = spark.range(300).select("id", F.lit("k").alias("key"))

    def held():
        return [t.name for t in spark.catalog.listTables() if t.name.startswith("stage_")]

    before = set(held())
    with pytest.raises(RuntimeError), stage_scope(spark):
        sliced = ordered.range_slices(data, ["key"], ["id"], 4)
        path = sliced.inputFiles()[0].rsplit("/", 1)[0]
        assert sliced.count() == 300 and len(set(held()) - before) == 1 and hadoop_exists(spark, path)
        raise RuntimeError("lost")
    assert set(held()) == before and not hadoop_exists(spark, path)
