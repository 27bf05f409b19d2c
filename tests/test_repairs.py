"""Rows that were lost or misread: large draws, late and malformed batches, NULL keys, odd headers."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradeledger.operators import stats
from tradeledger.plans.impressions import malformed_batches
from tradeledger.sources import read, write
from tradeledger.streaming.impressions import BATCH_SCHEMA, append_impressions, read_batches


def test_draws_reach_rows_beyond_32_bits(spark):
    n = 10_000_000_000
    drawn = spark.range(2000).select(stats.drawn_index(F.col("id"), F.lit(n), "0").alias("i"))
    low, high, beyond = drawn.agg(F.min("i"), F.max("i"), F.count_if(F.col("i") > 2**32)).first()
    assert 0 <= low < high < n
    assert 900 < beyond < 1400


def test_old_batches_are_kept_and_malformed_ones_rejected(tmp_path, spark):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    good = json.dumps([{"section_name": "Doctors", "listing_id": "1"}, {"section_name": "Doctors", "listing_id": "2"}])
    for day, text in ((20, good), (5, good), (6, good[:-9])):
        arrived = [("Home", "r", dt.datetime(2020, 7, day, 12), "u", text)]
        spark.createDataFrame(arrived, BATCH_SCHEMA).write.mode("append").parquet(source)
        append_impressions(read_batches(spark, source), target, marks).awaitTermination()
    assert sorted(r.local_day.day for r in spark.read.parquet(target).collect()) == [5, 5, 20, 20]
    lost = spark.read.schema(BATCH_SCHEMA).parquet(f"{target}-rejects")
    assert [r.batch_time.day for r in lost.collect()] == [6]
    assert malformed_batches(spark.read.parquet(source)).count() == 1


def test_density_of_null_group_and_without_groups(spark):
    df = spark.createDataFrame([(g, float(v)) for g in ("a", None) for v in range(9)], "g string, v double")
    curves = stats.kernel_density(df, "v", ["g"], points=16)
    assert rows(curves.groupBy("g").count(), "g", "count") == [(None, 16), ("a", 16)]
    assert stats.kernel_density(df, "v", [], points=16).count() == 16


def test_histogram_of_a_constant(spark):
    found = stats.histogram_density(spark.createDataFrame([(2.5,), (2.5,)], "v double"), "v").collect()
    assert [tuple(r) for r in found] == [(2.0, 3.0, 2, 1.0)]


def test_swapped_header_fails_and_header_only_sheet_is_found(tmp_path, spark):
    book = tmp_path / "book"
    book.mkdir()
    (book / "Release.csv").write_text("a,b\n")
    (book / "Zother.csv").write_text("a,b\n1,2\n")
    assert read.scan_file_set(spark, str(tmp_path), ".csv", "a string, b string", "Release", "last").count() == 0
    (book / "Swapped.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read.scan_csv(spark, str(book / "Swapped.csv"), "a string, b string").collect()


def test_table_is_not_replaced(tmp_path, spark):
    write.sink_ctas(spark.range(1), "kept_table", str(tmp_path / "t"))
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        write.sink_ctas(spark.range(2), "kept_table", str(tmp_path / "u"))
    assert spark.table("kept_table").count() == 1
