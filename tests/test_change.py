"""Stored tables changed partition by partition."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradeledger.sources import change


@pytest.fixture
def table(tmp_path, spark):
    path = str(tmp_path / "t")
    data = [(i, i % 10, f"p {i % 4}" if i % 4 else None, i // 50) for i in range(200)]
    df = spark.createDataFrame(data, "id int, v int, part string, half int")
    df.repartition(3).write.partitionBy("part", "half").parquet(path)
    return path


def files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def changed_folders(path, before):
    after = files(path)
    gone_or_new = set(before.items()) ^ set(after.items())
    return {os.path.relpath(os.path.dirname(name), path) for name, _ in gone_or_new}


KEYS = ["part", "half"]


def test_update_rewrites_hit_partitions_only(spark, table):
    before = files(table)
    assert change.update_stored(spark, table, KEYS, F.col("id").isin(1, 5, 53), v=F.lit(99)) == 2
    assert changed_folders(table, before) == {"part=p 1/half=0", "part=p 1/half=1"}
    got = rows(spark.read.parquet(table), "id", "v")
    assert got == [(i, 99 if i in (1, 5, 53) else i % 10) for i in range(200)]
    assert change.update_stored(spark, table, KEYS, F.col("id") == -1, v=F.lit(0)) == 0
    with pytest.raises(ValueError, match="stored"):
        change.update_stored(spark, table, KEYS, F.col("id") == 1, Part=F.lit("x"))


def test_update_from_several_matches_is_refused_or_ordered(spark, table):
    before = files(table)
    new = spark.createDataFrame([(4, 70, 2), (4, 71, 1), (103, 72, 1), (999, 1, 1)], "id int, w int, rank int")
    with pytest.raises(ValueError, match="order"):
        change.update_stored_from(spark, table, KEYS, new, ["id"], {"v": "w"})
    assert files(table) == before
    assert change.update_stored_from(spark, table, KEYS, new, ["id"], {"v": "w"}, [F.col("rank")]) == 2
    assert changed_folders(table, before) == {"part=__HIVE_DEFAULT_PARTITION__/half=0", "part=p 3/half=2"}
    got = rows(spark.read.parquet(table), "id", "v")
    assert got == [(i, {4: 71, 103: 72}.get(i, i % 10)) for i in range(200)]


def test_delete_removes_emptied_partitions(spark, table):
    before = files(table)
    assert change.delete_stored(spark, table, KEYS, (F.col("part") == "p 2") & (F.col("half") < 2)) == 2
    assert changed_folders(table, before) == {"part=p 2/half=0", "part=p 2/half=1"}
    assert not os.path.exists(os.path.join(table, "part=p 2", "half=0"))
    one = spark.createDataFrame([(3,), (4,), (7,), (2,)], "id int")
    assert change.delete_stored_from(spark, table, KEYS, one, ["id"]) == 2
    want = [i for i in range(200) if not (i % 4 == 2 and i < 100) and i not in (3, 4, 7)]
    assert [r[0] for r in rows(spark.read.parquet(table), "id")] == want


def test_a_break_before_the_last_step_leaves_the_table(spark, table, monkeypatch):
    before = files(table)

    def broken(df):
        raise RuntimeError("lost")

    monkeypatch.setattr(change, "cut_lineage", broken)
    with pytest.raises(RuntimeError):
        change.delete_stored(spark, table, KEYS, F.col("id") == 1)
    assert files(table) == before
