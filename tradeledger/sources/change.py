"""Changes to a stored table, made partition by partition.

An update or delete finds the partitions that hold rows to change, reads only these, writes their new rows to a
stage, and then puts the stage in their place. Files of other partitions are not touched. A change that breaks
off before the last step leaves the table as it was; made again it ends the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.operators.tables import delete_from_join, delete_where, update_from_join, update_where
from tradeledger.session import cut_lineage, drop_stage


def update_stored(
    spark: SparkSession, path: str, partitions: Sequence[str], condition: Column, **values: Column
) -> int:
    """Set columns where the condition holds; returns the number of partitions rewritten."""
    _no_move(partitions, values)
    hit = _stored(spark, path).where(condition)
    return _rewrite(spark, path, partitions, hit, lambda rows: update_where(rows, condition, **values))


def update_stored_from(
    spark: SparkSession,
    path: str,
    partitions: Sequence[str],
    updates: DataFrame,
    on: Sequence[str],
    values: dict[str, str],
    order_by: Sequence[Column] = (),
) -> int:
    """Set ``{column: update column}`` in rows that have a match; returns the number of partitions rewritten.

    Several updates of one key are refused, unless ``order_by`` says which comes first.
    """
    _no_move(partitions, values)
    if not order_by:
        several = updates.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not several.isEmpty():
            raise ValueError(f"several updates for one {list(on)}: an order is required")
    hit = _stored(spark, path).join(updates.select(*on).distinct(), list(on), "left_semi")
    order = list(order_by) or [F.col(c) for c in on]
    return _rewrite(spark, path, partitions, hit, lambda rows: update_from_join(rows, updates, on, values, order))


def delete_stored(spark: SparkSession, path: str, partitions: Sequence[str], condition: Column) -> int:
    """Remove matching rows; an unknown condition keeps the row. Returns the number of partitions rewritten."""
    hit = _stored(spark, path).where(condition)
    return _rewrite(spark, path, partitions, hit, lambda rows: delete_where(rows, condition))


def delete_stored_from(
    spark: SparkSession, path: str, partitions: Sequence[str], matches: DataFrame, on: Sequence[str]
) -> int:
    """Remove rows that have a match; returns the number of partitions rewritten."""
    hit = _stored(spark, path).join(matches.select(*on).distinct(), list(on), "left_semi")
    return _rewrite(spark, path, partitions, hit, lambda rows: delete_from_join(rows, matches, on))


def _no_move(partitions: Sequence[str], values: dict) -> None:
    moved = {c.lower() for c in values} & {c.lower() for c in partitions}
    if moved:
        raise ValueError(f"{sorted(moved)} say where a row is stored: delete it and append it instead")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now, with the folder of each row's partition."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    return spark.read.parquet(path).withColumn("_folder", folder)


def _rewrite(
    spark: SparkSession,
    path: str,
    partitions: Sequence[str],
    hit: DataFrame,
    change: Callable[[DataFrame], DataFrame],
) -> int:
    # One row per partition comes to the driver.
    found = hit.select(*partitions, "_folder").distinct().collect()
    if not found:
        return 0
    places = {tuple(r[c] for c in partitions) for r in found}
    wanted = reduce(
        lambda a, b: a | b,
        (reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partitions, place))) for place in places),
    )
    table = spark.read.parquet(path)
    stage = cut_lineage(change(table.where(wanted)).select(*table.columns))
    left = {tuple(r) for r in stage.select(*partitions).distinct().collect()}
    (
        stage.hint("rebalance", *[F.col(c) for c in partitions])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    for row in found:
        # A partition without rows is not written, so its old files would stay.
        if tuple(row[c] for c in partitions) not in left:
            _remove_folder(spark, row["_folder"])
    drop_stage(stage)
    return len(places)


def _remove_folder(spark: SparkSession, uri: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
