"""Sinks and reuse of intermediate results."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.functions.dates import local_day_bounds
from tradeledger.operators.tables import union_tagged
from tradeledger.session import cut_lineage


def materialise_stage(df: DataFrame, how: str = "table") -> DataFrame:
    """Keep a result that is read more than once.

    ``table`` writes it to the shared folder: it survives lost executors and takes no memory.
    ``persist`` keeps it in memory and on local disks and is recomputed where an executor is lost;
    the caller unpersists it.
    """
    if how == "table":
        return cut_lineage(df)
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    raise ValueError(f"unknown kind of stage: {how}")


def sink_ctas(df: DataFrame, name: str, path: str | None = None, replace: bool = False) -> DataFrame:
    """Create a table from a query and return it; an existing one is an error unless it is to be replaced."""
    writer = df.write.mode("overwrite" if replace else "errorifexists").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def sink_incremental_append(
    df: DataFrame,
    path: str,
    utc_time: str,
    as_of: dt.date,
    days: int = 1,
    tz: str = "America/Los_Angeles",
) -> DataFrame:
    """Write the local days before ``as_of``, one partition per day.

    A second run for the same day replaces that day, so nothing is counted twice. The bounds are
    put on the raw UTC column, so they reach the scan.
    """
    start, end = local_day_bounds(as_of - dt.timedelta(days=days), as_of, tz)
    day = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(utc_time)))
    (
        df.filter((F.col(utc_time) >= start) & (F.col(utc_time) < end))
        .withColumn("local_day", day)
        # Few files per day, and large days split over several tasks.
        .hint("rebalance", F.col("local_day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("local_day")
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def sink_multi_report(reports: dict[str, DataFrame], path: str, file_column: str = "source_file") -> DataFrame:
    """Several result tables per input file, in ``report=/<file>=`` folders, from one write.

    Columns that a report lacks are NULL in its rows.
    """
    tagged = union_tagged(reports, "report")
    even = tagged.hint("rebalance", F.col("report"), F.col(file_column))
    even.write.mode("overwrite").partitionBy("report", file_column).parquet(path)
    # A stated schema keeps file names that look like numbers as text.
    others = [f for f in tagged.schema.fields if f.name != "report"]
    schema = T.StructType([*others, T.StructField("report", T.StringType())])
    return tagged.sparkSession.read.schema(schema).parquet(path)
