"""Monthly rows rolled up to longer periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def period_rollup(
    monthly: DataFrame, keys: Sequence[str], periods: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    return monthly.groupBy(*keys, *periods).agg(*[F.sum(m).alias(m) for m in measures])


def complete_quarters(monthly: DataFrame) -> DataFrame:
    """Quarters of the whole table with all three months present."""
    return (
        monthly.groupBy("year", "quarter")
        .agg(F.countDistinct("month").alias("months"))
        .filter("months = 3")
        .select("year", "quarter")
    )


def latest_complete_quarter(monthly: DataFrame) -> DataFrame:
    """One row: the latest complete quarter as (year, quarter)."""
    return complete_quarters(monthly).agg(F.max(F.struct("year", "quarter")).alias("q"))


def keep_latest_complete_quarter(monthly: DataFrame) -> DataFrame:
    """Rows of the latest complete quarter."""
    return monthly.filter(F.struct("year", "quarter") == latest_complete_quarter(monthly).scalar())
