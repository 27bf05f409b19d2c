"""Validity intervals: build them, look facts up in them, expand them to days or months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.operators.ordered import carry, first_per_key


def lead_intervals(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    tie: Sequence[str] = (),
    end: str = "end_date",
    slices: int | None = None,
) -> DataFrame:
    """Half-open validity: a row ends where the next one of its key starts."""
    return carry(df, keys, [start, *tie], following={end: start}, slices=slices)


def join_asof(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    columns: dict[str, str],
    slices: int | None = None,
) -> DataFrame:
    """Each fact with the interval ``[start, end)`` valid at its time, or NULLs.

    Intervals of one key must not overlap. Facts and interval starts are stacked and the last
    start is carried forward, so work grows with rows, not with facts x intervals of a key.
    ``end`` NULL means still open. ``slices`` is set where a key has very many facts (``slices_needed``);
    facts of one instant are told apart by a hash, so that they spread as well.
    """
    hashed = [f.name for f in facts.schema.fields if isinstance(f.dataType, T.AtomicType)]
    payload = F.struct(F.col(end).cast("timestamp_ntz").alias("_end"), *[F.col(s).alias(n) for n, s in columns.items()])
    not_null = F.lit(True)
    for key in keys:
        not_null = not_null & F.col(key).isNotNull()
    starts = history.filter(not_null & F.col(start).isNotNull()).select(
        *keys,
        F.col(start).cast("timestamp_ntz").alias("_at"),
        F.lit(0).alias("_side"),
        F.lit(0).cast("bigint").alias("_tie"),
        payload.alias("_valid"),
    )
    marks = facts.select(
        *keys,
        F.col(at).cast("timestamp_ntz").alias("_at"),
        F.lit(1).alias("_side"),
        F.xxhash64(*hashed).alias("_tie"),
        F.struct(*[F.col(c) for c in facts.columns if c not in keys]).alias("_fact"),
    )
    stacked = starts.unionByName(marks, allowMissingColumns=True)
    carried = carry(
        stacked, keys, ["_at", "_side", "_tie"], known={"_found": "_valid"}, slices=slices
    )
    valid = F.col("_found._end").isNull() | (F.col("_at") < F.col("_found._end"))
    return carried.filter("_side = 1").select(
        *keys, "_fact.*", *[F.when(valid, F.col(f"_found.{n}")).alias(n) for n in columns]
    )


def expand_days(df: DataFrame, first: Column, last: Column, name: str = "active_date") -> DataFrame:
    """One row per day of the closed range; an empty range gives no row."""
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    return df.withColumn(name, F.explode(days))


def expand_months(df: DataFrame, first: Column, last: Column, name: str = "month_start") -> DataFrame:
    """One row per calendar month touched by the closed range; none for an empty range."""
    months = F.when(
        first <= last,
        F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")),
    )
    return df.withColumn(name, F.explode(months))


def latest_per_period(
    df: DataFrame, keys: Sequence[str], start: str, tie: Sequence[str] = ()
) -> DataFrame:
    """The row with the latest start per key (and period); NULL starts lose."""
    order = [F.col(start).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie]]
    return first_per_key(df, keys, order)
