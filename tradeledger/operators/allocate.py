"""Spread parent amounts over lines, or give them to one line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def allocate_evenly(
    lines: DataFrame, parents: DataFrame, key: str, amounts: Sequence[str], others: Sequence[str] = ()
) -> DataFrame:
    """Spread each parent amount over the lines of its key; shares add up to the amount.

    ``parents`` has one row per key. Lines are counted by key (summed before the shuffle) instead
    of by a window, so the lines of a hot key are not sorted in one task.
    """
    counts = lines.groupBy(key).agg(F.count(F.lit(1)).alias("_lines"))
    shares = parents.join(counts, key).select(
        key, *others, *[(F.col(a).cast("double") / F.col("_lines")).alias(a) for a in amounts]
    )
    return lines.join(shares, key, "left").withColumns({a: F.coalesce(a, F.lit(0.0)) for a in amounts})


def reassign_to_representative(
    df: DataFrame, key: str, order_by: Sequence[str], value: str, eligible: Column
) -> DataFrame:
    """Among eligible lines the first one gets the sign of the value, the rest get 0.

    ``order_by`` must tell the lines of a key apart: equal lines would all count as the first.
    """
    if not order_by:
        raise ValueError("a total order is required")
    line = F.struct(*order_by)
    chosen = df.filter(eligible).groupBy(key).agg(F.min(line).alias("_chosen"))
    credit = F.when(line.eqNullSafe(F.col("_chosen")), F.signum(value)).otherwise(F.lit(0.0))
    return (
        df.join(chosen, key, "left")
        .withColumn(value, F.when(eligible, credit).otherwise(F.col(value)))
        .drop("_chosen")
    )
