"""Changes to a table expressed as new tables: update, delete, decode, rate, pad."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.operators.ordered import first_per_key


TIER_SCHEMA = "group_id int, low double, high double, above double, below double, pct double"


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Set columns where the condition holds."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def update_from_join(
    df: DataFrame, updates: DataFrame, on: Sequence[str], values: dict[str, str], order_by: Sequence[Column]
) -> DataFrame:
    """Set ``{column: update column}`` from the first matching row by ``order_by``.

    The update side is cut to one row per key first, so rows are never multiplied.
    """
    named = [F.col(source).alias(f"_new_{target}") for target, source in values.items()]
    one = first_per_key(updates, on, order_by).select(*on, F.lit(True).alias("_hit"), *named)
    changed = {t: F.when(F.col("_hit"), F.col(f"_new_{t}")).otherwise(F.col(t)) for t in values}
    return df.join(one, list(on), "left").withColumns(changed).drop("_hit", *[f"_new_{t}" for t in values])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove matching rows; an unknown condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_from_join(df: DataFrame, matches: DataFrame, on: Sequence[str]) -> DataFrame:
    """Remove rows that have a match."""
    return df.join(matches.select(*on), list(on), "left_anti")


def decode_codes(code: Column, labels: dict, default: Column | None = None) -> Column:
    """Map codes to labels; others become ``default`` (NULL if not given)."""
    first, *rest = labels.items()
    chain = F.when(code == F.lit(first[0]), F.lit(first[1]))
    for key, label in rest:
        chain = chain.when(code == F.lit(key), F.lit(label))
    return chain.otherwise(F.lit(None) if default is None else default)


def tiered_rate(
    df: DataFrame, tiers: Sequence[tuple], group: str, amount: str, default: Column, name: str = "rate"
) -> DataFrame:
    """Rate by group and amount band, else the default.

    ``tiers``: (group, low, high, above, below, percent); low and high are inclusive, above and
    below exclusive, None is open. Bands of one group must not overlap. The list is literal, so
    broadcasting it is safe.
    """
    t = df.sparkSession.createDataFrame(list(tiers), TIER_SCHEMA).alias("t")
    value = F.col(f"d.{amount}")
    inside = F.col(f"d.{group}") == F.col("t.group_id")
    for bound, test in (
        ("low", value >= F.col("t.low")),
        ("high", value <= F.col("t.high")),
        ("above", value > F.col("t.above")),
        ("below", value < F.col("t.below")),
    ):
        inside = inside & (F.col(f"t.{bound}").isNull() | test)
    return (
        df.alias("d")
        .join(F.broadcast(t), inside, "left")
        .select("d.*", F.col("t.pct").alias("_tier"))
        .withColumn(name, F.coalesce("_tier", default))
        .drop("_tier")
    )


def measure_switch(selector: Column, measures: dict[str, Column]) -> Column:
    """The measure named by the selector; NULL becomes 0."""
    first, *rest = measures.items()
    chain = F.when(selector == first[0], first[1])
    for key, measure in rest:
        chain = chain.when(selector == key, measure)
    return F.coalesce(chain, F.lit(0))


def union_padded(first: DataFrame, second: DataFrame, fill: dict) -> DataFrame:
    """Stack two tables; columns the second lacks get the fill value there."""
    absent = {c: F.lit(v) for c, v in fill.items() if c not in second.columns}
    return first.unionByName(second.withColumns(absent), allowMissingColumns=True)


def union_tagged(tables: dict[str, DataFrame], tag: str) -> DataFrame:
    """Stack tables with a column that names where each row came from."""
    frames = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def existence_flag(
    df: DataFrame, others: DataFrame, on: Sequence[str], name: str, found=True, absent=False
) -> DataFrame:
    """Flag rows that have a match, without multiplying them."""
    keys = others.select(*on).distinct().withColumn("_hit", F.lit(True))
    flag = F.when(F.col("_hit"), F.lit(found)).otherwise(F.lit(absent))
    return df.join(keys, list(on), "left").withColumn(name, flag).drop("_hit")


def full_join_split(left: DataFrame, right: DataFrame, on: Sequence[str], hot: bool = True) -> DataFrame:
    """Matched, left-only and right-only rows; the keys come from either side.

    ``right`` has one row per key, ``left`` may have very many. A full join cannot split a hot key,
    a left join can; the right-only rows come from an anti join to the distinct keys of ``left``.
    ``hot=False`` tells that the key is too fine to be hot: one full join then reads each side once.
    """
    if not hot:
        return left.join(right, list(on), "full")
    matched = left.join(right, list(on), "left")
    unmatched = right.join(left.select(*on).distinct(), list(on), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def left_join_hot_right(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of one row per key to many: an inner join, whose hot keys can be split, and the rest."""
    matched = left.join(right, list(on))
    unmatched = left.join(right.select(*on).distinct(), list(on), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
