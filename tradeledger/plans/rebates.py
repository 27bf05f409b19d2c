"""Buying-group rebates: monthly sales, closed periods, tiered rates, transactions and summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.functions.dates import PERIOD_MONTHS, month_start, ntz, period_bounds, year_start
from tradeledger.operators.periods import latest_complete_quarter, period_rollup
from tradeledger.operators.tables import decode_codes, tiered_rate

MEASURES = ["sales", "roy", "ntl", "loc"]

# Fee codes summed into each fee column.
FEE_CODES = {
    "roy": [113, 114, 104, 105, 123, 133, 131, 115, 116, 117],
    "ntl": [110, 156, 124],
    "loc": [111],
}

# Base rates that replace the stored ones, by group name.
RATE_OVERRIDES = {"aasp_ma": 2.0}

# Closing frequency of each group; other groups get no rebate.
GROUP_FREQUENCY = {
    22: "Quarter",
    25: "Quarter",
    7: "Quarter",
    9: "Quarter",
    26: "Quarter",
    20: "Quarter",
    21: "Quarter",
    14: "Quarter",
    8: "Quarter",
    17: "Annual",
    18: "Annual",
    13: "Annual",
    4: "Bi-Monthly",
    3: "Bi-Monthly",
    2: "Monthly",
}

# Group, low, high (inclusive), above, below (exclusive), percent. Amounts in the
# gaps between bands take the group's own rate.
RATE_TIERS = [
    (22, 0.0, 3000.0, None, None, 10.0),
    (22, None, None, 3000.0, None, 15.0),
    (13, None, None, 3000.0, None, 2.0),
    (13, None, None, None, 3000.0, 0.0),
    (17, 1000.0, 1999.99, None, None, 1.0),
    (17, 2000.0, 2999.99, None, None, 2.0),
    (17, 3000.0, 3499.99, None, None, 3.0),
    (17, None, None, 3499.99, None, 3.5),
    (18, 1000.0, 1999.99, None, None, 1.0),
    (18, 2000.0, 2999.99, None, None, 2.0),
    (18, 3000.0, 3499.99, None, None, 3.0),
    (18, None, None, 3499.99, None, 3.5),
]

def order_fees(charges: DataFrame) -> DataFrame:
    """Fee columns per order from coded charges."""

    def fee(codes: list[int]) -> Column:
        return F.sum(F.when(F.col("fee_code").isin(codes), F.col("amount")).otherwise(0))

    return charges.groupBy("so_number").agg(*[fee(codes).alias(n) for n, codes in FEE_CODES.items()])


def active_members(members: DataFrame, customers: DataFrame, status: int = 1) -> DataFrame:
    live = customers.filter(F.col("status") == status)
    return members.filter(F.col("deactivated").isNull()).join(live, "customer_id")


def member_monthly_sales(
    members: DataFrame,
    groups: DataFrame,
    customers: DataFrame,
    orders: DataFrame,
    charges: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Sales and fees per active member and month, from last January to the end of last month."""
    first, end = ntz(year_start(as_of, 1)), ntz(month_start(as_of))
    in_time = orders.filter((F.col("ordered_at") >= first) & (F.col("ordered_at") < end))
    month = F.trunc("ordered_at", "month")
    # Amounts are summed per customer and month before the members are joined.
    totals = (
        in_time.join(order_fees(charges), "so_number", "left")
        .groupBy("customer_id", month.alias("month_start"))
        .agg(
            F.coalesce(F.sum("total"), F.lit(0)).alias("sales"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in FEE_CODES],
        )
    )
    who = (
        active_members(members, customers)
        .groupBy("customer_id", "group_id", "warehouse_id", "company_name")
        .agg(F.max("activated").alias("activated"))
        .join(groups.select("group_id", "group_name"), "group_id", "left")
    )
    return totals.join(who, "customer_id").select(
        "warehouse_id",
        "customer_id",
        "company_name",
        "group_id",
        "group_name",
        "activated",
        F.year("month_start").alias("year"),
        F.quarter("month_start").alias("quarter"),
        F.month("month_start").alias("month"),
        *MEASURES,
    )


def member_period_sales(monthly: DataFrame, as_of: dt.date) -> DataFrame:
    """Sales and fees per member for each closing frequency.

    Every monthly row is marked with the periods it belongs to, so one aggregation gives them all.
    ``monthly`` is also read for its latest complete quarter: pass a materialised stage.
    """
    last, before = month_start(as_of, 1), month_start(as_of, 2)
    quarter = latest_complete_quarter(monthly).scalar()

    def in_month(day: dt.date) -> Column:
        return (F.col("year") == day.year) & (F.col("month") == day.month)

    periods = {
        "Annual": F.col("year") == as_of.year - 1,
        "Quarter": F.struct("year", "quarter") == quarter,
        "Bi-Monthly": in_month(last) | in_month(before),
        "Monthly": in_month(last),
    }
    names = F.array_compact(F.array(*[F.when(test, name) for name, test in periods.items()]))
    marked = monthly.withColumn("frequency", F.explode(names))
    return period_rollup(marked, ["warehouse_id", "customer_id", "group_id"], ["frequency"], MEASURES)


def group_rates(groups: DataFrame, overrides: dict[str, float] = RATE_OVERRIDES) -> DataFrame:
    """Group with closing frequency and base rate; overrides are by group name."""
    pct = F.col("rebate_pct").cast("double")
    if overrides:
        pct = F.coalesce(decode_codes(F.col("group_name"), overrides), pct)
    return groups.select(
        "group_id",
        "group_name",
        pct.alias("rebate_pct"),
        decode_codes(F.col("group_id"), GROUP_FREQUENCY).alias("frequency"),
    ).distinct()


def rebate_rates(
    members: DataFrame,
    groups: DataFrame,
    customers: DataFrame,
    period_sales: DataFrame,
    overrides: dict[str, float] = RATE_OVERRIDES,
) -> DataFrame:
    """Per active member of a rebate group: bases of its closing period and the rate they earn."""
    rates = group_rates(groups, overrides).filter(F.col("frequency").isNotNull())
    who = active_members(members, customers).select(
        "customer_id", "warehouse_id", "company_name", "group_id"
    )
    bases = (
        who.distinct()
        .join(rates, "group_id")
        .join(
            period_sales.select("customer_id", "group_id", "frequency", *MEASURES),
            ["customer_id", "group_id", "frequency"],
            "left",
        )
        .withColumns({m: F.coalesce(m, F.lit(0)) for m in MEASURES})
    )
    return tiered_rate(bases, RATE_TIERS, "group_id", "sales", F.col("rebate_pct"), "new_rebate_pct")


def closed_periods(spark: SparkSession, as_of: dt.date) -> DataFrame:
    """Start and end of the last closed period of every frequency (four literal rows)."""
    day = F.lit(as_of)
    periods = F.array(
        *[
            F.struct(
                F.lit(name).alias("frequency"),
                period_bounds(day, name)[0].alias("period_start"),
                period_bounds(day, name)[1].alias("period_end"),
            )
            for name in PERIOD_MONTHS
        ]
    )
    return spark.range(1).select(F.inline(periods))


def rebate_transactions(
    rates: DataFrame, orders: DataFrame, as_of: dt.date, group_ids: Sequence[int] | None = None
) -> DataFrame:
    """Rebate per order within the member's closed period."""
    chosen = rates if group_ids is None else rates.filter(F.col("group_id").isin(list(group_ids)))
    # Literal rows, so broadcasting is bounded.
    periods = F.broadcast(closed_periods(rates.sparkSession, as_of))
    in_time = orders.filter(
        (F.col("ordered_at") >= ntz(year_start(as_of, 1))) & (F.col("ordered_at") < ntz(month_start(as_of)))
    )
    inside = (F.col("ordered_at") >= F.col("period_start")) & (F.col("ordered_at") < F.col("period_end"))
    return (
        in_time.join(chosen.join(periods, "frequency"), "customer_id")
        .filter(inside)
        .select(
            "customer_id",
            "warehouse_id",
            "group_id",
            "group_name",
            "company_name",
            "new_rebate_pct",
            "so_number",
            F.col("total").alias("so_total"),
            (F.col("total").cast("double") * F.col("new_rebate_pct") / 100).alias("so_rebate"),
            F.to_date("ordered_at").alias("so_date"),
        )
    )


def rebate_summary(rates: DataFrame, group_ids: Sequence[int] | None = None) -> DataFrame:
    """Rebate on sales and on each fee per member."""
    chosen = rates if group_ids is None else rates.filter(F.col("group_id").isin(list(group_ids)))

    def rebate(measure: str) -> Column:
        return F.col(measure).cast("double") * F.col("new_rebate_pct") / 100

    return chosen.select(
        "frequency",
        "group_name",
        "group_id",
        "new_rebate_pct",
        "customer_id",
        "company_name",
        "warehouse_id",
        F.col("sales").alias("total_sales"),
        rebate("sales").alias("rebate"),
        *[rebate(m).alias(f"{m}_rebate") for m in FEE_CODES],
    ).distinct()
