"""Pricing rows without the noise of adjustments, own staff, tests and returns; customers near a warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.geo import great_circle_miles
from tradeledger.operators.chains import ADMIN, chain_first_date
from tradeledger.operators.tables import delete_from_join
from tradeledger.session import cut_lineage

# What counts as noise unless the caller says otherwise.
EXCLUDED_PLANS = ["b1", "b2", "b3", "b4", "f1", "j2", "vp", "p3"]
EXCLUDED_COMPANIES = ["Test"]
RETURN_REASONS = [
    "Cust did not order",
    "Cust refused Delivery",
    "Cust Refused Price",
    "Customer did not need the part",
    "Customer Return / Reason Unknown",
    "Phone mistake",
    "Quality of part Refused",
    "Shop Lost Customer",
]


def contains_any(column: Column, parts: Sequence[str], case_insensitive: bool = True) -> Column:
    """Whether a text contains one of the parts."""
    text = F.lower(column) if case_insensitive else column
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(text, F.lit(part.lower() if case_insensitive else part))
    return found


def pricing_noise_cleanup(
    pricing: DataFrame,
    relations: DataFrame,
    resolved: DataFrame,
    customers: DataFrame,
    pickups: DataFrame,
    pickup_lines: DataFrame,
    reasons: DataFrame,
    excluded_shop_type: str = "Re",
    excluded_plans: Sequence[str] = EXCLUDED_PLANS,
    excluded_users: Sequence[str] = (),
    excluded_companies: Sequence[str] = EXCLUDED_COMPANIES,
    return_reasons: Sequence[str] = RETURN_REASONS,
    keep_unresolved: bool = True,
) -> DataFrame:
    """Price lookups and sales that reflect a customer's decision, with the chain's first date.

    Dropped: replaced orders, one shop type, listed plans, users and companies, admin orders with a
    sale, and lines returned for a listed reason since the first remaining date.
    """
    priced = pricing.select(F.col("so_number").alias("source"), "priced_on").groupBy("source")
    # Written, so that no task sorts all price rows and gathers their orders and chains at once.
    days = cut_lineage(priced.agg(F.min("priced_on").alias("day")))
    chains = resolved.join(days.select("source"), "source", "left_semi")
    first = chain_first_date(chains, days).select(
        "so_number", F.col("first_sale").alias("first_so_date")
    )
    links = chains.filter(F.col("final_target").isNotNull()) if keep_unresolved else chains
    shops = customers.filter(
        (F.col("shop_type") != excluded_shop_type) & ~contains_any(F.col("company_name"), excluded_companies)
    ).select("customer_id")
    wanted = pricing.filter(
        ~F.lower("pricing_plan").isin(list(excluded_plans)) & ~F.lower("quote_user").isin(list(excluded_users))
    )
    kept = (
        wanted.join(shops, "customer_id", "left_semi")
        .join(links.select(F.col("source").alias("so_number")), "so_number", "left_anti")
        .join(first, "so_number", "left")
    )
    admins = relations.filter(F.col("relation_type") == ADMIN).select("source")
    sold_by_admin = (F.col("so_number") == F.col("source")) & (F.col("sales_qty") > 0)
    # Written, as it is both the result and the bound of the returns.
    final = cut_lineage(kept.join(admins, sold_by_admin, "left_anti"))
    start = final.agg(F.min("priced_on")).scalar()
    returned = (
        pickups.filter((F.col("pickup_type") == 9) & (F.coalesce("deleted", F.lit(0)) == 0))
        .filter(F.to_date("created_at") >= start)
        .join(pickup_lines, "pickup_id")
        .join(reasons.filter(F.col("reason_name").isin(list(return_reasons))), "reason_id")
    )
    return delete_from_join(final, returned, ["so_number", "item"])


def pricing_sample(cleaned: DataFrame, category: str, order_by: Sequence[str], rows: int = 100_000) -> DataFrame:
    """The first rows of one category: a capped extract for inspection, with a stated order."""
    return cleaned.filter(F.col("category") == category).orderBy(*order_by).limit(rows)


def customers_within_radius(
    customers: DataFrame,
    warehouses: DataFrame,
    geocodes: DataFrame,
    geocode_status: DataFrame,
    miles: float = 5.0,
    excluded_warehouses: Sequence[int] = (4, 16),
    route_codes: Sequence[str] = ("a", "b", "c", "d"),
    excluded_status: Sequence[str] = ("x", "m", "v"),
    excluded_companies: Sequence[str] = ("800", "Test", "Insurance"),
    excluded_customers: Sequence[int] = (),
    literal: bool = False,
) -> DataFrame:
    """Active customers within some miles of their own warehouse."""
    active = customers.filter(
        ~F.col("warehouse_id").isin(list(excluded_warehouses))
        & F.lower("route_code").isin(list(route_codes))
        & ~F.lower("status").isin(list(excluded_status))
        & ~contains_any(F.col("company_name"), excluded_companies)
        & ~F.col("customer_id").isin(list(excluded_customers))
    )
    located = geocodes.join(geocode_status, "geocode_status_id", "left_semi")
    distance = great_circle_miles(
        F.col("warehouse_latitude"), F.col("warehouse_longitude"), F.col("latitude"), F.col("longitude"), literal
    )
    return (
        active.join(located, "customer_id")
        .join(warehouses, "warehouse_id")
        .withColumn("distance", distance)
        .filter(F.col("distance") <= miles)
    )
