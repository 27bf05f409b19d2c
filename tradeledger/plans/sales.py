"""Category sales with coupons, adjustment clean-up and the sales roll-out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.dates import ntz
from tradeledger.operators.allocate import allocate_evenly, reassign_to_representative
from tradeledger.operators.chains import (
    ADJUSTMENT,
    ADMIN,
    CREDIT,
    chain_first_date,
    remove_adjusted_orders,
    resolve_chain,
)

# The category looked at, the one of coupons, and the start of the history.
CATEGORY, PROMO_CATEGORY, SINCE = "cat_conv", "Promo", "2015-01-01"

# One sales row per order and these columns: the line key used wherever a total order is needed.
LINE_KEY = ["item", "car_id", "jobber_price", "item_cost", "sale_price"]


def category_lines(lines: DataFrame, orders: DataFrame, items: DataFrame, category: str) -> DataFrame:
    """Order lines of one category with header and item attributes."""
    wanted = items.filter(F.col("category") == category)
    return lines.join(wanted, "item").join(orders, "order_id")


def sales_lines(
    lines: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    relations: DataFrame,
    category: str = CATEGORY,
    since: str = SINCE,
) -> DataFrame:
    """Sales per order and line key; was_admin / was_adjust tell whether the order has such a relation."""
    recent = orders.filter(F.col("ordered_at") >= ntz(since))
    sold = (
        category_lines(lines, recent, items, category)
        .groupBy(
            "customer_id",
            F.to_date("ordered_at").alias("sale_date"),
            "cuc",
            "category",
            "so_number",
            "order_id",
            "salesperson",
            "core_type",
            *LINE_KEY,
        )
        .agg(
            F.sum("quantity").alias("quant_sold"),
            F.sum(F.col("quantity") * F.col("sale_price")).alias("ext_sold"),
        )
    )
    flags = (
        relations.filter(F.col("relation_type").isin(ADMIN, ADJUSTMENT))
        .groupBy(F.col("source").alias("so_number"))
        .agg(
            F.max((F.col("relation_type") == ADMIN).cast("int")).alias("was_admin"),
            F.max((F.col("relation_type") == ADJUSTMENT).cast("int")).alias("was_adjust"),
        )
    )
    return sold.join(flags, "so_number", "left").fillna(0, ["was_admin", "was_adjust"])


def order_coupons(
    lines: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    promo_category: str = PROMO_CATEGORY,
    since: str | None = None,
) -> DataFrame:
    """Promo lines per order: coupon code, quantity and amount.

    ``since`` is the bound of the sales the coupons are for, so that older orders are not read.

    A positive amount belongs to a return, so its quantity is made negative.
    """
    recent = orders if since is None else orders.filter(F.col("ordered_at") >= F.lit(since).cast("timestamp_ntz"))
    promo = category_lines(lines, recent, items, promo_category)
    ext = F.col("quantity") * F.col("sale_price")
    quantity = F.when(ext > 0, -F.abs("quantity")).otherwise(F.col("quantity"))
    return promo.groupBy("so_number").agg(
        F.min("cuc").alias("coupon_code"),
        F.sum(quantity).alias("coupon_quant"),
        F.sum(ext).alias("coupon_amount"),
    )


def sales_with_coupons(sold: DataFrame, coupons: DataFrame) -> DataFrame:
    """Sales lines with the order's promo amounts split evenly over its lines.

    ``sold`` is read twice (lines and their count per order): pass a materialised stage.
    """
    return allocate_evenly(sold, coupons, "so_number", ["coupon_quant", "coupon_amount"], ["coupon_code"])


def adjustment_chains(relations: DataFrame, max_rounds: int = 10) -> DataFrame:
    return resolve_chain(relations.filter(F.col("relation_type") == ADJUSTMENT), max_rounds)


def sold_chains(sales: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains that start at a sold order, and the sale date of each such start."""
    days = sales.groupBy(F.col("so_number").alias("source")).agg(F.min("sale_date").alias("day"))
    return resolved.join(days.select("source"), "source", "left_semi"), days


def sales_without_adjustments(
    sales: DataFrame, relations: DataFrame, resolved: DataFrame, keep_unresolved: bool = False
) -> DataFrame:
    """Only final orders: no admin orders, adjustment credits or replaced orders."""
    return remove_adjusted_orders(sales, relations, resolved, keep_unresolved)


def return_reasons(pickups: DataFrame, pickup_lines: DataFrame, reasons: DataFrame, pickup_type: int = 9) -> DataFrame:
    """One return reason per order and item from live pickups; a deleted flag of NULL counts as 0."""
    live = pickups.filter(
        (F.col("pickup_type") == pickup_type) & (F.coalesce("deleted", F.lit(0)) == 0)
    )
    return (
        live.join(pickup_lines, "pickup_id")
        .join(reasons, "reason_id", "left")
        .groupBy("so_number", "item")
        .agg(F.min("reason_name").alias("return_reason"))
    )


def sales_rollout(
    sales: DataFrame,
    final_sales: DataFrame,
    resolved: DataFrame,
    relations: DataFrame,
    reasons: DataFrame,
    calendar: DataFrame,
) -> DataFrame:
    """Final sales dated back to the first order of their chain, with credits, returns and whole coupons.

    ``sales`` are all sales lines (they give the first dates), ``final_sales`` those with coupons left
    after the clean-up, ``calendar`` has day, fiscal_week and fiscal_month.
    """
    chains, days = sold_chains(sales, resolved)
    first = chain_first_date(chains, days)
    credits = (
        relations.filter(F.col("relation_type") == CREDIT)
        .groupBy(F.col("source").alias("so_number"))
        .agg(F.count(F.lit(1)).alias("credit_count"), F.max("related_at").alias("last_credit"))
    )
    weeks = calendar.select(
        F.col("day").alias("first_sale"), F.col("fiscal_week").alias("week_of_first_sale")
    )
    partial = F.coalesce((1 - F.abs("coupon_quant") > 0) & F.col("coupon_code").isNotNull(), F.lit(False))
    whole = reassign_to_representative(final_sales, "so_number", LINE_KEY, "coupon_quant", partial)
    return (
        whole.join(first.join(weeks, "first_sale", "left"), "so_number", "left")
        .join(credits, "so_number", "left")
        .join(reasons, ["so_number", "item"], "left")
        .withColumn("sale_date", F.coalesce("first_sale", "sale_date"))
    )
