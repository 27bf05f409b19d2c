"""Price summaries, rolling average price, price density, and price against conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.operators.ordered import rolling_rows
from tradeledger.operators.stats import kernel_density, ols_simple, zscore
from tradeledger.session import cut_lineage


# Styles with a density of their own, and the price range looked at.
STYLES, LOW, HIGH = ("G", "Y", "S"), 50, 400


def ratio(part: Column, whole: Column) -> Column:
    """Division in double; NULL on zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def summary_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("lookups"),
        F.count("sales_qty").alias("transactions"),
        F.coalesce(F.sum("sales_qty"), F.lit(0)).alias("total_qty"),
        F.coalesce(F.sum("sale_price"), F.lit(0)).alias("price_sum"),
        F.coalesce(F.sum(F.col("sale_price") * F.col("sales_qty")), F.lit(0)).alias("revenue"),
    ]


def summary_ratios() -> dict[str, Column]:
    return {
        "conversion": ratio(F.col("transactions"), F.col("lookups")),
        "avg_price": ratio(F.col("price_sum"), F.col("total_qty")),
        "avg_sell_price": ratio(F.col("revenue"), F.col("total_qty")),
    }


def price_summary(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lookups, sales, conversion and average price, over all rows or per group.

    ``price_sum`` adds prices, ``revenue`` adds price x quantity; each has its own average.
    """
    return rows.groupBy(*by).agg(*summary_measures()).withColumns(summary_ratios())


def price_summaries(rows: DataFrame) -> DataFrame:
    """Overall, per pricing plan and per style, from one scan."""
    sets = [[], ["pricing_plan"], ["style"]]
    # The grouping bits: 1 for a column that is not grouped by.
    level = F.when(F.col("_set") == 3, "overall").when(F.col("_set") == 1, "plan").otherwise("style")
    group = F.when(F.col("_set") == 3, "all").when(F.col("_set") == 1, F.col("pricing_plan")).otherwise(F.col("style"))
    return (
        rows.groupingSets(sets, "pricing_plan", "style")
        .agg(F.grouping_id().alias("_set"), *summary_measures())
        .withColumns({"level": level, "group": group, **summary_ratios()})
        .drop("_set", "pricing_plan", "style")
    )


def daily_sales(rows: DataFrame) -> DataFrame:
    """Sums per date over rows where date, quantity and price are all present."""
    return (
        rows.dropna(subset=["priced_on", "sales_qty", "sale_price"])
        .groupBy("priced_on")
        .agg(F.sum("sales_qty").alias("qty"), F.sum("sale_price").alias("price"))
    )


def rolling_average_price(rows: DataFrame, size: int = 30) -> DataFrame:
    """Trailing sums over ``size`` sale dates (rows, not calendar days) and their ratio."""
    rolled = rolling_rows(
        daily_sales(rows), "priced_on", {"rolling_sales": "price", "rolling_qty": "qty"}, size
    )
    return rolled.select(
        "priced_on",
        "rolling_sales",
        "rolling_qty",
        ratio(F.col("rolling_sales"), F.col("rolling_qty")).alias("avg_sell_price"),
    )


def stocked_prices(rows: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """In-stock sale prices strictly between two bounds."""
    price = F.col("sale_price")
    return rows.filter((price > low) & (price < high) & (F.col("in_stock") == 1)).select("style", "sale_price")


def price_density_by_style(
    rows: DataFrame,
    styles: Sequence[str] = STYLES,
    low: float = LOW,
    high: float = HIGH,
    points: int = 512,
) -> DataFrame:
    """Price density of each listed style and of all styles together."""
    counted = stocked_prices(rows, low, high).groupBy("style", "sale_price").agg(F.count(F.lit(1)).alias("n"))
    labels = F.array_compact(F.array(F.lit("all"), F.when(F.col("style").isin(list(styles)), F.col("style"))))
    labelled = counted.select(F.explode(labels).alias("style"), "sale_price", "n")
    return kernel_density(labelled, "sale_price", ["style"], points, weight="n")


def customer_conversion(rows: DataFrame) -> DataFrame:
    """Share of distinct lookups with a sale per customer.

    Lookups of one customer, day, application, warehouse, style and category count once.
    """
    once = rows.groupBy("priced_on", "customer_id", "app_id", "warehouse_id", "style", "category").agg(
        F.coalesce(F.sum("sales_qty"), F.lit(0)).alias("qty")
    )
    return once.groupBy("customer_id").agg(
        ratio(F.sum((F.col("qty") > 0).cast("int")), F.count(F.lit(1))).alias("conversion")
    )


def product_price_scores(rows: DataFrame) -> DataFrame:
    """Mean price per product and style, scaled; a missing price makes the mean NULL.

    The means (one row per product and style) are kept: they are read again for their moments.
    """
    complete = F.count("sale_price") == F.count(F.lit(1))
    mean = F.avg(F.col("sale_price").cast("double"))
    means = rows.filter("sales_qty > 0").groupBy("cuc", "style").agg(F.when(complete, mean).alias("mean_price"))
    return zscore(cut_lineage(means), "mean_price", "price_score")


def customer_price_scores(rows: DataFrame, min_quantity: float = 4) -> DataFrame:
    """Price score of each customer, weighted by the share of each product in its purchases."""
    bought = (
        rows.groupBy("customer_id", "style", "cuc")
        .agg(F.coalesce(F.sum("sales_qty"), F.lit(0)).alias("qty"))
        .filter("qty > 0")
        .join(product_price_scores(rows), ["cuc", "style"])
    )
    weighted = F.col("qty").cast("double") * F.col("price_score")
    complete = F.count("price_score") == F.count(F.lit(1))
    # sum(qty / total * score) = sum(qty * score) / total: one aggregation, no join to the totals.
    return (
        bought.groupBy("customer_id")
        .agg(
            F.when(complete, F.sum(weighted) / F.sum("qty").cast("double")).alias("price_score"),
            F.sum("qty").alias("total_qty"),
        )
        .filter(F.col("total_qty") > min_quantity)
    )


def price_vs_conversion(rows: DataFrame, min_quantity: float = 4) -> DataFrame:
    """Per customer: weighted price score and conversion."""
    return customer_price_scores(rows, min_quantity).join(customer_conversion(rows), "customer_id")


def price_conversion_regression(rows: DataFrame, min_quantity: float = 4) -> DataFrame:
    """Regression of conversion on the price score, with summary."""
    return ols_simple(price_vs_conversion(rows, min_quantity), "conversion", "price_score")
