"""Replacement chains: follow source -> target edges to the last target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.operators.tables import delete_from_join
from tradeledger.session import cut_lineage

# Relation types (fixed values).
CREDIT, ADMIN, ADJUSTMENT, ADJUSTMENT_CREDIT = 4, 5, 6, 8


def resolve_chain(edges: DataFrame, max_rounds: int = 10) -> DataFrame:
    """Final target of every source: (source, target) -> source, first_target, final_target, hops.

    ``max_rounds`` rounds resolve chains of up to ``max_rounds - 1`` edges; longer chains and
    cycles have a NULL final. With several targets the smallest wins. Each round joins the table
    with itself and doubles the distance covered, so ten rounds take four joins.
    """
    state = edges.groupBy("source").agg(F.min("target").alias("first_target"))
    state = state.select("source", "first_target", F.col("first_target").alias("at"), F.lit(1).alias("hops"))
    reach = 1
    while reach < max_rounds:
        ahead = state.select(
            F.col("source").alias("at"), F.col("at").alias("_at"), F.col("hops").alias("_hops")
        )
        state = cut_lineage(
            state.join(ahead, "at", "left").select(
                "source",
                "first_target",
                F.coalesce("_at", "at").alias("at"),
                (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
            )
        )
        reach *= 2
    # A chain that ends within reach has fewer hops than reach; a cycle always has exactly reach.
    done = F.col("hops") <= max_rounds - 1
    return state.select(
        "source",
        "first_target",
        F.when(done, F.col("at")).alias("final_target"),
        F.when(done, F.col("hops")).alias("hops"),
    )


def chain_first_date(resolved: DataFrame, dates: DataFrame) -> DataFrame:
    """Per final node the earliest date and number of the sources that lead to it.

    ``dates``: source, day.
    """
    return (
        resolved.filter(F.col("final_target").isNotNull())
        .join(dates, "source")
        .groupBy(F.col("final_target").alias("so_number"))
        .agg(F.min("day").alias("first_sale"), F.count(F.lit(1)).alias("adjustments"))
    )


def adjusted_orders(
    relations: DataFrame, resolved: DataFrame, keep_unresolved: bool = False
) -> DataFrame:
    """Orders to drop: admin orders (either side), adjustment credits, all links but the last."""
    kind = F.col("relation_type")
    dropped = F.array_compact(
        F.array(
            F.when(kind == ADMIN, F.col("source")),
            F.when(kind.isin(ADMIN, ADJUSTMENT_CREDIT), F.col("target")),
        )
    )
    links = resolved.filter(F.col("final_target").isNotNull()) if keep_unresolved else resolved
    return relations.select(F.explode(dropped).alias("so_number")).union(links.select("source"))


def remove_adjusted_orders(
    sales: DataFrame, relations: DataFrame, resolved: DataFrame, keep_unresolved: bool = False
) -> DataFrame:
    """Sales without adjusted orders: one anti join for all four kinds of removal."""
    return delete_from_join(sales, adjusted_orders(relations, resolved, keep_unresolved), ["so_number"])
