"""Order-dependent operators that stay parallel when one key holds a large part of the rows.

A window over ``partitionBy(key)`` puts a whole key into one task. ``slices_needed`` tells from the rows
of the largest key whether that is too much. If not, one plain window does the work. Otherwise the rows are
dealt by ranges of the whole order (key, then order), from a sample that Spark takes, so that a key
spreads over as many slices as its rows need, also within one instant. Each slice is scanned by
itself, and one summary of its first and last key carries values over its borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.operators.ranks import quantile_of, values_at_ranks
from tradeledger.session import bucketed_stage, cut_lineage

# A key above this many rows is spread over slices of about so many.
HOT_ROWS = 2_000_000

# Columns the operators add for themselves start with two underscores.
_SLICE = "__slice"


def slices_needed(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> int | None:
    """Slices of about ``hot_rows`` rows if some key has more than that, else None.

    Runs one count over the key columns, summed before the shuffle; two numbers come back. Give it the
    base table, not a derived one, so that nothing else has to be computed for it.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    found = counts.agg(F.max("_rows").alias("most"), F.sum("_rows").alias("all")).first()
    if (found["most"] or 0) <= hot_rows:
        return None
    return max(2, -(-found["all"] // max(hot_rows, 1)))


def range_slices(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], slices: int) -> DataFrame:
    """The rows with the number of their slice, written in buckets of it.

    Slices are ranges of (keys, order), NULLs first; rows equal in all of it share a slice. What follows
    by slice needs no further shuffle.
    """
    order = [F.col(c).asc_nulls_first() for c in (*keys, *order_by)]
    ranged = df.repartitionByRange(slices, *order).withColumn(_SLICE, F.spark_partition_id())
    return bucketed_stage(ranged, [_SLICE], slices)


def carry(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    following: dict[str, str] | None = None,
    known: dict[str, str] | None = None,
    include_current: bool = False,
    index: str | None = None,
    running: dict[str, str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Values carried along the rows of a key, all from one shuffle and one sort.

    ``following`` {new: source}: value of the next row (``lead``).
    ``known`` {new: source}: last non-NULL value before the row, or up to it with
    ``include_current`` (``lag ignore nulls``).
    ``index``: row number from 1. ``running`` {new: source}: sum up to and with the row.
    ``order_by`` must be a total order; NULLs come first.
    ``slices``: number of ranges to scan instead of whole keys, see ``slices_needed``.
    """
    if not order_by:
        raise ValueError("a total order is required")
    following, known, running = following or {}, known or {}, running or {}
    order = [F.col(c).asc_nulls_first() for c in order_by]
    upper = Window.currentRow if include_current else -1
    if slices is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        before = window.rowsBetween(Window.unboundedPreceding, upper)
        through = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        new = {name: F.lead(source).over(window) for name, source in following.items()}
        new |= {name: F.last(source, ignorenulls=True).over(before) for name, source in known.items()}
        new |= {name: F.sum(source).over(through) for name, source in running.items()}
        if index:
            new[index] = F.row_number().over(window).cast("bigint")
        return df.withColumns(new)

    # One struct as key: NULL keys equal each other.
    sliced = range_slices(df, keys, order_by, slices).withColumn("__key", F.struct(F.lit(0).alias("_"), *keys))
    window = Window.partitionBy(_SLICE, "__key").orderBy(*order)
    before = window.rowsBetween(Window.unboundedPreceding, upper)
    through = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mark = F.lit(True).alias("_row")
    next_of = F.struct(mark, *[F.col(s).alias(n) for n, s in following.items()])
    inside = sliced.withColumns(
        {
            "__next": F.lead(next_of).over(window),
            "__known": F.struct(mark, *[F.last(s, ignorenulls=True).over(before).alias(n) for n, s in known.items()]),
            "__sums": F.struct(mark, *[F.sum(s).over(through).alias(n) for n, s in running.items()]),
            "__place": F.row_number().over(window),
        }
    )
    carried = _over_borders(sliced, order_by, next_of, known, running)
    both = inside.join(carried, ["__key", _SLICE], "left")
    new = {n: F.coalesce("__next", "__after")[n] for n in following}
    new |= {n: F.coalesce(F.col("__known")[n], F.col("__before")[n]) for n in known}
    new |= {n: _plus(F.col("__sums")[n], F.col("__earlier")[n]) for n in running}
    if index:
        new[index] = (F.col("__place") + F.coalesce("__offset", F.lit(0))).cast("bigint")
    own = ["__next", "__known", "__sums", "__place", "__after", "__before", "__earlier", "__offset", "__key", _SLICE]
    return both.withColumns(new).drop(*own)


def _plus(one: Column, two: Column) -> Column:
    """Sum in which NULL stands for nothing; NULL if both are."""
    return F.coalesce(one + two, one, two)


def _over_borders(
    sliced: DataFrame, order_by: Sequence[str], next_of: Column, known: dict[str, str], running: dict[str, str]
) -> DataFrame:
    """What rows of a slice's first and last key get from other slices: at most two rows per slice, written.

    Only these keys have rows in other slices. Their summaries come from one aggregate per slice, without
    a shuffle, and are carried along the slices of a key.
    """
    place = F.struct(*order_by)
    mark = F.lit(True).alias("_row")
    last = [F.max_by(F.col(s), F.when(F.col(s).isNotNull(), place)).alias(n) for n, s in known.items()]
    per_key = sliced.groupBy(_SLICE, "__key").agg(
        F.struct(
            F.col("__key").alias("key"),
            F.min_by(next_of, place).alias("first"),
            F.struct(mark, *last).alias("last"),
            F.struct(mark, *[F.sum(s).alias(n) for n, s in running.items()]).alias("sums"),
            F.count(F.lit(1)).alias("rows"),
        ).alias("__of")
    )
    ends = per_key.groupBy(_SLICE).agg(F.min_by("__of", "__key").alias("a"), F.max_by("__of", "__key").alias("b"))
    borders = F.when(F.col("a.key") == F.col("b.key"), F.array("a")).otherwise(F.array("a", "b"))
    edges = ends.select(_SLICE, F.explode(borders).alias("__of")).select(_SLICE, F.col("__of.key").alias("__key"), "__of")
    along = Window.partitionBy("__key").orderBy(_SLICE)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    return cut_lineage(
        edges.select(
            "__key",
            _SLICE,
            F.lead("__of.first").over(along).alias("__after"),
            F.struct(
                mark, *[F.last(F.col("__of.last")[n], ignorenulls=True).over(earlier).alias(n) for n in known]
            ).alias("__before"),
            F.struct(mark, *[F.sum(F.col("__of.sums")[n]).over(earlier).alias(n) for n in running]).alias("__earlier"),
            F.coalesce(F.sum("__of.rows").over(earlier), F.lit(0)).alias("__offset"),
        )
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: ``row_number() = 1``.

    Spark keeps one row per key before the shuffle (``WindowGroupLimit``), so a hot key is safe.
    """
    if not order_by:
        raise ValueError("a total order is required")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def rolling_rows(
    df: DataFrame, order_by: str, sums: dict[str, str], size: int, by: Sequence[str] = ()
) -> DataFrame:
    """Trailing sums over ``size`` rows, full windows only.

    Input is one row per date (and group), so a window holds no more rows than there are dates.
    """
    ordered = Window.partitionBy(*by).orderBy(F.col(order_by).asc_nulls_first())
    frame = ordered.rowsBetween(1 - size, Window.currentRow)
    out = {new: F.sum(old).over(frame) for new, old in sums.items()}
    return (
        df.withColumns({**out, "_place": F.row_number().over(ordered)})
        .filter(F.col("_place") >= size)
        .drop("_place")
    )


def value_positions(
    df: DataFrame, value: str, by: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Distinct values with the range of sorted positions each one covers.

    Output: ``by``, value, ``first_position`` (0-based), ``end_position`` (exclusive) and
    ``total``. Equal values are counted before the shuffle and the counts are kept, so the input is
    read once.
    """
    counted = cut_lineage(
        df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted_positions(counted, value, by, hot_rows)


def counted_positions(
    counted: DataFrame, value: str, by: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``value_positions`` of materialised (by, value, _n) rows: a running sum, over slices of a large group."""
    slices = slices_needed(counted, by, hot_rows)
    placed = carry(counted, by, [value], running={"end_position": "_n"}, slices=slices)
    placed = placed.withColumn("first_position", F.col("end_position") - F.col("_n")).drop("_n")
    totals = counted.groupBy(*by).agg(F.sum("_n").alias("total")).withColumnsRenamed({k: f"_of_{k}" for k in by})
    # NULL is a group like any other.
    same = F.lit(True)
    for key in by:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    found = placed.join(totals, same) if by else placed.withColumn("total", totals.scalar())
    return found.select(*by, value, "first_position", "end_position", "total")


def order_statistic(
    df: DataFrame, value: str, positions: dict[str, int | float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact k-th smallest values: a position is a 0-based index, or a share of the row count (float).

    Numbers are narrowed down by rank (``values_at_ranks``); other values are put in their positions.
    """
    if isinstance(df.schema[value].dataType, T.NumericType):
        return values_at_ranks(df, value, positions, by)
    places = value_positions(df, value, by)

    def pick(position: int | float) -> Column:
        index = F.floor(F.col("total") * position) if isinstance(position, float) else F.lit(position)
        hit = (F.col("first_position") <= index) & (index < F.col("end_position"))
        return F.max(F.when(hit, F.col(value)))

    picks = [pick(p).alias(name) for name, p in positions.items()]
    return places.groupBy(*by).agg(*picks) if by else places.agg(*picks)


def exact_quantiles(places: DataFrame, value: str, shares: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of positioned values, interpolated between neighbours of place ``share * (n - 1)``."""

    def pick(share: float) -> Column:
        place = (F.col("total") - 1) * F.lit(share)

        def at(index: Column) -> Column:
            hit = (F.col("first_position") <= index) & (index < F.col("end_position"))
            return F.max(F.when(hit, F.col(value).cast("double")))

        return quantile_of(at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place)))

    picks = [pick(s).alias(name) for name, s in shares.items()]
    return places.groupBy(*by).agg(*picks) if by else places.agg(*picks)


def dense_index(df: DataFrame, key: str, name: str = "row_index") -> DataFrame:
    """0-based gap-free index by (hash, key) without a global sort; ``key`` must be unique.

    Rows are spread over 65,536 hash buckets; only the bucket counts are summed up in one place.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(key).cast("string")), 1, 4))
    along = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_inside", inside)
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_inside") - 1)
        .drop("_bucket", "_inside", "_offset")
    )
