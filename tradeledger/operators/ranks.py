"""Exact order statistics by narrowing down to a rank, without sorting a group.

A round counts the rows of each group in a histogram (by powers of two for doubles, then in even bins between the
least and the greatest value) and keeps, for every wanted rank, the bin that holds it; the next round does
the same inside these bins. Rows stay where
they are, only counts are shuffled. Once the bins together hold few rows, these are fetched and the
ranks read off. Rows that equal each other end a search at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.session import cut_lineage

#: Bins of a histogram, and of all histograms of a round together.
BINS, CELLS = 4096, 4_000_000

#: Rows of all open bins that are fetched instead of counted again.
FETCH = 200_000

# Rows of a group are told apart by a few hash values, so that bounds meet a large group in several tasks. With
# very many cells, each of them is small.
_SALTS, _SALTED_CELLS = 16, 10_000


def values_at_ranks(
    df: DataFrame,
    value: str,
    positions: dict[str, int | float],
    by: Sequence[str] = (),
    weight: str | None = None,
    fetch: int = FETCH,
    bins: int = BINS,
) -> DataFrame:
    """The value at each position of its group: a 0-based index, or a share of the row count (float).

    Output: ``by`` and one column per position, NULL beyond the group's rows. ``value`` is a number; NULLs
    are left out, NaN is the greatest. A NULL group is a group. ``weight`` says how many rows a row stands for.
    """

    def rank(position: int | float) -> Callable[[Column], Column]:
        if isinstance(position, float):
            return lambda total: F.floor(total * position).cast("bigint")
        return lambda total: F.lit(position).cast("bigint")

    found = _ranked(df, value, {n: rank(p) for n, p in positions.items()}, by, weight, fetch, bins)
    return found.drop("_total")


def quantiles(
    df: DataFrame,
    value: str,
    shares: dict[str, float],
    by: Sequence[str] = (),
    weight: str | None = None,
    fetch: int = FETCH,
    bins: int = BINS,
) -> DataFrame:
    """Quantiles of each group, interpolated between neighbours of place ``share * (n - 1)``."""
    ranks: dict[str, Callable[[Column], Column]] = {}
    for i, share in enumerate(shares.values()):
        ranks[f"_low{i}"] = lambda total, s=share: F.floor((total - 1) * s).cast("bigint")
        ranks[f"_high{i}"] = lambda total, s=share: F.ceil((total - 1) * s).cast("bigint")
    found = _ranked(df, value, ranks, by, weight, fetch, bins)
    out = []
    for i, (name, share) in enumerate(shares.items()):
        place = (F.col("_total") - 1) * F.lit(share)
        low, high = (F.col(f"{side}{i}").cast("double") for side in ("_low", "_high"))
        out.append(quantile_of(low, high, place - F.floor(place)).alias(name))
    return found.select(*by, *out)


def quantile_of(low: Column, high: Column, share: Column) -> Column:
    return low + (high - low) * share


def _ranked(df, value, ranks, by, weight, fetch, bins) -> DataFrame:
    """``by``, the number of rows (``_total``) and one column per rank, a function of that number."""
    keys = [f"_g{i}" for i in range(len(by))]
    groups = [F.col(c).alias(k) for c, k in zip(by, keys)]
    number = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    rows = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_x"), number.alias("_n"))
    wanted = cut_lineage(_with_totals(rows, keys, ranks))
    inside = (F.col("_rank") >= 0) & (F.col("_rank") < F.col("_total"))
    found = narrow(rows, wanted.where(inside), keys, weight is not None, fetch, bins)
    kind = rows.schema["_x"].dataType
    # The number of rows rides along as a name of its own.
    beside = wanted.where(~inside).select(*keys, "_name", F.lit(None).cast(kind).alias("_x"))
    all_found = found.select(*keys, "_name", "_x").unionByName(beside)
    picks = [F.max(F.when(F.col("_name") == n, F.col("_x"))).alias(n) for n in ranks]
    if not by:
        total = wanted.agg(F.max("_total")).scalar()
        return all_found.agg(*picks).withColumn("_total", total)
    totals = wanted.where(F.col("_name") == next(iter(ranks))).select(*keys, "_total")
    picked = same_groups(all_found.groupBy(*keys).agg(*picks), totals, keys)
    return picked.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "_total", *ranks)


def _with_totals(rows: DataFrame, keys: list[str], ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One row per group and wanted rank, with what is known of the group as a whole."""
    whole = rows.groupBy(*keys).agg(F.sum("_n").alias("_total"), *summary_of(rows))
    if not keys:
        whole = whole.where("_total is not null")
    asked = [F.struct(F.lit(n).alias("_name"), r(F.col("_total")).alias("_rank")) for n, r in ranks.items()]
    return whole.withColumn("_asked", F.explode(F.array(*asked))).select("*", "_asked.*").drop("_asked")


def same_groups(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on the group, in which NULL is a group like any other."""
    renamed = others.withColumnsRenamed({k: f"_of{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys]
    return rows.join(renamed, on).drop(*[f"_of{k}" for k in keys])


def _fractional(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def summary_of(rows: DataFrame) -> list[Column]:
    """Rows of a bin, its least and greatest value, and those among finite numbers."""
    x = F.col("_x")
    finite = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x) if _fractional(rows.schema["_x"].dataType) else x
    return [
        F.count(F.lit(1)).alias("_rows"), F.min(x).alias("_least"), F.max(x).alias("_most"),
        F.min(finite).alias("_lo"), F.max(finite).alias("_hi"),
    ]


def _even_bin(kind: T.DataType, bins: int) -> Column:
    """Number of a row's bin among even ones between ``_lo`` and ``_hi``."""
    x, lo, hi = (F.col(c) for c in ("_x", "_lo", "_hi"))
    if _fractional(kind):  # Halves, so that the span of the largest doubles stays finite.
        x, lo, hi = (c.cast("double") * 0.5 for c in (x, lo, hi))
    elif not isinstance(kind, T.DecimalType):  # Differences of large integers are exact, and do not overflow.
        x, lo, hi = (c.cast("decimal(20,0)") for c in (x, lo, hi))
    share = (x - lo).cast("double") / F.nullif((hi - lo).cast("double"), F.lit(0.0))
    return F.coalesce(F.least(F.floor(share * bins), F.lit(bins - 1)), F.lit(0)).cast("int")


def _scaled_bin(parts: int) -> Column:
    """Number of a row's bin by sign and power of two, each power cut into even parts.

    Doubles may spread over all powers, which even bins would narrow down one by one.
    """
    size = F.abs(F.col("_x").cast("double"))
    power = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1074))
    place = (power + 1100) * parts + F.floor((size / F.pow(F.lit(2.0), power) - 1) * parts)
    return F.when(size == 0, 0).when(F.col("_x") > 0, place).otherwise(-place).cast("int")


def _bin(kind: T.DataType, bins: int, first: bool) -> Column:
    """Number of a row's bin; infinities and NaN have bins of their own."""
    if not _fractional(kind):
        return _even_bin(kind, bins)
    place, raw, end = _scaled_bin(max(1, bins // 64)) if first else _even_bin(kind, bins), F.col("_x"), 2**30
    return F.when(F.isnan(raw), end + 1).when(raw == float("inf"), end).when(raw == float("-inf"), -end).otherwise(place)


def _meet(rows: DataFrame, cells: DataFrame, on: list[str], number: int) -> DataFrame:
    """Rows with the bounds of their cell; there are ``number`` cells."""
    if number > _SALTED_CELLS and on:
        return same_groups(rows, cells, on)
    salt = F.pmod(F.xxhash64("_x"), F.lit(_SALTS)).cast("int")
    several = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return same_groups(rows.withColumn("_salt", salt), several, [*on, "_salt"]).drop("_salt")


def narrow(
    rows: DataFrame, wanted: DataFrame, keys: Sequence[str], weighted: bool = False, fetch: int = FETCH, bins: int = BINS
) -> DataFrame:
    """(keys, _name, _rank, _x): the value at each wanted rank of its group.

    ``rows``: keys, _x (a number), _n (rows it stands for). ``wanted``, written: keys, _name, _rank (0-based, inside
    the group) and the group's ``summary_of``. Ranks may be many; what is kept between rounds is a row for each.
    """
    kind, keys = rows.schema["_x"].dataType, list(keys)
    out = ["_name", "_x"]
    located = rows
    open_ = ~F.col("_least").eqNullSafe(F.col("_most"))
    state, path, done = wanted.withColumn("_at", F.col("_rank")), [], []
    while True:
        ended = state.where(~open_).select(*keys, "_rank", "_name", F.col("_least").alias("_x"))
        done.append(ended)
        state = state.where(open_)
        cells = state.select(*keys, *path, "_lo", "_hi", "_rows").distinct()
        size = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum("_rows").alias("rows")).first()
        if not size["cells"]:
            break
        if size["rows"] <= fetch:
            done.append(_fetched(located, state, keys, path, weighted, size["cells"]).select(*keys, "_rank", *out))
            break
        number = max(2, min(bins, CELLS // size["cells"]))
        level = f"_b{len(path)}"
        located = _meet(located, cells.drop("_rows"), [*keys, *path], size["cells"])
        located = located.withColumn(level, _bin(kind, number, not path)).drop("_lo", "_hi")
        counted = located.groupBy(*keys, *path, level).agg(F.sum("_n").alias("_sum"), *summary_of(rows))
        one = F.struct(level, "_sum", "_rows", "_least", "_most", "_lo", "_hi")
        histogram = counted.groupBy(*keys, *path).agg(F.sort_array(F.collect_list(one)).alias("_bins"))
        state = cut_lineage(_into_bins(state, histogram, keys, path, level, one))
        path.append(level)
    found = done[0].select(*keys, "_rank", *out)
    for part in done[1:]:
        found = found.unionByName(part.select(*keys, "_rank", *out))
    return found


def _into_bins(state: DataFrame, histogram: DataFrame, keys: list[str], path: list[str], level: str, one: Column):
    """Every wanted rank in the bin that holds it, with its place there (``_at``)."""
    asked = state.select(*keys, *path, "_name", "_rank", "_at")
    met = same_groups(asked, histogram, [*keys, *path]) if keys or path else asked.crossJoin(histogram)
    seen = F.lit(0).cast("bigint")
    kind = histogram.schema["_bins"].dataType.elementType
    start = F.struct(seen.alias("seen"), F.lit(None).cast(kind).alias("bin"), seen.alias("before"))

    def step(state: Column, bin_: Column) -> Column:
        here = state["bin"].isNull() & (F.col("_at") < state["seen"] + bin_["_sum"])
        return F.struct(
            (state["seen"] + bin_["_sum"]).alias("seen"),
            F.when(here, bin_).otherwise(state["bin"]).alias("bin"),
            F.when(here, state["seen"]).otherwise(state["before"]).alias("before"),
        )

    chosen = met.withColumn("_of", F.aggregate("_bins", start, step))
    names = [level, "_rows", "_least", "_most", "_lo", "_hi"]
    return chosen.select(
        *keys, *path, "_name", "_rank", (F.col("_at") - F.col("_of.before")).alias("_at"),
        *[F.col(f"_of.bin.{n}").alias(n) for n in names],
    )


def _fetched(
    located: DataFrame, state: DataFrame, keys: list[str], path: list[str], weighted: bool, number: int
) -> DataFrame:
    """Ranks read off the sorted rows of the open bins, of which there are few."""
    if keys or path:
        rows = _meet(located, state.select(*keys, *path).distinct(), [*keys, *path], number)
    else:
        rows = located
    element = F.struct("_x", "_n") if weighted else F.col("_x")
    lists = rows.groupBy(*keys, *path).agg(F.sort_array(F.collect_list(element)).alias("_all"))
    asked = state.select(*keys, *path, "_name", "_rank", "_at")
    met = same_groups(asked, lists, [*keys, *path]) if keys or path else asked.withColumn("_all", lists.scalar())
    if not weighted:
        return met.withColumn("_x", F.get("_all", F.col("_at").cast("int")))
    kind = lists.schema["_all"].dataType.elementType["_x"].dataType
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast(kind).alias("x"))

    def step(state: Column, row: Column) -> Column:
        here = (state["seen"] <= F.col("_at")) & (F.col("_at") < state["seen"] + row["_n"])
        return F.struct((state["seen"] + row["_n"]).alias("seen"), F.when(here, row["_x"]).otherwise(state["x"]).alias("x"))

    return met.withColumn("_x", F.aggregate("_all", start, step)["x"])
