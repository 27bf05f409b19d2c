"""Scaling, density, histogram, regression and bootstrap as aggregates and joins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeledger.operators.ordered import order_statistic
from tradeledger.operators.ranks import FETCH, narrow, quantiles, same_groups, summary_of
from tradeledger.session import cut_lineage


# Draws of 16 bytes each: 16 MB.
MAX_BROADCAST_DRAWS = 1_000_000

# Share of its peak below which a kernel is taken for nothing.
KERNEL_END = 1e-12


def zscore(df: DataFrame, value: str, name: str) -> DataFrame:
    """Centre and scale a column over all rows; NULLs are left out of both moments."""
    moments = df.agg(
        F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")).alias("m")
    ).scalar()
    return df.withColumn(name, (F.col(value) - moments["mean"]) / moments["sd"])


def kernel_density(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    points: int = 512,
    bins: int = 512,
    weight: str | None = None,
) -> DataFrame:
    """Gaussian kernel density per group on an even grid.

    Bandwidth ``0.9 * min(sd, IQR / 1.34) * n ** -0.2``, grid three bandwidths beyond the data.
    Equal values are counted first and the counts kept, so the input is read once. They are then
    put in even bins, each value split linearly between its two neighbours. A group's bins are one array
    (``bins`` numbers, whatever the data size), with which the kernel is folded as far as it is above
    ``KERNEL_END`` of its peak; only the finished curve becomes rows.
    ``weight`` says how many rows a row stands for, if values were counted before.
    Output: ``by``, grid_index, grid, density.
    """
    if not by:
        whole = df.withColumn("_all", F.lit(0))
        return kernel_density(whole, value, ["_all"], points, bins, weight).drop("_all")
    number = F.lit(1) if weight is None else F.col(weight)
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"), number.alias("_n"))
    counted = cut_lineage(rows.groupBy(*by, "_x").agg(F.sum("_n").alias("_n")))
    spread = quantiles(counted, "_x", {"_q1": 0.25, "_q3": 0.75}, by, "_n")
    extent = counted.groupBy(*by).agg(
        F.sum("_n").alias("_total"),
        (F.sum(F.col("_x") * F.col("_n")) / F.sum("_n")).alias("_mean"),
        F.min("_x").alias("_min"),
        F.max("_x").alias("_max"),
    )
    squares = F.sum(F.col("_n") * F.pow(F.col("_x") - F.col("_mean"), F.lit(2)))
    moments = (
        same_groups(counted, extent, by)
        .groupBy(*by, "_total", "_min", "_max")
        .agg(F.sqrt(squares / F.nullif(F.col("_total") - 1, F.lit(0))).alias("_sd"))
    )
    iqr = (F.col("_q3") - F.col("_q1")) / 1.34
    narrow = F.least("_sd", iqr)
    # Fallbacks when the spread is zero: sd, then the size of the values, then 1.
    spreads = (narrow, F.col("_sd"), F.abs("_min"))
    width = F.coalesce(*[F.nullif(s, F.lit(0.0)) for s in spreads], F.lit(1.0))
    # One row per group, read by the bins and by the curve.
    shape = cut_lineage(
        same_groups(moments, spread, by)
        .withColumn("_bw", 0.9 * width * F.pow("_total", F.lit(-0.2)))
        .withColumn("_lo", F.col("_min") - 3 * F.col("_bw"))
        .withColumn("_hi", F.col("_max") + 3 * F.col("_bw"))
        .select(*by, "_total", "_bw", "_lo", "_hi")
    )
    place = (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (bins - 1)
    left = F.least(F.floor(place), F.lit(bins - 2))
    binned = (
        same_groups(counted, shape, by)
        .withColumn("_place", place)
        .withColumn("_bin", left)
        .groupBy(*by, "_bin")
        .agg(
            F.sum(F.col("_n") * (F.col("_bin") + 1 - F.col("_place"))).alias("_left"),
            F.sum(F.col("_n") * (F.col("_place") - F.col("_bin"))).alias("_right"),
        )
    )
    # One array of bin weights per group: the left and right shares of its bins, by bin.
    sides = F.array_agg(F.struct(F.col("_bin").cast("int").alias("b"), F.col("_left").alias("l"), F.col("_right").alias("r")))
    weights = binned.groupBy(*by).agg(F.map_from_entries(F.transform(sides, _pair)).alias("_of_bin"))
    met = same_groups(weights, shape, by)

    def weight_of(bin_: Column) -> Column:
        here, before = (F.try_element_at("_of_bin", b) for b in (bin_, bin_ - 1))
        return F.coalesce(here["l"], F.lit(0.0)) + F.coalesce(before["r"], F.lit(0.0))

    span = F.col("_hi") - F.col("_lo")
    step, width = span / (points - 1), span / (bins - 1)
    scale = F.col("_total") * F.col("_bw") * math.sqrt(2 * math.pi)
    # Written, one row per group, so that the array is there when each grid point reads from it.
    folded = cut_lineage(
        met.select(
            *by, "_lo", "_bw", scale.alias("_scale"), width.alias("_width"), step.alias("_step"),
            F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), weight_of).alias("_weights"),
        )
    )
    # Bins at which the kernel is above ``KERNEL_END`` for a grid point: the others add nothing that counts.
    reach = F.col("_bw") * math.sqrt(-2 * math.log(KERNEL_END))

    def density_at(point: Column) -> Column:
        at = F.col("_step") * point
        first = F.greatest(F.ceil((at - reach) / F.col("_width")), F.lit(0)).cast("int")
        last = F.least(F.floor((at + reach) / F.col("_width")), F.lit(bins - 1)).cast("int")

        def add(sum_: Column, bin_: Column) -> Column:
            far = (at - F.col("_width") * bin_) / F.col("_bw")
            return sum_ + F.get("_weights", bin_) * F.exp(far * far * -0.5)

        near = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(near, F.lit(0.0), add) / F.col("_scale")

    curve = folded.withColumn("_curve", F.transform(F.sequence(F.lit(0), F.lit(points - 1)), density_at))
    out = curve.select(*by, "_lo", "_step", F.posexplode("_curve").alias("grid_index", "density"))
    return out.select(*by, "grid_index", (F.col("_lo") + F.col("_step") * F.col("grid_index")).alias("grid"), "density")


def _pair(side: Column) -> Column:
    """A bin number and its shares as an entry of a map."""
    return F.struct(side["b"].alias("key"), F.struct(side["l"].alias("l"), side["r"].alias("r")).alias("value"))


def linear_interpolate(
    df: DataFrame, at: str, curve: DataFrame, by: Sequence[str], name: str = "density"
) -> DataFrame:
    """Piecewise-linear lookup in an evenly spaced curve (grid_index, grid, density).

    The segment number follows from the spacing, so the lookup is an equality join on
    (group, segment), in which NULL is a group like any other. NULL outside the curve.
    """
    curve = cut_lineage(curve)
    ahead = Window.partitionBy(*by).orderBy("grid_index")
    segments = curve.select(
        *by,
        F.col("grid_index").alias("_segment"),
        F.col("grid").alias("_x0"),
        F.col("density").alias("_y0"),
        F.lead("grid").over(ahead).alias("_x1"),
        F.lead("density").over(ahead).alias("_y1"),
    ).filter(F.col("_x1").isNotNull())
    extent = curve.groupBy(*by).agg(
        F.min("grid").alias("_lo"), F.max("grid").alias("_hi"), F.max("grid_index").alias("_last")
    )
    place = F.floor((F.col(at) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("_last"))
    inside = F.col(at).between(F.col("_lo"), F.col("_hi"))
    share = (F.col(at) - F.col("_x0")) / (F.col("_x1") - F.col("_x0"))
    of_group = {k: f"_of_{k}" for k in by}
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by]
    extent, segments = (x.withColumnsRenamed(of_group) for x in (extent, segments.withColumnRenamed("_segment", "_number")))
    located = df.join(extent, same, "left").drop(*of_group.values())
    located = located.withColumn("_segment", F.when(inside, F.least(place, F.col("_last") - 1)))
    found = located.join(segments, [*same, F.col("_segment") == F.col("_number")], "left")
    own = [*of_group.values(), "_segment", "_number", "_lo", "_hi", "_last", "_x0", "_x1", "_y0", "_y1"]
    return found.withColumn(name, F.col("_y0") + (F.col("_y1") - F.col("_y0")) * share).drop(*own)


def range_probability(curve: DataFrame, low: float, high: float, by: Sequence[str]) -> DataFrame:
    """Probability between two values: trapezoids under the density, end segments cut."""
    ahead = Window.partitionBy(*by).orderBy("grid_index")
    x0, y0, x1, y1 = (F.col(c) for c in ("grid", "density", "_x1", "_y1"))
    a, b = F.greatest(x0, F.lit(float(low))), F.least(x1, F.lit(float(high)))

    def height(x: Column) -> Column:
        return y0 + (y1 - y0) * (x - x0) / (x1 - x0)

    area = F.when(a < b, (height(a) + height(b)) / 2 * (b - a)).otherwise(0.0)
    return (
        curve.withColumns({"_x1": F.lead("grid").over(ahead), "_y1": F.lead("density").over(ahead)})
        .filter(F.col("_x1").isNotNull())
        .groupBy(*by)
        .agg(F.sum(area).alias("probability"))
    )


def histogram_density(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """About ``bins`` bins with round limits (steps 1, 2, 5 or 10 times a power of ten).

    Bins are closed on the right, the first on both sides. Output: bin_start, bin_end, count, density.
    """
    extent = df.agg(
        F.struct(
            F.min(value).cast("double").alias("lo"),
            F.max(value).cast("double").alias("hi"),
            F.count(value).alias("n"),
        ).alias("e")
    ).scalar()
    lo, hi = extent["lo"], extent["hi"]
    # A constant column gets one bin of width 1 around its value.
    cell = F.coalesce(F.nullif((hi - lo) / bins, F.lit(0.0)), F.lit(1.0))
    base = F.pow(F.lit(10.0), F.floor(F.log10(cell)))
    # A larger step is taken when the cell is nearer to it; 5 is favoured (fixed values 1.5, 2.75).
    unit = (
        F.when(10 * base - cell < 1.5 * (cell - 5 * base), 10 * base)
        .when(5 * base - cell < 2.75 * (cell - 2 * base), 5 * base)
        .when(2 * base - cell < 1.5 * (cell - base), 2 * base)
        .otherwise(base)
    )
    first = F.floor(lo / unit + 1e-7)
    index = F.greatest(F.ceil(F.col(value) / F.col("_unit")), F.col("_first") + 1)
    return (
        df.filter(F.col(value).isNotNull())
        .select(value, unit.alias("_unit"), first.alias("_first"), extent["n"].alias("_n"))
        .groupBy("_unit", "_n", index.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            ((F.col("_bin") - 1) * F.col("_unit")).alias("bin_start"),
            (F.col("_bin") * F.col("_unit")).alias("bin_end"),
            "count",
            (F.col("count") / (F.col("_n") * F.col("_unit"))).alias("density"),
        )
    )


def ols_simple(df: DataFrame, y: str, x: str) -> DataFrame:
    """Regression of y on x with its summary, from one pass of regression aggregates."""
    both = df.select(F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x"))
    sums = both.agg(
        F.regr_count("y", "x").alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r_squared"),
        F.regr_sxx("y", "x").alias("_sxx"),
        F.regr_syy("y", "x").alias("_syy"),
        F.regr_avgx("y", "x").alias("_mean_x"),
    )
    free = F.col("n") - 2
    error = F.sqrt(F.col("_syy") * (1 - F.col("r_squared")) / F.nullif(free, F.lit(0)))
    slope_error = F.col("residual_error") / F.sqrt("_sxx")
    intercept_error = F.col("residual_error") * F.sqrt(
        1 / F.col("n") + F.col("_mean_x") * F.col("_mean_x") / F.col("_sxx")
    )
    return (
        sums.withColumn("residual_error", error)
        .withColumn("slope_error", slope_error)
        .withColumn("intercept_error", intercept_error)
        .withColumn("slope_t", F.col("slope") / F.col("slope_error"))
        .withColumn("intercept_t", F.col("intercept") / F.col("intercept_error"))
        .withColumn(
            "adjusted_r_squared", 1 - (1 - F.col("r_squared")) * (F.col("n") - 1) / F.nullif(free, F.lit(0))
        )
        .withColumn("f_statistic", F.col("slope_t") * F.col("slope_t"))
        .drop("_sxx", "_syy", "_mean_x")
    )


def ols_terms(df: DataFrame, y: str, x: str) -> DataFrame:
    """Coefficient table: term, estimate, error, t value and p value."""
    rows = df.select(F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x")).dropna()
    fitted = LinearRegression(labelCol="y", solver="normal", standardization=False).fit(
        VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    )
    found = fitted.summary
    estimates = [float(fitted.coefficients[0]), float(fitted.intercept)]
    columns = (estimates, found.coefficientStandardErrors, found.tValues, found.pValues)
    terms = [(name, *map(float, values)) for name, *values in zip(["slope", "intercept"], *columns)]
    schema = "term string, estimate double, error double, t_value double, p_value double"
    return df.sparkSession.createDataFrame(terms, schema)


def drawn_index(draw: Column, n: Column, seed: str) -> Column:
    """Row number of a draw: 60 bits of its md5 modulo n, so every row of any table can be drawn."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}-"), draw.cast("string"))), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint") % F.nullif(n, F.lit(0))


def draws_by_bucket(counts: DataFrame, draws: DataFrame) -> DataFrame:
    """(draw_group, _bucket, _rank): the bucket that a row number falls into and its place there.

    ``counts``: _bucket, _n (at most 65,536 rows); ``draws``: draw_group, row_index. Both are of a size that
    does not grow with the data, so they are put in order together.
    """
    along = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(along), F.lit(0)).cast("bigint")
    starts = counts.select(start.alias("row_index"), F.lit(0).alias("_side"), F.col("_bucket").alias("_from"))
    both = starts.unionByName(draws.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    upto = Window.orderBy("row_index", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.when(F.col("_side") == 0, F.col("row_index"))
    return (
        both.select(
            "draw_group", "_side", "row_index",
            F.last("_from", ignorenulls=True).over(upto).alias("_bucket"),
            F.last(first, ignorenulls=True).over(upto).alias("_first"),
        )
        .where("_side = 1 and _bucket is not null")
        .select("draw_group", "_bucket", (F.col("row_index") - F.col("_first")).alias("_rank"))
    )


def bootstrap_means(
    sample: DataFrame, key: str, value: str, groups: int = 1000, per_group: int = 100, seed: str = "0", fetch: int = FETCH
) -> DataFrame:
    """Mean of each group of draws with replacement.

    Draw ``i`` takes the row that ``drawn_index`` names in the order of (hash bucket, key), so the result does
    not depend on partitioning. ``key`` is a number, unique in the sample. The sample is not put in that order:
    rows are counted per bucket, each draw is narrowed down to the key of its row (``narrow``), and the
    drawn rows are picked by key, where they are.
    """
    kept = sample.filter(F.col(value).isNotNull()).select(F.col(key).alias("_x"), F.col(value).alias("_value"))
    kept = kept.withColumn("_bucket", F.substring(F.md5(F.col("_x").cast("string")), 1, 4))
    rows = kept.select("_bucket", "_x", F.lit(1).cast("bigint").alias("_n"))
    counts = cut_lineage(rows.groupBy("_bucket").agg(F.sum("_n").alias("_n"), *summary_of(rows)))
    n = counts.agg(F.sum("_n").alias("n")).scalar()
    draws = sample.sparkSession.range(groups * per_group).select(
        F.floor(F.col("id") / per_group).alias("draw_group"),
        drawn_index(F.col("id"), n, seed).alias("row_index"),
    )
    placed = cut_lineage(draws_by_bucket(counts, draws))
    asked = placed.select("_bucket", "_rank").distinct().join(counts.drop("_n"), "_bucket")
    found = narrow(rows, cut_lineage(asked.withColumn("_name", F.lit("drawn"))), ["_bucket"], fetch=fetch)
    drawn = cut_lineage(placed.join(found, ["_bucket", "_rank"]).select("draw_group", "_x"))
    # The number of draws is fixed by the arguments, not by the data.
    if groups * per_group <= MAX_BROADCAST_DRAWS:
        drawn = F.broadcast(drawn)
    return kept.select("_x", "_value").join(drawn, "_x").groupBy("draw_group").agg(F.avg("_value").alias("mean"))


def bootstrap_ci(
    sample: DataFrame,
    key: str,
    value: str,
    groups: int = 1000,
    per_group: int = 100,
    low: float = 0.05,
    high: float = 0.95,
    seed: str = "0",
) -> DataFrame:
    """Interval between the order statistics ``int(groups * low)`` and ``int(groups * high)``."""
    means = cut_lineage(bootstrap_means(sample, key, value, groups, per_group, seed))
    return order_statistic(means, "mean", {"low": int(groups * low), "high": int(groups * high)})
