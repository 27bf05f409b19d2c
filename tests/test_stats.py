import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradeledger.operators import stats


@pytest.fixture(scope="module")
def prices(spark):
    rng = np.random.default_rng(7)
    data = [("G", float(v)) for v in np.round(rng.normal(150, 30, 1500), 2)]
    data += [("Y", float(v)) for v in np.round(rng.gamma(4, 20, 900) + 50, 2)] + [("Y", None)]
    return spark.createDataFrame(data, "style string, price double").cache()


def plain_density(values, points=512):
    values = np.asarray(values)
    q1, q3 = np.quantile(values, [0.25, 0.75])
    bw = 0.9 * min(values.std(ddof=1), (q3 - q1) / 1.34) * len(values) ** -0.2
    grid = np.linspace(values.min() - 3 * bw, values.max() + 3 * bw, points)
    z = (grid[:, None] - values[None, :]) / bw
    return grid, np.exp(-0.5 * z * z).sum(axis=1) / (len(values) * bw * np.sqrt(2 * np.pi))


def test_density_is_close_to_the_unbinned_one_and_integrates_to_one(prices):
    curve = stats.kernel_density(prices, "price", ["style"]).orderBy("grid_index").collect()
    for style in ("G", "Y"):
        grid = np.array([r["grid"] for r in curve if r["style"] == style])
        density = np.array([r["density"] for r in curve if r["style"] == style])
        want = [r["price"] for r in prices.collect() if r["style"] == style and r["price"] is not None]
        plain_grid, plain = plain_density(want)
        assert grid == pytest.approx(plain_grid)
        assert np.abs(density - plain).max() < 0.002 * plain.max()
        assert np.trapezoid(density, grid) == pytest.approx(1, abs=0.01)


def test_density_of_equal_values_has_a_width(spark):
    df = spark.createDataFrame([("a", 10.0)] * 5, "style string, price double")
    curve = stats.kernel_density(df, "price", ["style"])
    assert curve.count() == 512 and curve.agg(F.max("density")).first()[0] > 0


def test_interpolation_and_probability(spark, prices):
    curve = stats.kernel_density(prices, "price", ["style"])
    g = sorted((r["grid"], r["density"]) for r in curve.filter("style = 'G'").collect())
    xs, ys = (list(v) for v in zip(*g))
    asked = [xs[0], xs[-1], 150.0, 99.123, xs[10]]
    df = spark.createDataFrame([("G", float(x)) for x in asked] + [("G", xs[0] - 1), ("G", xs[-1] + 1), ("none", 5.0), ("G", None)], "style string, x double")
    got = {r["x"]: r["density"] for r in stats.linear_interpolate(df, "x", curve, ["style"]).collect()}
    for x in asked:
        assert got[x] == pytest.approx(np.interp(x, xs, ys))
    assert got[xs[0] - 1] is None and got[xs[-1] + 1] is None and got[5.0] is None and got[None] is None
    area = {r["style"]: r["probability"] for r in stats.range_probability(curve, 120, 180, ["style"]).collect()}
    fine = np.linspace(120, 180, 200001)
    assert area["G"] == pytest.approx(np.trapezoid(np.interp(fine, xs, ys), fine), abs=1e-6)
    whole = stats.range_probability(curve, -1e6, 1e6, ["style"]).agg(F.min("probability"), F.max("probability")).first()
    assert whole[0] == pytest.approx(1, abs=0.01) and whole[1] == pytest.approx(1, abs=0.01)


@pytest.mark.parametrize(
    ("values", "step", "bins"),
    [([0, 10, 20, 30], 1, 30), ([50.0, 51.0, 400.0], 10, 30), ([1, 2, 3, 4, 5], 1, 5), ([1000.0, 60000.0, 2000.0], 2000, 30)],
)
def test_histogram_has_round_limits(spark, values, step, bins):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = stats.histogram_density(df, "x", bins).collect()
    assert sum(r["count"] for r in got) == len(values)
    assert sum(r["density"] * (r["bin_end"] - r["bin_start"]) for r in got) == pytest.approx(1)
    assert {round(r["bin_end"] - r["bin_start"], 9) for r in got} == {step}
    # Closed on the right, the smallest value in the first bin.
    for v in values:
        assert any(r["bin_start"] < v <= r["bin_end"] or v == r["bin_start"] == min(values) for r in got)


def test_regression_summary(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, 200)
    y = 0.3 - 0.05 * x + rng.normal(0, 0.02, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (2.0, None)], "x double, y double")
    got = stats.ols_simple(df, "y", "x").first()
    design = np.column_stack([np.ones(200), x])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    left = y - design @ beta
    s2 = left @ left / 198
    errors = np.sqrt(np.diag(s2 * np.linalg.inv(design.T @ design)))
    r2 = 1 - left @ left / ((y - y.mean()) ** 2).sum()
    assert got["n"] == 200
    assert (got["intercept"], got["slope"]) == pytest.approx(tuple(beta))
    assert (got["intercept_error"], got["slope_error"]) == pytest.approx(tuple(errors))
    assert got["slope_t"] == pytest.approx(beta[1] / errors[1])
    assert got["r_squared"] == pytest.approx(r2)
    assert got["adjusted_r_squared"] == pytest.approx(1 - (1 - r2) * 199 / 198)
    assert got["f_statistic"] == pytest.approx(got["slope_t"] ** 2)
    assert got["residual_error"] == pytest.approx(np.sqrt(s2))


def test_coefficient_table(spark):
    # Values of a small published-style example, worked by hand: y = 1 + 2x with residuals -.1, .2, -.1.
    df = spark.createDataFrame([(0.0, 0.9), (1.0, 3.2), (2.0, 4.9), (None, 1.0)], "x double, y double")
    got = {r["term"]: r for r in stats.ols_terms(df, "y", "x").collect()}
    summary = stats.ols_simple(df, "y", "x").first()
    for term in ("slope", "intercept"):
        assert got[term]["estimate"] == pytest.approx(summary[term])
        assert got[term]["error"] == pytest.approx(summary[f"{term}_error"])
        assert got[term]["t_value"] == pytest.approx(summary[f"{term}_t"])
    # With one degree of freedom t is Cauchy distributed.
    t = got["slope"]["t_value"]
    assert got["slope"]["p_value"] == pytest.approx(1 - 2 / np.pi * np.arctan(abs(t)))


def test_counted_values_give_the_same_density(prices):
    counted = prices.groupBy("style", "price").agg(F.count(F.lit(1)).alias("n"))
    one = rows(stats.kernel_density(prices, "price", ["style"]), "style", "grid_index", "density")
    two = rows(stats.kernel_density(counted, "price", ["style"], weight="n"), "style", "grid_index", "density")
    assert [r[2] for r in one] == pytest.approx([r[2] for r in two])


def test_zscore_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    assert [r[1] for r in rows(stats.zscore(df, "x", "z"), "x", "z")] == [None, -1.0, 0.0, 1.0]


def test_bootstrap_repeats_for_one_seed_whatever_the_partitions(spark):
    rng = np.random.default_rng(2)
    data = [(i, float(v)) for i, v in enumerate(rng.geometric(1 / 50, 100))]
    df = spark.createDataFrame(data, "id int, tries double")

    def run(frame, seed="7"):
        return tuple(stats.bootstrap_ci(frame, "id", "tries", seed=seed).first())

    first = run(df.repartition(1))
    assert first == run(df.repartition(8)) == run(df.orderBy("tries"))
    assert first != run(df, "8")
    mean = np.mean([v for _, v in data])
    assert first[0] < mean < first[1]


def test_bootstrap_draws_a_hundred_thousand_by_default(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)], "id int, v double")
    means = stats.bootstrap_means(df, "id", "v")
    assert means.count() == 1000
    values = sorted(r["mean"] for r in means.collect())
    assert tuple(stats.bootstrap_ci(df, "id", "v").first()) == (values[50], values[950])


def test_bootstrap_draws_and_end_points(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "id int, v double")
    means = stats.bootstrap_means(df, "id", "v", groups=50, per_group=20)
    values = sorted(r["mean"] for r in means.collect())
    assert len(values) == 50
    got = stats.bootstrap_ci(df, "id", "v", groups=50, per_group=20).first()
    assert tuple(got) == (values[2], values[47])
