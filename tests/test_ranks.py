"""Order statistics by narrowing down against sorted values."""

import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradeledger.operators import ranks, stats

ASKED = {"first": 0, "k": 17, "most": 0.95, "beyond": 10**6}


def picked(values):
    """Plain answer: NaN after everything else."""
    found = sorted(values, key=lambda v: (isinstance(v, float) and math.isnan(v), v))
    at = [p if isinstance(p, int) else math.floor(len(found) * p) for p in ASKED.values()]
    return tuple(found[i] if i < len(found) else None for i in at)


def same(one, two):
    return repr(one) == repr(two)


@pytest.mark.parametrize(("fetch", "bins"), [(200_000, 4096), (0, 4096), (10, 256)])
def test_groups_of_doubles(spark, fetch, bins):
    rng = np.random.default_rng(3)
    special = [float("inf"), float("-inf"), float("nan"), float("nan"), 1e308, -1e308, 5e-324, 0.0]
    groups = {
        "even": rng.random(400).tolist(),
        "ties": rng.integers(0, 4, 600).astype(float).tolist(),
        "one": [7.5] * 300,
        "wide": (10.0 ** rng.uniform(-200, 200, 300)).tolist(),
        "odd": special * 4,
        None: [1.0, 2.0, 3.0] * 10,
        "few": [float("nan")],
    }
    data = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("even", None), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(3)
    got = {r["g"]: tuple(r)[1:] for r in ranks.values_at_ranks(df, "v", ASKED, ["g"], fetch=fetch, bins=bins).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert same(got[key], picked(values)), key


@pytest.mark.parametrize("fetch", [200_000, 0])
@pytest.mark.parametrize(
    ("ddl", "values"),
    [
        ("bigint", [2**62 + i % 50 for i in range(300)] + [-(2**62)] * 3),
        ("decimal(20,4)", [Decimal(i * 7 % 300) / 16 for i in range(300)]),
        ("decimal(30,12)", [Decimal(i * 7 % 300).scaleb(-12) + 3 for i in range(300)]),
        ("int", list(range(300))),
        ("float", [float(np.float32(i / 7)) for i in range(300)]),
    ],
)
def test_exact_in_every_kind_of_number(spark, fetch, ddl, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {ddl}").repartition(2)
    found = ranks.values_at_ranks(df, "v", ASKED, fetch=fetch, bins=16)
    assert tuple(found.first()) == picked(values) and found.schema["k"].dataType.simpleString() == ddl


@pytest.mark.parametrize("fetch", [200_000, 5])
def test_weights_and_quantiles(spark, fetch):
    rng = np.random.default_rng(8)
    values = rng.normal(10, 4, 1400).round(1)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    counted = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    want = picked(values.tolist())
    assert tuple(ranks.values_at_ranks(df, "v", ASKED, fetch=fetch, bins=32).first()) == want
    assert tuple(ranks.values_at_ranks(counted, "v", ASKED, weight="n", fetch=fetch, bins=32).first()) == want
    shares = {"a": 0.25, "b": 0.5, "c": 0.999}
    got = ranks.quantiles(counted, "v", shares, weight="n", fetch=fetch, bins=32).first()
    assert tuple(got) == pytest.approx(tuple(np.quantile(values, list(shares.values()))))


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, "a")], "v double, g string")
    assert ranks.values_at_ranks(df, "v", ASKED).collect()[0][:] == (None,) * 4
    assert ranks.values_at_ranks(df, "v", ASKED, ["g"]).collect() == []
    assert ranks.quantiles(df, "v", {"a": 0.5}).collect()[0][:] == (None,)


def test_nothing_is_sorted_as_a_whole(spark):
    """No window and no list of cuts in the plan; rows fetched are few, those of the bins that hold the ranks."""
    df = spark.range(100_000).select((F.col("id") * 37 % 100_003).cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    found = ranks.values_at_ranks(df, "v", {"low": 50, "high": 0.95}, ["g"], fetch=200, bins=64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "percentile" not in plan and "NestedLoop" not in plan
    values = np.arange(100_000) * 37 % 100_003
    want = [(g, float(np.sort(values[g::2])[50]), float(np.sort(values[g::2])[47_500])) for g in (0, 1)]
    assert rows(found, "g", "low", "high") == want


@pytest.mark.parametrize("fetch", [200_000, 0])
def test_draws_are_narrowed_down_to_keys(spark, fetch):
    """The same means whether rows are fetched or counted to the end; drawn rows are picked where they are."""
    df = spark.createDataFrame([(i * 7 - 900, float(i % 83)) for i in range(900)], "id int, v double").repartition(3)
    means = stats.bootstrap_means(df, "id", "v", groups=20, per_group=30, fetch=fetch)
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan
    assert plan.count("Exchange hashpartitioning") == 1, "groups alone are shuffled"
    import hashlib

    order = sorted(((hashlib.md5(str(i * 7 - 900).encode()).hexdigest()[:4], i * 7 - 900, float(i % 83)) for i in range(900)))
    want = []
    for group in range(20):
        drawn = [int(hashlib.md5(f"0-{group * 30 + i}".encode()).hexdigest()[:15], 16) % 900 for i in range(30)]
        want.append((group, pytest.approx(sum(order[d][2] for d in drawn) / 30)))
    assert rows(means, "draw_group", "mean") == want


def test_null_groups_have_a_density_and_are_looked_up(spark):
    data = [(None, float(i)) for i in range(50)] + [("a", float(i) * 2) for i in range(50)]
    df = spark.createDataFrame(data, "style string, price double")
    curve = stats.kernel_density(df, "price", ["style"])
    found = stats.linear_interpolate(df, "price", curve, ["style"])
    assert found.columns == ["style", "price", "density"] and found.where("density > 0").count() == 100
    one, two = (found.where(c).agg(F.sum("density")).first()[0] for c in ("style is null", "style = 'a'"))
    assert one == pytest.approx(2 * two)
