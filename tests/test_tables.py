import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradeledger.operators import allocate, tables
from tradeledger.plans.rebates import RATE_TIERS


def test_update_takes_one_row_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "y", 2), (1, "x", 1), (3, None, 1)], "k int, w string, rank int")
    got = tables.update_from_join(df, new, ["k"], {"v": "w"}, [F.col("rank")])
    assert rows(got) == [(1, "x"), (2, "b"), (3, None)]


def test_delete_keeps_unknown_rows(spark):
    df = spark.createDataFrame([(1, "ec1"), (2, "bob"), (None, "bob"), (1, None), (None, None), (None, "ec")], "c int, u string")
    got = tables.delete_where(df, F.col("c").isin(1) | F.col("u").startswith("ec"))
    assert rows(got) == [(None, None), (None, "bob"), (2, "bob")]


def test_decode_with_and_without_default(spark):
    df = spark.createDataFrame([("0",), ("9",), (None,)], "c string")
    labels = {"0": "Pending", "1": "Approved"}
    got = df.select("c", tables.decode_codes(F.col("c"), labels).alias("a"), tables.decode_codes(F.col("c"), labels, F.col("c")).alias("b"))
    assert rows(got) == [(None, None, None), ("0", "Pending", "Pending"), ("9", None, "9")]


# Group 17 pays by band; amounts between the bands take the base rate (here 99).
BANDS_17 = [
    (-1.0, 99.0),
    (0.0, 99.0),
    (999.99, 99.0),
    (1000.0, 1.0),
    (1999.99, 1.0),
    (1999.995, 99.0),
    (2000.0, 2.0),
    (2999.99, 2.0),
    (3000.0, 3.0),
    (3000.01, 3.0),
    (3499.99, 3.0),
    (3500.0, 3.5),
]


@pytest.mark.parametrize(
    ("group", "expected"),
    [
        (17, BANDS_17),
        (18, BANDS_17),
        (13, [(-1.0, 0.0), (2999.99, 0.0), (3000.0, 99.0), (3000.01, 2.0)]),
        (22, [(-1.0, 99.0), (0.0, 10.0), (3000.0, 10.0), (3000.01, 15.0)]),
        (5, [(0.0, 99.0), (5000.0, 99.0)]),
    ],
)
def test_rate_bands(spark, group, expected):
    df = spark.createDataFrame([(group, a) for a, _ in expected], "g int, a double")
    got = tables.tiered_rate(df, RATE_TIERS, "g", "a", F.lit(99.0))
    assert rows(got, "a", "rate") == sorted(expected)


def test_full_join_split_equals_full_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (3, "y")], "k int, r string")
    assert rows(tables.full_join_split(left, right, ["k"])) == rows(left.join(right, ["k"], "full"))


def test_left_join_hot_right_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "z"), (3, "y")], "k int, r string")
    assert rows(tables.left_join_hot_right(left, right, ["k"])) == rows(left.join(right, ["k"], "left"))


def test_anti_and_matched_rows_make_up_all(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    some = spark.range(0, 100, 3).withColumnRenamed("id", "k")
    assert df.join(some, "k", "left_semi").count() + tables.delete_from_join(df, some, ["k"]).count() == 50


def test_existence_flag_does_not_multiply_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    assert rows(tables.existence_flag(df, other, ["k"], "f", 1, 0)) == [(1, 1), (2, 0)]


def test_union_padded(spark):
    a = spark.createDataFrame([(1, 5)], "k int, n int")
    b = spark.createDataFrame([(2,)], "k int")
    assert rows(tables.union_padded(a, b, {"n": 0})) == [(1, 5), (2, 0)]


@pytest.mark.parametrize("promos", [[(10.0,)], [(10.0,), (5.0,)], []])
def test_shares_add_up_to_the_promo_amount(spark, promos):
    lines = spark.createDataFrame([(1, n) for n in range(3)] + [(2, 9)], "so int, line int")
    parents = spark.createDataFrame([(1, *p) for p in promos] + [(7, 3.0)], "so int, amount double").groupBy("so").agg(F.sum("amount").alias("amount"))
    got = rows(allocate.allocate_evenly(lines, parents, "so", ["amount"]))
    assert len(got) == 4
    assert sum(r[2] for r in got if r[0] == 1) == pytest.approx(sum(p[0] for p in promos))
    assert [r[2] for r in got if r[0] == 2] == [0.0]


def test_whole_numbers_are_divided_exactly(spark):
    lines = spark.createDataFrame([(1, 1), (1, 2)], "so int, line int")
    parents = spark.createDataFrame([(1, 7)], "so int, amount int")
    assert [r[2] for r in rows(allocate.allocate_evenly(lines, parents, "so", ["amount"]))] == [3.5, 3.5]


def test_one_line_gets_the_whole_coupon(spark):
    df = spark.createDataFrame([(1, 2, -0.5), (1, 1, -0.5), (2, 1, 0.25), (3, 1, 2.0), (4, 1, 0.0)], "so int, line int, q double")
    got = allocate.reassign_to_representative(df, "so", ["line"], "q", 1 - F.abs("q") > 0)
    assert rows(got, "so", "line", "q") == [(1, 1, -1.0), (1, 2, 0.0), (2, 1, 1.0), (3, 1, 2.0), (4, 1, 0.0)]
    with pytest.raises(ValueError):
        allocate.reassign_to_representative(df, "so", [], "q", F.lit(True))
