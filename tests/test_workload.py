from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from runledger.operators import workload


def slow_series(x, i_max, j_max):
    total = 0
    for i in range(1, i_max):
        for j in range(1, j_max):
            v = x * i + x * j
            total += ((v ^ 2) + (v ^ 3) + (v ^ 4)) / (i + 1 + j)
    return total


@pytest.mark.parametrize(("i_max", "j_max"), [(1, 500), (2, 2), (5, 9), (20, 40), (40, 20)])
def test_series_equals_the_double_loop(spark, i_max, j_max):
    xs = [*range(-9, 25), 1000]
    df = spark.createDataFrame([(x,) for x in xs], "x int")
    for row in workload.xor_series(df, "x", i_max, j_max).collect():
        assert row.factorial_value == pytest.approx(slow_series(row.x, i_max, j_max), rel=1e-9)


def test_series_of_null_and_as_text(spark):
    df = spark.createDataFrame([(None,), (3,)], "x int")
    rows = workload.xor_series(df, "x", 5, 9, as_text=True).collect()
    assert rows[0].factorial_value is None
    assert float(rows[1].factorial_value) == pytest.approx(slow_series(3, 5, 9))


def test_random_columns_repeat_with_the_seed(spark):
    one, two, other = (workload.wide_random(spark, 100, 3, seed=s).collect() for s in (5, 5, 6))
    assert one == two != other
    assert all(0 <= v < 1 for row in one for v in row)
    assert workload.wide_random(spark, 10, 2500).columns[-1] == "rand_col_2499"


def test_filters(spark):
    rows = [(0.4, 1.0), (0.5, 0.5), (0.6, 0.6), (0.7, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert [r.a for r in workload.filter_gt(df, "a", 0.5).collect()] == [0.6, 0.7]
    assert [r.a for r in workload.filter_ne(df, "a", "b").collect()] == [0.4]


@pytest.mark.parametrize("batch", [1, 3, 4096])
def test_self_join_equals_the_join(spark, monkeypatch, batch):
    monkeypatch.setattr(workload, "EXPAND_BATCH", batch)
    values = [1.0] * 7 + [2.0] * 2 + [3.0] + [None] * 4
    df = spark.createDataFrame([(v,) for v in values], "c double")
    joined = df.alias("a").join(df.alias("b"), F.col("a.c") == F.col("b.c")).select("a.c")
    found = workload.self_join_on(df, "c")
    assert sorted(found.collect()) == sorted(joined.collect())
    counts = {r.c: r.pairs for r in workload.self_join_counts(df, "c").collect()}
    assert counts == {1.0: 49, 2.0: 4, 3.0: 1}


def test_pairs_of_a_very_frequent_value(spark):
    """Four billion rows of a value: the pieces add up, none is too large to write."""
    n = 4_000_000_000
    pairs = spark.createDataFrame([(1.0, Decimal(n * n))], "c double, pairs decimal(38,0)")
    pieces = pairs
    for power in (10, 9, 8, 7, 6, 5, 4):
        pieces = workload._cut(pieces, 4096**power).drop("piece")
    found = pieces.agg(F.count("*").alias("n"), F.sum("pairs").alias("s"), F.max("pairs").alias("m"))
    row = found.first()
    assert (row.n, row.s, row.m) == (-(-n * n // 4096**4), n * n, 4096**4)


def test_id_join_keeps_both_sides(spark):
    a = spark.range(5).selectExpr("id AS id1", "id * 2 AS v1")
    b = spark.range(3, 8).selectExpr("id AS id2", "id * 3 AS v2")
    rows = workload.join_on_id(a, b, "id1", "id2").orderBy("id1").collect()
    assert [tuple(r) for r in rows] == [(3, 6, 3, 9), (4, 8, 4, 12)]


def test_sales_amount(spark):
    df = spark.createDataFrame([(3, 2.5)], "Quantity bigint, UnitPrice double")
    assert workload.sales_amount(df).first().SalesAmount == 7.5
