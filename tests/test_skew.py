import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from runledger.operators.skew import fits_broadcast, hot_keys, lookup, split_join

LEFT, RIGHT = "k bigint, v bigint", "k bigint, w bigint"
key = st.one_of(st.none(), st.integers(0, 3))


def skewed(spark, n=300):
    """A third of the rows have key 0, some have none."""
    ids = spark.range(n)
    k = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 != 1, F.col("id") % 17)
    return ids.select(k.cast("bigint").alias("k"), F.col("id").alias("v"))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(key, max_size=9), right=st.lists(key, max_size=9), split=st.integers(1, 4),
)
def test_split_join_of_both_sides_is_a_join(spark, left, right, split):
    a = spark.createDataFrame([(k, i) for i, k in enumerate(left)], LEFT)
    b = spark.createDataFrame([(k, i) for i, k in enumerate(right)], RIGHT)
    ours = split_join(a, b, ["k"], by=["v"], split_rows=split, right_by=["w"])
    plain = a.join(b, "k")
    assert ours.columns == plain.columns
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_many_rows_on_the_right_reach_many_partitions(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    few = spark.createDataFrame([(0, 5)], LEFT)
    many = spark.range(1000).select((F.col("id") % 1).alias("k"), F.col("id").alias("w"))
    joined = split_join(few, many, ["k"], by=["v"], split_rows=10, right_by=["w"])
    sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 400


def test_size_check_moves_one_row_per_task(spark, capsys):
    seen = []
    original = DataFrame.first
    try:
        DataFrame.first = lambda self: seen.append(self) or original(self)
        assert fits_broadcast(spark.range(1000))
    finally:
        DataFrame.first = original
    seen[0].explain()
    plan = capsys.readouterr().out
    assert plan.index("SinglePartition") < plan.index("partial_count")
    assert "Limit" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(key, max_size=12), right=st.lists(key, max_size=6),
    split=st.integers(1, 5),
)
def test_split_join_is_a_join(spark, how, left, right, split):
    a = spark.createDataFrame([(k, i) for i, k in enumerate(left)], LEFT)
    b = spark.createDataFrame([(k, i) for i, k in enumerate(right)], RIGHT)
    ours = split_join(a, b, ["k"], by=["v"], how=how, split_rows=split)
    plain = a.join(b, "k", how)
    assert ours.columns == plain.columns
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_hot_keys_and_their_parts(spark):
    found = hot_keys(skewed(spark), ["k"], split_rows=30).collect()
    # 100 multiples of three, and the multiples of 17 among the others with a key.
    n = skewed(spark).where("k = 0").count()
    assert [(r.k, r._parts) for r in found] == [(0, -(-n // 30))]
    assert hot_keys(skewed(spark), ["k"], split_rows=300).count() == 0


def test_rows_of_a_hot_key_reach_many_partitions(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    one_key = spark.range(1000).select((F.col("id") % 1).alias("k"), F.col("id").alias("v"))
    side = spark.createDataFrame([(0, 5)], RIGHT)

    def largest(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    assert largest(one_key.join(side, "k")) == 1000
    assert largest(split_join(one_key, side, ["k"], by=["v"], split_rows=10)) < 400


def test_rows_without_a_key_are_spread(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    no_key = spark.range(1000).select(
        F.when(F.col("id") < 0, F.col("id")).alias("k"), F.col("id").alias("v")
    )
    side = spark.createDataFrame([(1, 5)], RIGHT)
    joined = split_join(no_key, side, ["k"], by=["v"], how="left")
    sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 400


def test_size_check(spark):
    df = spark.range(100).select("id", F.lit("x" * 50).alias("text"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=1000)
    assert fits_broadcast(df.where("id < 0"), max_rows=0)


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_lookup_small_and_large(spark, max_rows):
    left = skewed(spark)
    dim = spark.range(10).select("id", (F.col("id") * 2).alias("w")).withColumnRenamed("id", "k")
    expected = sorted(map(str, left.join(dim, "k", "left").collect()))
    found = lookup(left, dim, "k", by=["v"], max_rows=max_rows, split_rows=20)
    assert sorted(map(str, found.collect())) == expected
