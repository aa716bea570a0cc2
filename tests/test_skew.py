from datetime import datetime

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import skew


@pytest.mark.parametrize(("chunk_rows", "fan_in"), [(1 << 17, 16), (7, 2), (10, 3)])
def test_tree_equals_plain_aggregation(spark, chunk_rows, fan_in):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % 11).cast("int").alias("k"), (F.col("id") * 7 % 13).alias("v"))
    df = df.withColumn("v", F.when(F.col("v") > 0, F.col("v")))
    got = skew.tree_aggregate(df, ["k"], {"n": ("sum", F.lit(1).cast("long")), "s": ("sum", F.col("v")), "a": ("min", F.col("v")), "b": ("max", F.col("v"))}, chunk_rows, fan_in)
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.min("v").alias("a"), F.max("v").alias("b"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rounds():
    assert skew.rounds_for(0) == 1
    assert skew.rounds_for(16 << 17) == 1
    assert skew.rounds_for((256 << 17) + 1) == 3


def test_heavy_keys_and_distinct_counts(spark):
    df = spark.createDataFrame([(1, "a", datetime(2024, 1, 1))] * 90 + [(2, "b", None)] * 5 + [(None, None, None)] * 5, "k int, v string, n_rows timestamp_ntz")
    assert {(r.k, r.n_rows) for r in skew.heavy_keys(df, "k", 0.05).collect()} == {(1, 90), (2, 5), (None, 5)}
    assert {(r.k, r.n_rows) for r in skew.heavy_keys(df, "k", 0.0501).collect()} == {(1, 90)}
    assert {(r.k, r.n) for r in skew.distinct_counts(df, ["k"], "v", "n").collect()} == {(1, 1), (2, 1)}
    assert skew.heavy_keys(df.limit(0), "k", 0.05).collect() == []
