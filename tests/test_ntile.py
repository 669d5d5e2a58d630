"""Exact distributed ntile vs the window form and the textbook formula."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.ntile import exact_ntile


def expected_tiles(n, k):
    q, r = divmod(n, k)
    out = []
    for tile in range(1, k + 1):
        out += [tile] * (q + 1 if tile <= r else q)
    return out


@pytest.mark.parametrize("n", [1, 3, 5, 7, 23, 200])
def test_small_and_uneven_sizes(spark, n):
    df = spark.createDataFrame([(i, i % 4) for i in range(n)], "id long, v long")
    res = exact_ntile(df, 5, [F.col("v").asc(), F.col("id").asc()], out="tile", partitions=4)
    rows = sorted(res.collect(), key=lambda r: (r.v, r.id))
    assert [r.tile for r in rows] == expected_tiles(n, 5)


def test_heavy_ties_groups_and_direction(spark):
    rng = random.Random(3)
    data = [(i, rng.choice([1] * 7 + [2, 3, 4]) if i % 2 else rng.randint(0, 50), i % 3 == 0) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, v long, g boolean")
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = exact_ntile(df, 5, order, group=F.col("g").cast("int"), out="tile", partitions=8)
    want = df.withColumn("tile", F.ntile(5).over(Window.partitionBy("g").orderBy(*order)))
    assert sorted(map(tuple, got.select("id", "tile").collect())) == sorted(
        map(tuple, want.select("id", "tile").collect())
    )


def test_carry_limits_columns(spark):
    df = spark.createDataFrame([(i, i * 2, "x") for i in range(10)], "id long, v long, s string")
    res = exact_ntile(df.select("id", "v"), 2, [F.col("v").asc(), F.col("id").asc()], out="t", carry=["id"])
    assert res.columns == ["id", "t"]
    assert sorted(r.t for r in res.collect()) == [1] * 5 + [2] * 5


def test_result_does_not_depend_on_partitioning(spark):
    rng = random.Random(11)
    data = [(i, rng.randint(0, 9), i % 4 == 0) for i in range(500)]
    df = spark.createDataFrame(data, "id long, v long, g boolean").repartition(7)
    order = [F.col("v").asc(), F.col("id").asc()]
    results = {
        parts: sorted(map(tuple, exact_ntile(df, 5, order, group=F.col("g").cast("int"), out="t",
                                             partitions=parts).select("id", "t").collect()))
        for parts in (1, 3, 50)
    }
    assert results[1] == results[3] == results[50]
