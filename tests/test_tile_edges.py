"""Exact ntile by order statistics against Spark's window form."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import tile_edges as te


def compare(spark, rows, tiles, small):
    df = spark.createDataFrame(rows, "g int, v long, id long")
    edges = te.tile_edges(df, "g", ["v", "id"], tiles, small)
    w = Window.partitionBy("g").orderBy("v", "id")
    got = df.select("*", te.tile_of(F.col("g"), [F.col("v"), F.col("id")], edges).alias("t"), F.ntile(tiles).over(w).alias("want"))
    return got.where("not (t <=> want)").count(), got.count()


@pytest.mark.parametrize("small", [1, 40, 10_000])
def test_equals_the_window_form(spark, small):
    rng = random.Random(1)
    big = (1 << 63) - 1
    values = [0, -1, 5, 5, 5, 1 << 40, (1 << 40) + 1, big, -big - 1, rng.getrandbits(62)]
    rows = [(rng.choice([0, 1, None]), rng.choice(values), i * 7919 - 1000) for i in range(900)]
    rows += [(2, 42, i) for i in range(450)]  # one value in a third of all rows
    rows += [(3, 1, 1), (3, 2, 2)]  # fewer rows than tiles
    assert compare(spark, rows, 5, small) == (0, len(rows))


def test_edge_cases(spark):
    assert te.tile_starts(2, 5) == [1] and te.tile_starts(7, 3) == [3, 5] and te.tile_starts(0, 4) == []
    assert compare(spark, [], 5, 10) == (0, 0)
    assert compare(spark, [(0, 1, 1)], 5, 10) == (0, 1)
    assert compare(spark, [(0, 1, i) for i in range(10)], 1, 2) == (0, 10)
    with pytest.raises(ValueError):
        te.tile_edges(spark.range(1).selectExpr("1 g", "id"), "g", ["id"], 0)


def test_rows_are_not_exchanged(spark):
    """The tile itself is an expression: no shuffle, no sort."""
    df = spark.range(1000).selectExpr("cast(id % 2 as int) g", "id % 10 v", "id")
    edges = te.tile_edges(df, "g", ["v", "id"], 5, 50)
    plan = df.select(te.tile_of(F.col("g"), [F.col("v"), F.col("id")], edges))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
