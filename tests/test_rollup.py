"""Bitmaps that add up, and the reports from the sales rollup."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from test_reports_repeated_orders import frames
from tidewater.operators.bitmaps import bitmaps, consecutive_numbers, set_sizes
from tidewater.plans import reports, rollup
from tidewater.registry import model_graph

SF = "/root/testdata/sf0.001"


def test_consecutive_numbers(spark):
    ids = random.Random(1).sample(range(10**12), 500)
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    got = consecutive_numbers(df, [F.col("k").asc()], partitions=7).collect()
    assert sorted((r.k, r.number) for r in got) == [(k, n) for n, k in enumerate(sorted(ids))]
    assert consecutive_numbers(df.limit(0), [F.col("k")]).count() == 0


def test_sets_add_up(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0, 1, 32767, 32768, 100_000, None, rng.randrange(200_000)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, n long")
    sets = bitmaps(df, ["g"], "n")
    want = {g: len({n for x, n in rows if x == g and n is not None}) for g in ("a", "b", None)}
    assert {r.g: r.n for r in set_sizes(sets, ["g"]).collect()} == want
    assert set_sizes(sets, []).first().n == len({n for _, n in rows if n is not None})


def no_expand(df) -> bool:
    return "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_reports_do_not_expand(spark):
    fct, days, channels = frames(spark)
    assert no_expand(reports.kpi_summary(fct)) and no_expand(reports.channel_revenue(fct, channels))
    r = rollup.sales_rollup(fct)
    assert no_expand(rollup.kpi_summary(r)) and no_expand(rollup.channel_revenue(r, channels))


def test_rollup_with_repeated_orders(spark):
    fct, days, channels = frames(spark)
    r = rollup.sales_rollup(fct)
    assert tuple(rollup.kpi_summary(r).first()) == (2, 4, 150.0, 30.0)
    assert [tuple(x) for x in rollup.channel_revenue(r, channels).collect()] == [("g", "cat", 2, 150.0, 4)]
    assert [tuple(x) for x in rollup.aov_monthly(r, days).collect()] == [(dt.date(2000, 1, 1), 75.0)]
    assert [tuple(x)[1:] for x in rollup.revenue_daily(r, days).collect()] == [(60.0, 1), (90.0, 2)]
    empty = rollup.sales_rollup(fct.limit(0))
    assert tuple(rollup.kpi_summary(empty).first()) == tuple(reports.kpi_summary(fct.limit(0)).first()) == (0, 0, None, None)
    assert rollup.channel_revenue(empty, channels).count() == 0


@pytest.mark.parametrize("name", ["kpi_summary", "revenue_daily", "aov_monthly", "channel_revenue"])
def test_rollup_equals_the_lines(spark, name):
    g = model_graph(spark, SF)
    assert sorted(map(repr, g.rollup_report(name).collect())) == sorted(map(repr, g.report(name).collect()))
