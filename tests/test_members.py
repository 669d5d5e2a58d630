"""Ids looked up in a dimension without moving the rows that ask, and facts whose keys are made after the last exchange."""

import pytest
from pyspark.sql import functions as F

from helpers import customer, event, item, order, product, raw
from test_bucketed import line_exchanges
from tidewater import ModelGraph, RunParams, from_test_tables
from tidewater.functions.keys import NULL_SENTINEL
from tidewater.operators.members import with_members

SF = "/root/testdata/sf0.001"
ASKED = [0, 1, 63, 64, 65, -1, -64, -65, 127, 128, 1 << 40, -(1 << 63), (1 << 63) - 1, None, 1]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")  # as with large tables
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("ids", [[], [None], [0, 64, -1], [63, -65, 1 << 40, None, 5], [-(1 << 63), (1 << 63) - 1, -64],
                                 [1, 1, 64, None, None]])
def test_same_rows_as_the_join(spark, ids):
    asking = spark.createDataFrame([(i, k) for i, k in enumerate(ASKED)], "i int, k long")
    known = spark.createDataFrame([(x,) for x in ids], "id long")
    got = with_members(asking, "k", known, "found").collect()
    joined = asking.join(known, F.col("k") == F.col("id"), "left").select("i", "k", F.when(F.col("id").isNotNull(), True).alias("found"))
    assert sorted(map(repr, got)) == sorted(map(repr, joined.collect()))


def test_lines_are_exchanged_once(spark, no_broadcast):
    """Numbering puts the lines where the order join wants them, and no dimension moves them again."""
    g = ModelGraph(spark, from_test_tables(spark, SF), RunParams())
    assert len(line_exchanges(g.fct_orders, "l_linenumber")) == 1


@pytest.mark.parametrize("name, ts", [("fct_orders", "order_at"), ("fct_customer_events", "event_at")])
def test_keys_are_made_after_the_exchange(spark, name, ts):
    g = ModelGraph(spark, from_test_tables(spark, SF), RunParams())
    ranged = g._by_time(name, ts)
    assert sorted(map(repr, ranged.collect())) == sorted(map(repr, g.model(name).collect()))
    above, below = ranged._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert NULL_SENTINEL in above and NULL_SENTINEL not in below


def test_repeated_and_missing_dimension_rows(spark):
    tables = raw(
        spark, customers=[customer(1), customer(1), customer(3)],
        orders=[order(10, 1, "2001-01-01 00:00:00"), order(11, 2, "2001-01-01 00:00:00"), order(12, None, "2001-01-01 00:00:00")],
        items=[item(1, 10, pid=1), item(2, 11, pid=2), item(3, 12, pid=None)],
        products=[product(1), product(1), product(5)],
        events=[event(1, 1, "ad_click", "email", "2000-12-01 00:00:00"), event(2, 9, "ad_click", None, "2000-12-01 00:00:00")],
    )
    g = ModelGraph(spark, tables, RunParams())
    lines = sorted((r.order_item_id, r.customer_key is None, r.product_key is None) for r in g.fct_orders.collect())
    # both rows of customer 1 meet both rows of product 1, as in a join
    assert lines == [(1, False, False)] * 4 + [(2, True, True), (3, True, True)]
    events = sorted((r.event_id, r.customer_key is None) for r in g.fct_customer_events.collect())
    assert events == [(1, False)] * 2 + [(2, True)]
