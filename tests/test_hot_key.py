"""A third of all orders and events on one customer: the split operators
must give the same answers as their brute-force forms."""

import dataclasses

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater import ModelGraph, RunParams, from_test_tables
from tidewater.plans import intermediate as im

SF = "/root/testdata/sf0.001"
HOT = 7


@pytest.fixture(scope="module")
def hot_pipe(spark):
    raw = from_test_tables(spark, SF)
    hot = lambda df, idcol: df.withColumn(
        "customer_id", F.when(F.col(idcol) % 3 == 0, F.lit(HOT).cast("long")).otherwise(F.col("customer_id"))
    )
    raw = dataclasses.replace(raw, orders=hot(raw.orders, "order_id"), events=hot(raw.events, "event_id"))
    # tiny target so the hot customer is cut into many buckets
    return ModelGraph(spark, raw, RunParams(asof_target_rows=25, rank_partitions=6))


def test_hot_customer_share(hot_pipe):
    n = hot_pipe.stg_orders.count()
    assert hot_pipe.stg_orders.where(F.col("customer_id") == HOT).count() * 3 >= n - 3


def test_asof_matches_range_join(hot_pipe):
    o = hot_pipe.stg_orders.select("order_id", "customer_id", "order_at")
    e = im.attribution_events(hot_pipe.stg_events)
    w = Window.partitionBy("order_id").orderBy(F.col("event_at").desc(), F.col("event_id").desc())
    brute = (
        o.join(e.select("customer_id", "event_id", "event_at"),
               (o.customer_id == e.customer_id) & (e.event_at < o.order_at), "left")
        .withColumn("rn", F.row_number().over(w)).where("rn = 1")
        .select("order_id", F.col("event_id").alias("attributed_event_id"))
    )
    got = hot_pipe.int_orders_attributed.select("order_id", "attributed_event_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, brute.collect()))


def test_rfm_matches_window_ntile(hot_pipe):
    base = im.rfm_base(hot_pipe.stg_customers, hot_pipe.stg_orders, hot_pipe.stg_order_items, hot_pipe.params)
    cid = F.col("customer_id").asc()

    def tile(col, desc, flag):
        order = F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_last()
        w = Window.partitionBy((F.col(flag) > 0).cast("int")).orderBy(order, cid)
        return F.when(F.col(flag) == 0, F.lit(1)).otherwise(F.ntile(5).over(w))

    brute = base.select(
        "customer_id",
        tile("days_since_last_order", True, "order_count_12m").alias("r"),
        tile("order_count_12m", False, "order_count_12m").alias("f"),
        tile("total_spend_12m", False, "total_spend_12m").alias("m"),
    )
    got = hot_pipe.int_customers_rfm_scored.select("customer_id", "recency_score", "frequency_score", "monetary_score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, brute.collect()))
