"""Model semantics on hand-made edge frames (FIXTURES.md section 5)."""

import datetime as dt

import pytest

from helpers import customer, event, item, order, payment, product, raw, ts
from tidewater import ModelGraph, RunParams

PARAMS = RunParams(as_of=dt.datetime(2001, 8, 2), spine_start=dt.date(2000, 1, 1), spine_end=dt.date(2002, 1, 1))


@pytest.fixture(scope="module")
def pipe(spark):
    r = raw(
        spark,
        customers=[
            customer(1, "2001-01-15 00:00:00"),
            customer(2, "2001-01-15 00:00:00"),
            customer(3, "2000-01-01 00:00:00"),            # no order at all
            customer(4, "2000-01-01 00:00:00", deleted=True),
            customer(5, "2001-03-01 00:00:00"),             # orders with zero spend
            customer(6, "2001-03-10 00:00:00"),             # only order on day 31 of its cohort
        ],
        orders=[
            order(10, 1, "2001-02-05 12:00:00"),            # day 35 from cohort month start
            order(11, 1, "2001-01-31 12:00:00"),            # day 30 from cohort month start
            order(12, 2, "2001-06-01 08:00:00", shipping=7.0),  # no items
            order(13, 4, "2001-05-01 00:00:00"),            # deleted customer's order
            order(14, 1, "2001-05-01 00:00:00", deleted=True),  # deleted order
            order(15, 5, "2001-07-01 00:00:00"),
            order(16, 2, "2003-01-01 00:00:00"),            # outside the date spine
            order(17, 6, "2001-04-01 12:00:00"),            # 31 days after 2001-03-01
        ],
        items=[
            item(1000, 10, pid=1, qty=2, unit=10.0),
            item(1001, 11, pid=2, qty=1, unit=5.5),
            item(1002, 13, pid=1, qty=1, unit=10.0),
            item(1003, 14, pid=1, qty=1, unit=10.0),
            item(1004, 15, pid=3, qty=1, unit=0.0),
            item(1005, 16, pid=1, qty=1, unit=10.0),
        ],
        products=[product(1), product(2, base=0.0, cost=0.0), product(3, base=10.0, cost=10.0)],
        payments=[payment(10), payment(11)],
        events=[
            event(1, 1, "ad_click", "paid_social", "2001-01-20 00:00:00"),
            event(2, 1, "page_view", "email", "2001-02-01 00:00:00"),     # not attributable
            event(3, 1, "email_click", None, "2001-02-05 12:00:00"),       # same time as order 10
            event(4, 2, "referral_click", None, "2001-05-01 00:00:00"),    # NULL channel
            event(5, 5, "page_view", "direct", "2001-06-01 00:00:00"),     # not attributable
            event(6, 5, "email_open", "email", "2001-06-02 00:00:00"),     # not attributable
        ],
    )
    return ModelGraph(spark, r, PARAMS)


def rows(df, key):
    return {getattr(r, key): r for r in df.collect()}


def test_order_without_items(pipe):
    o = rows(pipe.int_orders_enriched, "order_id")
    assert o[12].item_count == 0 and o[12].subtotal == 0.0 and o[12].order_total == 7.0
    assert o[10].subtotal == 20.0 and o[10].payment_id == "pi_10"
    assert 14 not in o


def test_attribution_rules(pipe):
    a = rows(pipe.int_orders_attributed, "order_id")
    assert a[10].attributed_event_id == 1 and a[10].channel_group == "paid_social"  # equal time skipped
    assert a[12].attributed_event_id == 4 and a[12].channel_group == "unattributed"  # NULL channel
    # only page_view / email_open before the order: unattributed
    assert a[15].attributed_event_id is None and a[15].channel_group == "unattributed"


def test_fact_rows(pipe):
    f = rows(pipe.fct_orders, "order_item_id")
    assert 1003 not in f                      # deleted order: no fact row
    assert f[1002].customer_key is None       # deleted customer: row kept, key NULL
    assert f[1005].date_key is None           # outside the spine
    assert f[1000].date_key is not None
    import hashlib
    assert f[1004].channel_key == hashlib.md5(b"unattributed").hexdigest()


def test_rfm_edges(pipe):
    r = rows(pipe.int_customers_rfm_scored, "customer_id")
    c3 = r[3]
    assert (c3.recency_score, c3.frequency_score, c3.monetary_score, c3.rfm_segment) == (1, 1, 1, "Hibernating")
    assert r[5].monetary_score == 1 and r[5].total_spend_12m == 0.0
    # four buyers in the window (customers 1, 2, 5, 6) -> tiles 1..4 only
    assert sorted(x.frequency_score for x in r.values() if x.order_count_12m > 0) == [1, 2, 3, 4]
    assert 4 not in r


def test_cohort_flags(pipe):
    c = rows(pipe.int_cohorts_monthly, "customer_id")
    assert c[1].is_retained_30d is True and c[1].has_repeat_purchase is True
    assert c[1].total_orders == 2
    assert 3 not in c  # cohorts hold buyers only
    assert c[6].is_retained_30d is False and c[6].is_retained_60d is True and c[6].has_repeat_purchase is True


def test_dimensions(pipe):
    p = rows(pipe.dim_products, "product_id")
    assert p[2].margin_pct == 0.0 and p[1].margin_pct == 60.0
    d = rows(pipe.dim_customers, "customer_id")
    assert d[1].is_repeat_customer is True and d[3].lifetime_order_count == 0 and d[3].is_repeat_customer is False
    assert d[1].effective_to == dt.datetime(9999, 12, 31) and d[1].is_current is True


def test_rolling_and_heatmap(pipe):
    roll = pipe.report("revenue_rolling7").collect()
    assert all(r.weekly_avg is None for r in roll[:6])
    heat = pipe.report("segment_heatmap").collect()
    assert all(0.0 <= r.avg_revenue_scaled <= 1.0 for r in heat)


def test_checks_run(pipe):
    res = rows(pipe.check_results(materialize=False), "test_name")
    assert len(res) == 57
    assert res["unique_int_orders_enriched_order_id"].failures == 0
    assert res["relationships_fct_orders_date_key__date_key__dim_date"].failures == 0


def test_heatmap_constant_metric_scales_to_zero(spark):
    from tidewater.plans.reports import segment_heatmap

    rows = [("Loyal", 100.0, 2, 50.0), ("New", 300.0, 2, 50.0), ("Loyal", 100.0, 2, 50.0)]
    dc = spark.createDataFrame(rows, "rfm_segment string, lifetime_revenue double, lifetime_order_count long, "
                                     "avg_order_value double")
    got = {r.rfm_segment: r for r in segment_heatmap(dc).collect()}
    assert got["Loyal"].avg_revenue_scaled == 0.0 and got["New"].avg_revenue_scaled == 1.0
    assert all(r.avg_orders_scaled == 0.0 and r.avg_aov_scaled == 0.0 for r in got.values())
