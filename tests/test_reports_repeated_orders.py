"""Reports over orders whose ids repeat with other customers, dates and channels."""

import datetime as dt

from tidewater.plans import reports

FCT = "order_id long, customer_key string, date_key int, channel_group string, channel_key string, revenue double"
ROWS = [
    (1, "a", 1, "g", "k", 10.0), (1, "a", 1, "g", "k", 20.0), (1, "b", 1, "g", "k", 30.0), (1, "b", 2, "g", "k", 40.0),
    (2, "c", 2, "g", "k", 50.0), (None, "d", 2, "g", "k", None),
]


def frames(spark):
    days = spark.createDataFrame([(1, dt.date(2000, 1, 1)), (2, dt.date(2000, 1, 2))], "date_key int, date_day date")
    return spark.createDataFrame(ROWS, FCT), days, spark.createDataFrame([("k", "cat")], "channel_key string, channel_category string")


def test_orders_and_customers_are_counted_distinct(spark):
    fct, days, channels = frames(spark)
    assert tuple(reports.kpi_summary(fct).first()) == (2, 4, 150.0, 30.0)
    assert [tuple(r) for r in reports.channel_revenue(fct, channels).collect()] == [("g", "cat", 2, 150.0, 4)]
    assert [tuple(r) for r in reports.aov_monthly(fct, days).collect()] == [(dt.date(2000, 1, 1), 75.0)]
    assert [tuple(r)[1:] for r in reports.revenue_daily(fct, days).collect()] == [(60.0, 1), (90.0, 2)]
