import datetime as dt
import hashlib

from tidewater.functions.dates import date_spine
from tidewater.functions.keys import NULL_SENTINEL, surrogate_key
from tidewater.params import DEFAULT_SPINE_END, DEFAULT_SPINE_START
from tidewater.plans.marts import dim_date


def test_default_spine_and_attributes(spark):
    d = dim_date(date_spine(spark, DEFAULT_SPINE_START, DEFAULT_SPINE_END))
    rows = {r.date_day: r for r in d.collect()}
    assert len(rows) == 1095
    assert min(rows) == dt.date(2023, 7, 1) and max(rows) == dt.date(2026, 6, 29)
    sun = rows[dt.date(2024, 1, 7)]
    assert sun.day_of_week_num == 0 and sun.is_weekend and sun.day_of_week_name == "Sunday   "
    assert rows[dt.date(2024, 11, 28)].is_holiday          # fourth Thursday of November
    assert not rows[dt.date(2024, 11, 21)].is_holiday
    jul = rows[dt.date(2024, 7, 1)]
    assert (jul.fiscal_year, jul.fiscal_quarter, jul.month_name) == (2025, 1, "July     ")
    assert rows[dt.date(2024, 1, 1)].date_key == hashlib.md5(b"2024-01-01").hexdigest()


def test_surrogate_key_null_and_parts(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    r = df.select(surrogate_key("a").alias("k1"), surrogate_key("a", "b").alias("k2")).first()
    assert r.k1 == hashlib.md5(b"1").hexdigest()
    assert r.k2 == hashlib.md5(f"1-{NULL_SENTINEL}".encode()).hexdigest()
