"""Staging models: rename, soft-delete filter and load stamp per raw source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import ntz


def _stamp(loaded_at: dt.datetime) -> F.Column:
    return ntz(loaded_at).alias("loaded_at")


def stg_customers(raw: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    # `where not is_deleted` also drops rows whose flag is NULL.
    return raw.where(~F.col("is_deleted")).select(
        "customer_id", "email", "first_name", "last_name", "gender", "age", "state", "signup_at",
        F.col("email_opt_in").alias("is_email_opted_in"), "is_deleted", _stamp(loaded_at),
    )


def stg_orders(raw: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    return raw.where(~F.col("is_deleted")).select(
        "order_id", "customer_id", "order_at", F.col("status").alias("order_status"),
        "discount_pct", "shipping_cost", "is_deleted", _stamp(loaded_at),
    )


def stg_order_items(raw: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    # No delete filter here: items of deleted orders drop out at the order join.
    return raw.select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "total_price", _stamp(loaded_at)
    )


def stg_products(raw: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    return raw.select(
        "product_id", "sku", "product_name", "category", "subcategory", "base_price", "cost_price",
        "is_active", "created_at", _stamp(loaded_at),
    )


def stg_payments(raw: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    return raw.select(
        "payment_id", "order_id", F.col("amount").alias("payment_amount"), "currency", "payment_method",
        F.col("status").alias("payment_status"), F.col("created_at").alias("payment_at"), _stamp(loaded_at),
    )


def stg_events(raw: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    return raw.select(
        "event_id", "customer_id", "event_type", "channel", "event_at", "page_url", "session_id", _stamp(loaded_at)
    )
