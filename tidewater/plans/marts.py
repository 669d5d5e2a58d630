"""Star-schema marts: four dimensions and two facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import dow_sunday0, ntz, padded_day_name, padded_month_name
from tidewater.functions.keys import constant_key, surrogate_key
from tidewater.functions.numeric import money_avg, money_sum, round_half_up
from tidewater.operators.members import with_members

OPEN_END = dt.datetime(9999, 12, 31)


def customer_lifetime(orders_enriched: DataFrame) -> DataFrame:
    """Lifetime order metrics per customer (exact money sums)."""
    total = F.col("order_total")
    return orders_enriched.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("lifetime_order_count"),
        money_sum(total).alias("lifetime_revenue"),
        F.min("order_at").alias("first_order_at"),
        F.max("order_at").alias("last_order_at"),
        money_avg(total).alias("avg_order_value"),
    )


PROFILE = ["customer_id", "email", "first_name", "last_name", "gender", "age", "state", "signup_at",
           "is_email_opted_in"]
RFM = ["recency_score", "frequency_score", "monetary_score", "rfm_segment"]


def dim_customers(rfm_scored: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """One current row per customer: profile, RFM, lifetime metrics, SCD2 columns."""
    return _customer_rows(rfm_scored.select(*PROFILE, *RFM), orders_enriched, RFM)


def customer_profile(stg_customers: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """``dim_customers`` without the RFM columns.  The dimension's rows are
    exactly the staged customers, so reports that need no RFM column can
    read this and skip the ranking."""
    return _customer_rows(stg_customers.select(*PROFILE), orders_enriched, [])


def _customer_rows(people: DataFrame, orders_enriched: DataFrame, extra: list[str]) -> DataFrame:
    life = customer_lifetime(orders_enriched)
    j = people.join(life, "customer_id", "left")
    return j.select(
        surrogate_key("customer_id").alias("customer_key"),
        *PROFILE, *extra,
        F.coalesce(F.col("lifetime_order_count"), F.lit(0)).cast("long").alias("lifetime_order_count"),
        F.coalesce(F.col("lifetime_revenue"), F.lit(0.0)).alias("lifetime_revenue"),
        F.coalesce(F.col("avg_order_value"), F.lit(0.0)).alias("avg_order_value"),
        "first_order_at", "last_order_at",
        F.coalesce(F.col("lifetime_order_count") >= 2, F.lit(False)).alias("is_repeat_customer"),
        F.col("signup_at").alias("effective_from"),
        ntz(OPEN_END).alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def customer_keys(stg_customers: DataFrame) -> DataFrame:
    """Key rows of ``dim_customers`` (one current row per staged customer)."""
    return stg_customers.select("customer_id", surrogate_key("customer_id").alias("customer_key"),
                                F.lit(True).alias("is_current"))


def dim_products(stg_products: DataFrame) -> DataFrame:
    base, cost = F.col("base_price"), F.col("cost_price")
    return stg_products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id", "sku", "product_name", "category", "subcategory", "base_price", "cost_price",
        (base - cost).alias("margin"),
        F.when(base > 0, round_half_up((base - cost) / base * 100, 1)).otherwise(F.lit(0.0)).alias("margin_pct"),
        "is_active", "created_at",
    )


def dim_date(spine: DataFrame) -> DataFrame:
    """Calendar attributes per day; fiscal year starts in July."""
    d = F.col("date_day")
    year, quarter, month, day, dow = F.year(d), F.quarter(d), F.month(d), F.dayofmonth(d), dow_sunday0(d)
    holiday = (
        ((month == 1) & (day == 1))
        | ((month == 7) & (day == 4))
        | ((month == 12) & (day == 25))
        | ((month == 11) & (dow == 4) & day.between(22, 28))
        | ((month == 2) & (day == 14))
    )
    return spine.select(
        surrogate_key("date_day").alias("date_key"),
        d.alias("date_day"),
        year.alias("calendar_year"),
        quarter.alias("calendar_quarter"),
        month.alias("calendar_month"),
        F.weekofyear(d).alias("week_of_year"),
        dow.alias("day_of_week_num"),
        padded_day_name(d).alias("day_of_week_name"),
        padded_month_name(d).alias("month_name"),
        day.alias("day_of_month"),
        F.when(month >= 7, year + 1).otherwise(year).alias("fiscal_year"),
        F.when(month >= 7, quarter - 2).otherwise(quarter + 2).alias("fiscal_quarter"),
        dow.isin(0, 6).alias("is_weekend"),
        holiday.alias("is_holiday"),
    )


# Channel taxonomy.
CHANNEL_CATEGORIES = {
    "paid_social": "Paid",
    "paid_search": "Paid",
    "organic_social": "Organic",
    "organic_search": "Organic",
    "email": "Owned",
    "direct": "Direct",
    "referral": "Earned",
    "affiliate": "Earned",
}
PAID_CHANNELS = ["paid_social", "paid_search"]


def channel_category(ch: F.Column) -> F.Column:
    categories = F.create_map(*[F.lit(x) for pair in CHANNEL_CATEGORIES.items() for x in pair])
    return F.coalesce(categories[ch], F.lit("Other"))


def dim_channels(stg_events: DataFrame) -> DataFrame:
    """One row per distinct channel (partial distinct before the shuffle)."""
    ch = F.col("channel")
    return stg_events.select("channel").distinct().select(
        surrogate_key("channel").alias("channel_key"),
        ch,
        channel_category(ch).alias("channel_category"),
        F.coalesce(ch.isin(PAID_CHANNELS), F.lit(False)).alias("is_paid"),
    )


def _current_customers(dim_customers_df: DataFrame) -> DataFrame:
    # `and dc.is_current` in the ON clause: filter the dimension, keep the fact row.
    return dim_customers_df.where(F.col("is_current")).select("customer_id")


def order_lines(
    stg_order_items: DataFrame,
    orders_enriched_df: DataFrame,
    orders_attributed_df: DataFrame,
    dim_date_df: DataFrame,
    dim_customers_df: DataFrame,
    dim_products_df: DataFrame,
    dim_channels_df: DataFrame,
) -> DataFrame:
    """The rows of ``fct_orders`` with the ids that its keys are made of.

    A dimension's key is the hash of its id, so a lookup only says whether the
    id is there; no key goes through an exchange, and ``order_keys`` makes them
    where the lines end up.  Customers and products, which grow with the shop,
    are looked up by ``with_members``, so that neither orders nor lines are
    exchanged for it: lines stay where their numbering or the order join puts
    them.  Order-level lookups are joined at order grain, before the order
    meets its lines; days and channels become broadcasts through AQE's runtime
    size check.
    """
    o = orders_enriched_df.select(
        "order_id", "customer_id", "order_at", "order_status", "discount_pct", "shipping_cost",
        "payment_method", "payment_status",
    )
    a = orders_attributed_df.select(F.col("order_id").alias("_a_order_id"), "attributed_channel", "channel_group")
    dd = dim_date_df.select(F.col("date_day").alias("_date_day"), F.lit(True).alias("_has_date"))
    dch = dim_channels_df.select(F.col("channel").alias("_channel"), F.lit(True).alias("_has_channel"))
    found = with_members(o.join(a, o["order_id"] == a["_a_order_id"], "left"), "customer_id",
                         _current_customers(dim_customers_df), "_has_customer")
    order_level = (
        found.join(dd, F.to_date(found["order_at"]) == dd["_date_day"], "left")
        .join(dch, F.col("attributed_channel") == dch["_channel"], "left")
        .select(
            "order_id", "customer_id", "_has_customer", "_has_date", "_has_channel", "order_at", "order_status",
            "attributed_channel", "channel_group", "discount_pct", "shipping_cost", "payment_method", "payment_status",
        )
    )
    items = stg_order_items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price", "total_price")
    lines = with_members(items, "product_id", dim_products_df.select("product_id"), "_has_product")
    return lines.join(order_level, "order_id", "inner")


def order_keys(lines: DataFrame) -> DataFrame:
    """``fct_orders`` from ``order_lines``: a row-local projection, so it holds in any order of the rows."""
    return lines.select(
        surrogate_key("order_item_id").alias("order_line_key"),
        "order_item_id", "order_id",
        F.when(F.col("_has_customer"), surrogate_key("customer_id")).alias("customer_key"),
        F.when(F.col("_has_product"), surrogate_key("product_id")).alias("product_key"),
        F.when(F.col("_has_date"), surrogate_key(F.to_date("order_at"))).alias("date_key"),
        F.when(F.col("_has_channel"), surrogate_key("attributed_channel"))
        .otherwise(constant_key("unattributed")).alias("channel_key"),
        "order_at", "order_status", "attributed_channel", "channel_group", "quantity", "unit_price",
        F.col("total_price").alias("revenue"),
        "discount_pct", "shipping_cost", "payment_method", "payment_status",
    )


def fct_orders(*models: DataFrame) -> DataFrame:
    """Line-item grain fact, from the models that ``order_lines`` takes."""
    return order_keys(order_lines(*models))


def event_rows(
    stg_events: DataFrame, dim_customers_df: DataFrame, dim_date_df: DataFrame, dim_channels_df: DataFrame
) -> DataFrame:
    """The rows of ``fct_customer_events`` with the ids that its keys are made of."""
    dd = dim_date_df.select(F.col("date_day").alias("_date_day"), F.lit(True).alias("_has_date"))
    dch = dim_channels_df.select(F.col("channel").alias("_channel"), F.lit(True).alias("_has_channel"))
    e = with_members(stg_events, "customer_id", _current_customers(dim_customers_df), "_has_customer")
    return (
        e.join(dd, F.to_date(e["event_at"]) == dd["_date_day"], "left")
        .join(dch, e["channel"] == dch["_channel"], "left")
        .select(
            "event_id", "customer_id", "_has_customer", "_has_date", "_has_channel",
            "event_type", "channel", "event_at", "page_url", "session_id",
        )
    )


def event_keys(events: DataFrame) -> DataFrame:
    """``fct_customer_events`` from ``event_rows``, row by row."""
    return events.select(
        surrogate_key("event_id").alias("event_key"),
        "event_id",
        F.when(F.col("_has_customer"), surrogate_key("customer_id")).alias("customer_key"),
        F.when(F.col("_has_date"), surrogate_key(F.to_date("event_at"))).alias("date_key"),
        F.when(F.col("_has_channel"), surrogate_key("channel")).otherwise(constant_key("unknown")).alias("channel_key"),
        "event_type", "channel", "event_at", "page_url", "session_id",
    )


def fct_customer_events(*models: DataFrame) -> DataFrame:
    """Event grain fact with customer, date and channel keys, from the models that ``event_rows`` takes."""
    return event_keys(event_rows(*models))
