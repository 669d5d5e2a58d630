"""Intermediate models: order enrichment, RFM scoring, last-touch attribution,
monthly cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import month_start, ntz, whole_days
from tidewater.functions.numeric import from_units, money_sum, units
from tidewater.operators.asof import asof_last_before
from tidewater.operators.tile_edges import tile_edges, tile_of
from tidewater.params import RunParams
from tidewater.session import write_checkpoint_table

# Event types that count as a marketing touch.
ATTRIBUTABLE_EVENT_TYPES = ["ad_click", "email_click", "organic_visit", "referral_click"]

# The RFM segment names.
SEGMENTS = ["Champions", "Loyal", "New", "Promising", "At Risk", "Hibernating", "Needs Attention"]


def order_item_summary(stg_order_items: DataFrame) -> DataFrame:
    """Per order: line count, units and exact subtotal (partial + final aggregate)."""
    return stg_order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        money_sum(F.col("total_price")).alias("subtotal"),
    )


def orders_enriched(stg_orders: DataFrame, stg_order_items: DataFrame, stg_payments: DataFrame) -> DataFrame:
    """Order grain: order + item aggregates + payment.  All three inputs are
    hash-partitioned on order_id, so both joins run in one stage."""
    items = order_item_summary(stg_order_items)
    pay = stg_payments.select("order_id", "payment_id", "payment_method", "payment_status", "payment_amount", "payment_at")
    o = stg_orders.select("order_id", "customer_id", "order_at", "order_status", "discount_pct", "shipping_cost")
    j = o.join(items, "order_id", "left").join(pay, "order_id", "left")
    subtotal = F.coalesce(F.col("subtotal"), F.lit(0.0))
    return j.select(
        "order_id", "customer_id", "order_at", "order_status", "discount_pct", "shipping_cost",
        F.coalesce(F.col("item_count"), F.lit(0)).cast("long").alias("item_count"),
        F.coalesce(F.col("total_quantity"), F.lit(0)).cast("long").alias("total_quantity"),
        subtotal.alias("subtotal"),
        (subtotal + F.col("shipping_cost")).alias("order_total"),
        "payment_id", "payment_method", "payment_status", "payment_amount", "payment_at",
    )


def attribution_events(stg_events: DataFrame) -> DataFrame:
    return stg_events.where(F.col("event_type").isin(ATTRIBUTABLE_EVENT_TYPES)).select(
        "event_id", "customer_id", "event_type", "channel", "event_at"
    )


def orders_attributed(stg_orders: DataFrame, stg_events: DataFrame, params: RunParams) -> DataFrame:
    """Last touch strictly before each order (as-of join); ties on time go to
    the greater event_id.  No touch, or a touch without a channel, gives the
    group 'unattributed'."""
    touched = asof_last_before(
        stg_orders.select("order_id", "customer_id", "order_at"),
        attribution_events(stg_events),
        by="customer_id",
        left_time="order_at",
        right_time="event_at",
        right_tiebreak="event_id",
        right_cols={
            "event_id": "attributed_event_id",
            "event_type": "attributed_event_type",
            "channel": "attributed_channel",
            "event_at": "attributed_event_at",
        },
        bucket_seconds=params.asof_bucket_seconds,
        target_rows=params.asof_target_rows,
    )
    return touched.select(
        "order_id", "customer_id", "order_at", "attributed_event_id", "attributed_event_type",
        "attributed_channel", "attributed_event_at",
        F.coalesce(F.col("attributed_channel"), F.lit("unattributed")).alias("channel_group"),
    )


def cohorts_monthly(stg_customers: DataFrame, stg_orders: DataFrame, params: RunParams) -> DataFrame:
    """Customer x signup-month cohort with retention flags.  Days count from
    the first day of the signup month and include the first purchase."""
    cohorts = stg_customers.select("customer_id", month_start(F.col("signup_at")).alias("cohort_month"))
    o = stg_orders.select("customer_id", "order_id", "order_at")
    j = o.join(cohorts, "customer_id", "inner").withColumn(
        "_days", whole_days(F.col("order_at"), F.col("cohort_month").cast("timestamp_ntz"))
    )

    def flag(cond: F.Column) -> F.Column:
        return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("boolean")

    return j.groupBy("customer_id", "cohort_month").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.min("order_at").alias("first_order_at"),
        F.max("order_at").alias("last_order_at"),
        *[flag(F.col("_days") <= d).alias(f"is_retained_{d}d") for d in params.retention_days],
        flag(F.col("_days") > 30).alias("has_repeat_purchase"),
    )


def rfm_base(stg_customers: DataFrame, stg_orders: DataFrame, stg_order_items: DataFrame, params: RunParams) -> DataFrame:
    """Customer profile + trailing-window recency, frequency and spend.

    Order count, last order and spend come from one aggregate: items are
    summed per order first (map-side partial aggregate), joined to the
    window's orders on order_id, then summed per customer.
    """
    recent = stg_orders.where(F.col("order_at") >= ntz(params.rfm_cutoff)).select("order_id", "customer_id", "order_at")
    items = stg_order_items.join(recent.select("order_id"), "order_id", "left_semi")
    per_order = items.groupBy("order_id").agg(F.sum(units(F.col("total_price"))).alias("_sub"))
    metrics = (
        recent.join(per_order, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.max("order_at").alias("last_order_at"),
            F.count(F.lit(1)).alias("_n"),
            F.sum("_sub").alias("_spend"),
        )
    )
    c = stg_customers.select(
        "customer_id", "email", "first_name", "last_name", "gender", "age", "state", "signup_at", "is_email_opted_in"
    )
    return c.join(metrics, "customer_id", "left").select(
        *c.columns,
        "last_order_at",
        whole_days(ntz(params.as_of), F.col("last_order_at")).alias("days_since_last_order"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("order_count_12m"),
        F.coalesce(from_units(F.col("_spend")), F.lit(0.0)).alias("total_spend_12m"),
    )


def rfm_segment(r: F.Column, f: F.Column, m: F.Column) -> F.Column:
    """Ordered CASE: the first matching rule wins."""
    return (
        F.when((r == 5) & (f == 5) & (m == 5), "Champions")
        .when((r >= 4) & (f >= 4), "Loyal")
        .when((r == 5) & (f == 1), "New")
        .when((r >= 3) & (r <= 4) & (f >= 1) & (f <= 2), "Promising")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Hibernating")
        .otherwise("Needs Attention")
    )


# score -> (value column, ranked descending?, partition flag column)
RFM_ORDER = {
    "recency": ("days_since_last_order", True, "order_count_12m"),
    "frequency": ("order_count_12m", False, "order_count_12m"),
    "monetary": ("total_spend_12m", False, "total_spend_12m"),
}


NULL_LAST, NULL_FIRST = (1 << 63) - 1, -(1 << 63)


def _score_keys(which: str) -> tuple[F.Column, list[F.Column]]:
    """(group, order) of one score: ntile(5) within the flag ``<flag col> > 0``, ordered by
    value (recency descending), then customer_id, then the row number ``_row``, which
    only matters for repeated or missing ids.  Values are whole numbers (days, orders,
    ten-thousandths of money), so every order is over integers."""
    col, desc, flag_col = RFM_ORDER[which]
    value = units(F.col(col)) if which == "monetary" else F.col(col).cast("long")
    value = F.coalesce(-value if desc else value, F.lit(NULL_LAST))
    return (F.col(flag_col) > 0).cast("int"), [value, F.coalesce(F.col("customer_id"), F.lit(NULL_FIRST)), F.col("_row")]


def _scored(base: DataFrame, which: tuple[str, ...]) -> DataFrame:
    """``base`` (stored, with ``_row``) with the scores: rows are compared with the tile edges, not sorted.

    Rows with a zero flag column score 1 (for monetary: exactly zero spend;
    negative spend is ranked with the zeros, as in the source).
    """
    parts = []
    for i, name in enumerate(which):
        flag, keys = _score_keys(name)
        parts.append(F.struct((flag + 2 * i).alias("g"), *[k.alias(f"k{j}") for j, k in enumerate(keys)]))
    edges = tile_edges(base.select(F.inline(F.array(*parts))), "g", ["k0", "k1", "k2"], 5)
    scores = {}
    for i, name in enumerate(which):
        flag, keys = _score_keys(name)
        own = {g: e for g, e in edges.items() if g // 2 == i}
        scores[f"{name}_score"] = F.when(F.col(RFM_ORDER[name][2]) == 0, F.lit(1)).otherwise(tile_of(flag + 2 * i, keys, own))
    return base.withColumns(scores)


def _numbered(base: DataFrame) -> DataFrame:
    """The base with a row number, written once: it is read for the edges and for the output."""
    return write_checkpoint_table(base.withColumn("_row", F.monotonically_increasing_id()), "rfm_base")


def rfm_single_score(base: DataFrame, which: str, params: RunParams) -> DataFrame:
    """One RFM score alone: (customer_id, <which>_score), a row for each row of the base."""
    value, _, flag = RFM_ORDER[which]
    return _scored(_numbered(base.select(*dict.fromkeys(("customer_id", value, flag)))), (which,)).select("customer_id", f"{which}_score")


def rfm_scored(stg_customers: DataFrame, stg_orders: DataFrame, stg_order_items: DataFrame, params: RunParams) -> DataFrame:
    """RFM quintiles with exact, distributed ntile.

    The customer-grain base is written once to the shared checkpoint folder;
    a customer whose id is missing or repeated keeps a row (and fails the
    declared checks).
    """
    base = _numbered(rfm_base(stg_customers, stg_orders, stg_order_items, params))
    scored = _scored(base, tuple(RFM_ORDER)).drop("_row")
    return scored.withColumn(
        "rfm_segment", rfm_segment(F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score"))
    )


def rfm_order_metrics(stg_orders: DataFrame, params: RunParams) -> DataFrame:
    """Per customer in the trailing window: last order time and order count."""
    recent = stg_orders.where(F.col("order_at") >= ntz(params.rfm_cutoff))
    return recent.groupBy("customer_id").agg(
        F.max("order_at").alias("last_order_at"), F.count(F.lit(1)).alias("order_count_12m")
    )


def rfm_revenue(stg_orders: DataFrame, stg_order_items: DataFrame, params: RunParams) -> DataFrame:
    """Per customer in the trailing window: exact spend (items summed per order first)."""
    recent = stg_orders.where(F.col("order_at") >= ntz(params.rfm_cutoff)).select("order_id", "customer_id")
    per_order = stg_order_items.groupBy("order_id").agg(F.sum(units(F.col("total_price"))).alias("_sub"))
    return (
        recent.join(per_order, "order_id", "inner")
        .groupBy("customer_id")
        .agg(from_units(F.sum("_sub")).alias("total_spend_12m"))
    )
