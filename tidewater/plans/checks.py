"""Declared data-quality checks of the models, plus the three singular ones.

54 declared checks (14 unique, 27 not_null, 8 accepted_values,
5 relationships) and 3 singular checks; a check passes with 0 failures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.quality import Check
from tidewater.plans.intermediate import SEGMENTS
from tidewater.plans.reports import attribution_coverage

SCORES = (1, 2, 3, 4, 5)
# The event types accepted by the event fact.
EVENT_TYPES = ("page_view", "email_open", "email_click", "ad_click", "organic_visit", "referral_click")


def _u(model: str, col: str) -> Check:
    return Check("unique", model, col)


def _nn(model: str, col: str) -> Check:
    return Check("not_null", model, col)


def _av(model: str, col: str, values: tuple) -> Check:
    return Check("accepted_values", model, col, values=values)


def _rel(model: str, col: str, to_model: str, to_col: str) -> Check:
    return Check("relationships", model, col, to_model=to_model, to_column=to_col)


DECLARED: list[Check] = [
    # intermediate
    _u("int_orders_enriched", "order_id"), _nn("int_orders_enriched", "order_id"),
    _nn("int_orders_enriched", "customer_id"),
    _u("int_customers_rfm_scored", "customer_id"), _nn("int_customers_rfm_scored", "customer_id"),
    _nn("int_customers_rfm_scored", "recency_score"), _av("int_customers_rfm_scored", "recency_score", SCORES),
    _nn("int_customers_rfm_scored", "frequency_score"), _av("int_customers_rfm_scored", "frequency_score", SCORES),
    _nn("int_customers_rfm_scored", "monetary_score"), _av("int_customers_rfm_scored", "monetary_score", SCORES),
    _nn("int_customers_rfm_scored", "rfm_segment"),
    _av("int_customers_rfm_scored", "rfm_segment", tuple(SEGMENTS)),
    _u("int_orders_attributed", "order_id"), _nn("int_orders_attributed", "order_id"),
    _nn("int_orders_attributed", "channel_group"),
    _nn("int_cohorts_monthly", "customer_id"), _nn("int_cohorts_monthly", "cohort_month"),
    # marts
    _u("dim_date", "date_key"), _nn("dim_date", "date_key"),
    _u("dim_date", "date_day"), _nn("dim_date", "date_day"),
    _u("dim_customers", "customer_key"), _nn("dim_customers", "customer_key"),
    _nn("dim_customers", "customer_id"), _nn("dim_customers", "rfm_segment"),
    _av("dim_customers", "recency_score", SCORES), _av("dim_customers", "frequency_score", SCORES),
    _av("dim_customers", "monetary_score", SCORES),
    _u("dim_products", "product_key"), _nn("dim_products", "product_key"),
    _u("dim_products", "product_id"), _nn("dim_products", "product_id"),
    _u("dim_channels", "channel_key"), _nn("dim_channels", "channel_key"),
    _u("dim_channels", "channel"), _nn("dim_channels", "channel"),
    _u("fct_orders", "order_line_key"), _nn("fct_orders", "order_line_key"),
    _u("fct_orders", "order_item_id"), _nn("fct_orders", "order_item_id"),
    _rel("fct_orders", "customer_key", "dim_customers", "customer_key"),
    _rel("fct_orders", "product_key", "dim_products", "product_key"),
    _rel("fct_orders", "date_key", "dim_date", "date_key"),
    _nn("fct_orders", "quantity"), _nn("fct_orders", "revenue"),
    _u("fct_customer_events", "event_key"), _nn("fct_customer_events", "event_key"),
    _u("fct_customer_events", "event_id"), _nn("fct_customer_events", "event_id"),
    _rel("fct_customer_events", "customer_key", "dim_customers", "customer_key"),
    _rel("fct_customer_events", "date_key", "dim_date", "date_key"),
    _nn("fct_customer_events", "event_type"), _av("fct_customer_events", "event_type", EVENT_TYPES),
]

SINGULAR: list[Check] = [
    Check("singular", "int_orders_attributed", name="assert_attribution_coverage"),
    Check("singular", "stg_orders", name="assert_no_orders_before_signup"),
    Check("singular", "int_customers_rfm_scored", name="assert_rfm_scores_valid"),
]


def coverage_failures(orders_attributed: DataFrame, threshold: float = 75.0) -> DataFrame:
    """One row when the attributed share of orders is below the gate."""
    return attribution_coverage(orders_attributed, threshold).where(~F.col("passed"))


def orders_before_signup(stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Orders placed before their customer's signup (equi join + residual filter)."""
    o = stg_orders.select("order_id", "customer_id", "order_at")
    c = stg_customers.select(F.col("customer_id").alias("_c_customer_id"), "signup_at")
    return o.join(c, (o["customer_id"] == c["_c_customer_id"]) & (o["order_at"] < c["signup_at"]), "inner").select(
        "order_id", "customer_id", "order_at", "signup_at"
    )


def invalid_rfm_scores(rfm_scored: DataFrame) -> DataFrame:
    def bad(c: str) -> F.Column:
        # NOT IN (1..5): NULL gives NULL, which the filter drops.
        return ~F.col(c).isin(list(SCORES))

    return rfm_scored.where(bad("recency_score") | bad("frequency_score") | bad("monetary_score")).select(
        "customer_id", "recency_score", "frequency_score", "monetary_score"
    )
