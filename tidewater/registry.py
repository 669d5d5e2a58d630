"""Query registry: every implemented operator/model/report as a Spark query
over the given tables, with its DuckDB oracle SQL where one exists."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.dates import whole_days
from tidewater.functions.keys import surrogate_key
from tidewater.oracle import sql as osql
from tidewater.params import RunParams
from tidewater.plans import intermediate as im
from tidewater.plans import marts as mt
from tidewater.plans.graph import ModelGraph
from tidewater.session import ensure_checkpoint_dir
from tidewater.sources import from_test_tables
from tidewater.sources.bucketed import count_rows, lay_out

PARAMS = RunParams()
PREVIOUS_AS_OF = dt.datetime(2000, 8, 2)
# Three runs in the order of their arrival: the last to arrive was taken between the others.
ARRIVALS = [dt.datetime(2000, 8, 2), PARAMS.as_of, dt.datetime(2001, 2, 2)]
# Days of a date-bounded report, end exclusive.
PERIOD = (dt.date(1997, 2, 10), dt.date(1997, 5, 3))
# A date dimension with fixed bounds inside the data's range: lines outside have no date key and drop out of dated reports.
FIXED_SPINE = RunParams(spine_start=dt.date(1996, 1, 1), spine_end=dt.date(1998, 7, 1))


def model_graph(spark: SparkSession, sf_dir: str, params: RunParams = PARAMS) -> ModelGraph:
    return ModelGraph(spark, from_test_tables(spark, sf_dir), params)


def bucketed_graph(spark: SparkSession, sf_dir: str, params: RunParams = PARAMS) -> ModelGraph:
    """The models over the raw tables in the bucketed layout, written anew in the shared folder."""
    return ModelGraph(spark, lay_out(from_test_tables(spark, sf_dir), _layout_folder(spark)), params)


def _layout_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/layout-{uuid.uuid4().hex[:12]}"


def _footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _layout_folder(spark)
    lay_out(from_test_tables(spark, sf_dir), folder)
    return count_rows(spark, folder)


def _revenue_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily revenue of a period from stored marts, of which only the period's month folders are read."""
    g = model_graph(spark, sf_dir)
    g.write_models(f"{ensure_checkpoint_dir(spark).rstrip('/')}/marts-{uuid.uuid4().hex[:12]}", ("dim_date", "fct_orders"))
    return g.report_between("revenue_daily", *PERIOD)


def _q(fn: Callable[[ModelGraph], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(model_graph(spark, sf_dir))


def _rfm_base(p: ModelGraph) -> DataFrame:
    return im.rfm_base(p.stg_customers, p.stg_orders, p.stg_order_items, p.params)


STAGING = ["stg_customers", "stg_orders", "stg_order_items", "stg_products", "stg_payments", "stg_events"]
MODELS = {
    "orders_enriched": "int_orders_enriched",
    "orders_attributed": "int_orders_attributed",
    "cohorts_monthly": "int_cohorts_monthly",
    "rfm_segments": "int_customers_rfm_scored",
    "dim_date": "dim_date",
    "dim_customers": "dim_customers",
    "dim_products": "dim_products",
    "dim_channels": "dim_channels",
    "fct_orders": "fct_orders",
    "fct_customer_events": "fct_customer_events",
}
REPORTS = [
    "kpi_summary", "repeat_customers", "avg_clv", "revenue_daily", "revenue_rolling7", "aov_monthly",
    "customer_growth", "segment_distribution", "segment_heatmap", "revenue_share", "segment_details",
    "channel_revenue", "first_order_channel", "retention_by_channel", "cohort_retention", "attribution_coverage",
]
DQ_KINDS = {
    "dq_unique": ("unique",),
    "dq_not_null": ("not_null",),
    "dq_accepted_values": ("accepted_values",),
    "dq_relationships": ("relationships",),
    "dq_singular": ("singular",),
    "dq_summary": None,
}
ROLLUP_REPORTS = ["kpi_summary", "revenue_daily", "aov_monthly", "channel_revenue"]
BUCKETED = ["orders_enriched", "fct_orders", "rfm_base"]
RAW = ["raw_customers", "raw_orders", "raw_order_items", "raw_products", "raw_payments", "raw_events"]


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in STAGING:
        q[name] = _q(lambda p, n=name: p.model(n))
    q["audit_row_counts"] = _q(lambda p: p.derivation("audit_row_counts"))
    q["date_spine"] = _q(lambda p: p.date_spine)
    q["attribution_events"] = _q(lambda p: im.attribution_events(p.stg_events))
    q["order_item_summary"] = _q(lambda p: im.order_item_summary(p.stg_order_items))
    q["last_touch"] = _q(lambda p: p.int_orders_attributed.drop("channel_group"))
    q["rfm_order_metrics"] = _q(lambda p: im.rfm_order_metrics(p.stg_orders, p.params))
    q["rfm_revenue"] = _q(lambda p: im.rfm_revenue(p.stg_orders, p.stg_order_items, p.params))
    q["rfm_base"] = _q(_rfm_base)
    for which in ("recency", "frequency", "monetary"):
        q[f"rfm_{which}"] = _q(
            lambda p, w=which: im.rfm_single_score(_rfm_base(p), w, p.params)
        )
    q["customer_lifetime"] = _q(lambda p: mt.customer_lifetime(p.int_orders_enriched))
    q["days_between"] = _q(
        lambda p: p.stg_orders.select("order_id", "customer_id", "order_at")
        .join(p.stg_customers.select("customer_id", "signup_at"), "customer_id", "inner")
        .select("order_id", "customer_id", whole_days(F.col("order_at"), F.col("signup_at")).alias("days_since_signup"))
    )
    q["surrogate_key"] = _q(
        lambda p: p.stg_order_items.select(
            "order_item_id", "order_id", "product_id",
            surrogate_key("order_item_id").alias("order_line_key"),
            surrogate_key("order_id", "product_id").alias("order_product_key"),
        )
    )
    for key, model in MODELS.items():
        q[key] = _q(lambda p, m=model: p.model(m))
    for name in REPORTS:
        q[name] = _q(lambda p, n=name: p.report(n))
    for key, kinds in DQ_KINDS.items():
        q[key] = _q(lambda p, k=kinds: p.check_results(k))
    q["dq_no_orders_before_signup"] = _q(lambda p: p.singular_checks()["assert_no_orders_before_signup"]())
    q["dq_rfm_scores"] = _q(lambda p: p.singular_checks()["assert_rfm_scores_valid"]())
    for name in ("line_pricing", "payments_derived", "session_ids", "first_orders"):
        q[name] = _q(lambda p, n=name: p.derivation(n))
    q["fct_orders_fixed_spine"] = lambda spark, sf_dir: model_graph(spark, sf_dir, FIXED_SPINE).fct_orders.select(
        "order_line_key", "order_id", "date_key", "revenue"
    )
    q["revenue_daily_fixed_spine"] = lambda spark, sf_dir: model_graph(spark, sf_dir, FIXED_SPINE).report("revenue_daily")
    q["orders_enriched_bucketed"] = lambda spark, sf_dir: bucketed_graph(spark, sf_dir).int_orders_enriched
    q["fct_orders_bucketed"] = lambda spark, sf_dir: bucketed_graph(spark, sf_dir).fct_orders
    q["rfm_base_bucketed"] = lambda spark, sf_dir: _rfm_base(bucketed_graph(spark, sf_dir))
    q["audit_row_counts_footers"] = _footer_counts
    for name in ROLLUP_REPORTS:
        q[f"{name}_rollup"] = _q(lambda p, n=name: p.rollup_report(n))
    q["revenue_daily_between"] = _revenue_between
    q["scd2_late_snapshot"] = _q(lambda p: p.active_segment_history(ARRIVALS))
    q["scd2_merge"] = _q(lambda p: p.segment_history(PREVIOUS_AS_OF))
    return q


def oracle_queries() -> dict[str, str]:
    w = osql.with_prefix
    o: dict[str, str] = {}
    for name in STAGING:
        o[name] = w(f"SELECT * FROM {name}")
    o["audit_row_counts"] = w(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in RAW)
    )
    o["date_spine"] = w("SELECT date_day FROM date_spine")
    o["attribution_events"] = w("SELECT * FROM attribution_events")
    o["order_item_summary"] = w("SELECT * FROM item_summary")
    o["last_touch"] = w("SELECT * FROM last_touch")
    o["rfm_order_metrics"] = w("SELECT * FROM rfm_order_metrics")
    o["rfm_revenue"] = w("SELECT customer_id, CAST(total_spend_12m AS DOUBLE) AS total_spend_12m FROM rfm_revenue")
    o["rfm_base"] = w("SELECT * FROM rfm_base")
    for which in ("recency", "frequency", "monetary"):
        o[f"rfm_{which}"] = w(f"SELECT customer_id, {which}_score FROM int_customers_rfm_scored")
    o["customer_lifetime"] = w("SELECT * FROM customer_lifetime")
    o["days_between"] = w(
        "SELECT o.order_id, o.customer_id, CAST(date_sub('day', c.signup_at, o.order_at) AS INTEGER) AS days_since_signup "
        "FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id"
    )
    s = osql.NULL_SENTINEL
    o["surrogate_key"] = w(
        "SELECT order_item_id, order_id, product_id, "
        f"md5(coalesce(CAST(order_item_id AS VARCHAR), '{s}')) AS order_line_key, "
        f"md5(coalesce(CAST(order_id AS VARCHAR), '{s}') || '-' || coalesce(CAST(product_id AS VARCHAR), '{s}')) "
        "AS order_product_key FROM stg_order_items"
    )
    for key, model in MODELS.items():
        o[key] = w(f"SELECT * FROM {model}")
    for name in REPORTS:
        o[name] = w(f"SELECT * FROM {name}")
    for key, kinds in DQ_KINDS.items():
        o[key] = osql.checks_sql(kinds)
    o["dq_no_orders_before_signup"] = w("SELECT * FROM dq_orders_before_signup")
    o["dq_rfm_scores"] = w("SELECT * FROM dq_invalid_rfm")
    o["line_pricing"] = w(
        "SELECT li.order_item_id, li.order_id, li.product_id, li.quantity, p.base_price, o.discount_pct, "
        f"{osql._r2('p.base_price * (1.0 - o.discount_pct)')} AS unit_price, "
        f"{osql._r2(osql._r2('p.base_price * (1.0 - o.discount_pct)') + ' * li.quantity')} AS total_price "
        "FROM raw_order_items li JOIN raw_orders o ON li.order_id = o.order_id "
        "JOIN raw_products p ON li.product_id = p.product_id"
    )
    o["payments_derived"] = w(
        "SELECT 'pi_' || substr(md5(CAST(o.order_id AS VARCHAR)), 1, 24) AS payment_id, o.order_id, "
        f"{osql._r2('coalesce(s.sub, CAST(0 AS DECIMAL(38,4))) + CAST(o.shipping_cost AS DECIMAL(38,4))')} AS amount, "
        "'usd' AS currency, CASE WHEN o.status IN ('cancelled', 'refunded') THEN o.status ELSE 'succeeded' END AS status "
        "FROM raw_orders o LEFT JOIN (SELECT order_id, sum(CAST(total_price AS DECIMAL(38,4))) AS sub "
        "FROM raw_order_items GROUP BY order_id) s ON o.order_id = s.order_id"
    )
    o["session_ids"] = w(
        "SELECT event_id, customer_id, event_at, 'sess_' || substr(md5(CAST(customer_id AS VARCHAR) || '_' || "
        "CASE WHEN epoch_us(event_at) % 1000000 = 0 THEN strftime(event_at, '%Y-%m-%d %H:%M:%S') "
        "ELSE strftime(event_at, '%Y-%m-%d %H:%M:%S.%f') END), 1, 16) AS session_id FROM raw_events"
    )
    o["first_orders"] = w("SELECT customer_id, min(order_at) AS first_order_at FROM raw_orders GROUP BY customer_id")
    o["fct_orders_fixed_spine"] = w("SELECT order_line_key, order_id, date_key, revenue FROM fct_orders", FIXED_SPINE)
    o["revenue_daily_fixed_spine"] = w("SELECT * FROM revenue_daily", FIXED_SPINE)
    for name in BUCKETED:
        o[f"{name}_bucketed"] = o[name]
    o["audit_row_counts_footers"] = o["audit_row_counts"]
    for name in ROLLUP_REPORTS:
        o[f"{name}_rollup"] = o[name]
    o["revenue_daily_between"] = w(
        f"SELECT * FROM revenue_daily WHERE order_date >= DATE '{PERIOD[0]}' AND order_date < DATE '{PERIOD[1]}'"
    )
    o["scd2_late_snapshot"] = osql.active_segment_history_sql(PARAMS, ARRIVALS)
    o["scd2_merge"] = osql.segment_history_sql(PARAMS, PREVIOUS_AS_OF)
    return o
