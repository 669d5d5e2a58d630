"""Adapters: the given TPC-H-style tables -> the six raw source contracts.

The given test tables (customer, nation, orders, lineitem, part, events) do
not carry the shop's columns, so each raw source is derived from them by a
fixed, deterministic rule (documented in FIXTURES.md section 3).  Every rule
is a column expression or a keyed aggregate, so the adapters scale with the
inputs and keep Parquet column pruning and filter pushdown intact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.numeric import from_units, round2_double, units


def _ts(text: str) -> Column:
    return F.expr(f"timestamp_ntz'{text}'")


def _days(col: Column) -> Column:
    return F.make_dt_interval(col.cast("int"))


def _seconds(col: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), col.cast("decimal(18,6)"))


def _case_mod(key: Column, modulus: int, labels: list) -> Column:
    """labels[key % modulus] as a CASE chain (labels are literals)."""
    m = key % modulus
    expr = None
    for i, label in enumerate(labels[:-1]):
        expr = F.when(m == i, F.lit(label)) if expr is None else expr.when(m == i, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def raw_customers(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    first_order = orders.groupBy(F.col("o_custkey").alias("_cust")).agg(
        F.min("o_orderdate").alias("_first_order")
    )
    # nation is the fixed 25-row TPC-H reference table at every scale.
    nat = F.broadcast(nation.select("n_nationkey", "n_name"))
    c = customer.select("c_custkey", "c_name", "c_nationkey")
    joined = c.join(nat, c.c_nationkey == nat.n_nationkey, "left").join(
        first_order, c.c_custkey == first_order._cust, "left"
    )
    cid = F.col("c_custkey")
    return joined.select(
        cid.alias("customer_id"),
        F.concat(F.lit("customer_"), cid.cast("string"), F.lit("@example.com")).alias("email"),
        F.lit("Customer").alias("first_name"),
        F.expr("substr(c_name, 10)").alias("last_name"),
        F.when(cid % 20 == 0, F.lit("NB")).when(cid % 3 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        (F.lit(18) + cid % 53).cast("long").alias("age"),
        F.col("n_name").alias("state"),
        (F.coalesce(F.col("_first_order"), _ts("1995-01-01 00:00:00")) - _days(cid % 45)).alias("signup_at"),
        (cid % 4 != 0).alias("email_opt_in"),
        (cid % 50 == 0).alias("is_deleted"),
    )


# Fixed values of the order adapter (status by key % 20, shipping by key % 4).
ORDER_STATUS_BY_KEY_MOD_20 = {0: "cancelled", 1: "refunded", 2: "processing", 3: "shipped"}
SHIPPING_BY_KEY_MOD_4 = [0.0, 5.99, 7.99, 9.99]


def raw_orders(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.lit("completed")
    for residue in sorted(ORDER_STATUS_BY_KEY_MOD_20, reverse=True):
        status = F.when(key % 20 == residue, F.lit(ORDER_STATUS_BY_KEY_MOD_20[residue])).otherwise(status)
    return orders.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_orderdate") + _seconds(key % 86400)).alias("order_at"),
        status.alias("status"),
        F.when(key % 4 == 0, F.lit(0.10)).otherwise(F.lit(0.0)).alias("discount_pct"),
        _case_mod(key, 4, SHIPPING_BY_KEY_MOD_4).cast("double").alias("shipping_cost"),
        (key % 97 == 0).alias("is_deleted"),
    )


# Order of lines inside one order: every column, so the numbering is total.
LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
    "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


#: Room for line numbers in an order item id.
LINES_PER_ORDER = 1_000_000


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    # One window per order; an order's lines do not grow with the table.
    # LINES_PER_ORDER is far above any order, and beyond it the build fails
    # rather than hand out the next order's ids.
    # The lines are numbered before any column gets its new name, so the exchange
    # moves each column once and its partitioning holds for order_id as well.
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    qty = F.col("l_quantity").cast("long")
    unit = round2_double(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) / F.col("l_quantity"))
    return (
        lineitem.select(*(["l_orderkey"] + LINE_ORDER))
        .withColumn("_line", F.row_number().over(w))
        .select(
            (
                F.col("l_orderkey") * LINES_PER_ORDER
                + F.when(F.col("_line") < LINES_PER_ORDER, F.col("_line")).otherwise(
                    F.raise_error(F.lit("an order has too many lines for its item ids")).cast("int")
                )
            ).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            qty.alias("quantity"),
            unit.alias("unit_price"),
        )
        # R2(unit_price * quantity): unit_price is rounded to cents, so the
        # rounded product is exactly units * quantity (integer math, no
        # second decimal rounding per line).
        .withColumn("total_price", from_units(units(F.col("unit_price")) * F.col("quantity")))
    )


def raw_products(part: DataFrame) -> DataFrame:
    pid = F.col("p_partkey")
    return part.select(
        pid.alias("product_id"),
        F.concat(F.lit("SKU-"), pid.cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").alias("base_price"),
        round2_double(F.col("p_retailprice") * (F.lit(30) + pid % 20) / F.lit(100)).alias("cost_price"),
        (pid % 25 != 0).alias("is_active"),
        (_ts("1995-01-01 00:00:00") + _days(pid % 90)).alias("created_at"),
    )


# Payment method by order_id % 5.
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay", "google_pay"]


def raw_payments(raw_orders_df: DataFrame, raw_items_df: DataFrame) -> DataFrame:
    """One payment per raw order: item subtotal (exact) + shipping."""
    subtotal = raw_items_df.groupBy("order_id").agg(F.sum(units(F.col("total_price"))).alias("_subtotal"))
    o = raw_orders_df.select("order_id", "order_at", "status", "shipping_cost")
    oid = F.col("order_id")
    amount = from_units(F.coalesce(F.col("_subtotal"), F.lit(0).cast("long")) + units(F.col("shipping_cost")))
    return o.join(subtotal, "order_id", "left").select(
        F.concat(F.lit("pi_"), F.substring(F.md5(oid.cast("string")), 1, 24)).alias("payment_id"),
        oid.alias("order_id"),
        amount.alias("amount"),
        F.lit("usd").alias("currency"),
        _case_mod(oid, 5, PAYMENT_METHODS).alias("payment_method"),
        F.when(F.col("status").isin("cancelled", "refunded"), F.col("status"))
        .otherwise(F.lit("succeeded"))
        .alias("status"),
        (F.col("order_at") + _seconds(F.lit(1) + oid % 119)).alias("created_at"),
    )


# page_view channel by event_id % 8.
PAGE_VIEW_CHANNELS = [
    "paid_social", "organic_social", "email", "paid_search",
    "organic_search", "direct", "referral", "affiliate",
]


def raw_events(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    src = F.col("event_type")
    etype = (
        F.when(src == "view", "page_view")
        .when(src == "click", "ad_click")
        .when(src == "signup", "organic_visit")
        .when(src == "error", "referral_click")
        .when(src == "purchase", F.when(eid % 3 == 0, "email_open").otherwise("email_click"))
    )
    t = F.col("_etype")
    channel = (
        F.when(t == "ad_click", F.when(eid % 5 < 3, "paid_social").otherwise("paid_search"))
        .when(t.isin("email_open", "email_click"), F.lit("email"))
        .when(
            t == "organic_visit",
            F.when(eid % 7 < 4, "organic_search").when(eid % 7 < 6, "direct").otherwise("organic_social"),
        )
        .when(t == "referral_click", F.when(eid % 5 < 3, "referral").otherwise("affiliate"))
        .when(t == "page_view", _case_mod(eid, 8, PAGE_VIEW_CHANNELS))
    )
    cust = F.col("user_id") * 10 + eid % 10
    shifted = F.expr("timestamp_ntz'1995-01-01 00:00:00' + (ts - timestamp_ntz'2024-01-01 00:00:00') * 80")
    return (
        events.select("event_id", "ts", "user_id", "event_type")
        .select(eid, cust.alias("customer_id"), etype.alias("_etype"), shifted.alias("event_at"))
        .select(
            eid,
            "customer_id",
            t.alias("event_type"),
            channel.alias("channel"),
            "event_at",
            F.when(t == "page_view", F.concat(F.lit("/p/"), (eid % 10).cast("string"))).alias("page_url"),
            F.concat(
                F.lit("sess_"),
                F.substring(F.md5(F.concat_ws("_", F.col("customer_id").cast("string"), eid.cast("string"))), 1, 16),
            ).alias("session_id"),
        )
    )
