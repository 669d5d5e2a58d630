"""Table derivations of the source's loader, as Spark jobs over the sources.

Line pricing, payment reconciliation, session ids, first orders and the
row-count audit.  The loader's random draws are not reproduced; only its
deterministic derivations are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numeric import from_units, round_half_up, units

# Order status -> payment status.
PAYMENT_STATUS = {
    "completed": "succeeded",
    "shipped": "succeeded",
    "processing": "succeeded",
    "cancelled": "cancelled",
    "refunded": "refunded",
}


def line_pricing(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """unit = round(base * (1 - discount), 2); total = round(unit * qty, 2)."""
    li = order_items.select("order_item_id", "order_id", "product_id", "quantity")
    o = orders.select(F.col("order_id").alias("_o_order_id"), "discount_pct")
    p = products.select(F.col("product_id").alias("_p_product_id"), "base_price")
    j = li.join(o, li["order_id"] == o["_o_order_id"], "inner").join(p, li["product_id"] == p["_p_product_id"], "inner")
    unit = round_half_up(F.col("base_price") * (F.lit(1.0) - F.col("discount_pct")), 2)
    return j.select(
        "order_item_id", "order_id", "product_id", "quantity", "base_price", "discount_pct", unit.alias("unit_price")
    ).withColumn("total_price", round_half_up(F.col("unit_price") * F.col("quantity"), 2))


def payments_derived(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """One payment per order: exact item subtotal (0 if none) + shipping, rounded."""
    sub = order_items.groupBy("order_id").agg(F.sum(units(F.col("total_price"))).alias("_sub"))
    o = orders.select("order_id", "shipping_cost", "status")
    amount = from_units(F.coalesce(F.col("_sub"), F.lit(0).cast("long")) + units(F.col("shipping_cost")))
    status_map = F.create_map(*[F.lit(x) for kv in PAYMENT_STATUS.items() for x in kv])
    return o.join(sub, "order_id", "left").select(
        F.concat(F.lit("pi_"), F.substring(F.md5(F.col("order_id").cast("string")), 1, 24)).alias("payment_id"),
        "order_id",
        round_half_up(amount, 2).alias("amount"),
        F.lit("usd").alias("currency"),
        F.coalesce(status_map[F.col("status")], F.lit("succeeded")).alias("status"),
    )


def python_datetime_text(ts: F.Column) -> F.Column:
    """str(datetime): 'YYYY-MM-DD HH:MM:SS' plus '.ffffff' when microseconds != 0."""
    base = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    micros = F.unix_micros(ts.cast("timestamp")) % 1_000_000
    return F.when(micros == 0, base).otherwise(F.concat(base, F.lit("."), F.date_format(ts, "SSSSSS")))


def session_ids(events: DataFrame) -> DataFrame:
    """sess_ + first 16 hex of md5('<customer_id>_<event time>')."""
    text = F.concat(F.col("customer_id").cast("string"), F.lit("_"), python_datetime_text(F.col("event_at")))
    return events.select(
        "event_id", "customer_id", "event_at",
        F.concat(F.lit("sess_"), F.substring(F.md5(text), 1, 16)).alias("session_id"),
    )


def first_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.min("order_at").alias("first_order_at"))


def audit_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table; each count is a partial + final aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
