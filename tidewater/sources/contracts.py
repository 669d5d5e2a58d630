"""Schemas of the six raw sources (shop orders, payments, marketing events).

Integers are 64-bit, money is double, timestamps carry no zone (UTC wall
clock).  ``conform`` selects and casts a frame to its contract so later
stages can rely on names and types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _S, _D, _B, _TS = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


RAW_CUSTOMERS = _schema(
    ("customer_id", _L), ("email", _S), ("first_name", _S), ("last_name", _S),
    ("gender", _S), ("age", _L), ("state", _S), ("signup_at", _TS),
    ("email_opt_in", _B), ("is_deleted", _B),
)
RAW_ORDERS = _schema(
    ("order_id", _L), ("customer_id", _L), ("order_at", _TS), ("status", _S),
    ("discount_pct", _D), ("shipping_cost", _D), ("is_deleted", _B),
)
RAW_ORDER_ITEMS = _schema(
    ("order_item_id", _L), ("order_id", _L), ("product_id", _L), ("quantity", _L),
    ("unit_price", _D), ("total_price", _D),
)
RAW_PRODUCTS = _schema(
    ("product_id", _L), ("sku", _S), ("product_name", _S), ("category", _S),
    ("subcategory", _S), ("base_price", _D), ("cost_price", _D), ("is_active", _B),
    ("created_at", _TS),
)
RAW_PAYMENTS = _schema(
    ("payment_id", _S), ("order_id", _L), ("amount", _D), ("currency", _S),
    ("payment_method", _S), ("status", _S), ("created_at", _TS),
)
RAW_EVENTS = _schema(
    ("event_id", _L), ("customer_id", _L), ("event_type", _S), ("channel", _S),
    ("event_at", _TS), ("page_url", _S), ("session_id", _S),
)

CONTRACTS: dict[str, T.StructType] = {
    "raw_customers": RAW_CUSTOMERS,
    "raw_orders": RAW_ORDERS,
    "raw_order_items": RAW_ORDER_ITEMS,
    "raw_products": RAW_PRODUCTS,
    "raw_payments": RAW_PAYMENTS,
    "raw_events": RAW_EVENTS,
}


class ContractError(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType, name: str = "source") -> DataFrame:
    """Project ``df`` onto ``schema``: every declared column, cast to its type.

    Raises ContractError when a declared column is missing.  Extra columns
    are dropped (column pruning then reaches the scan).
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ContractError(f"{name}: missing columns {missing}")
    return df.select(
        *[
            (F.col(f.name) if df.schema[f.name].dataType == f.dataType else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
