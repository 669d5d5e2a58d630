"""Sources: raw-table contracts, readers and the test-data adapters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources import tpch_adapters as ad
from tidewater.sources.contracts import CONTRACTS, conform

GIVEN_TABLES = ("customer", "nation", "orders", "lineitem", "part", "events")


@dataclass(frozen=True)
class RawSources:
    """The six raw source tables, as lazy DataFrames."""

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    payments: DataFrame
    events: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "raw_customers": self.customers,
            "raw_orders": self.orders,
            "raw_order_items": self.order_items,
            "raw_products": self.products,
            "raw_payments": self.payments,
            "raw_events": self.events,
        }


def read_given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def from_test_tables(spark: SparkSession, sf_dir: str) -> RawSources:
    """Raw sources derived from the given TPC-H-style Parquet tables."""
    t = {name: read_given(spark, sf_dir, name) for name in GIVEN_TABLES}
    orders = ad.raw_orders(t["orders"])
    items = ad.raw_order_items(t["lineitem"])
    return RawSources(
        customers=conform(ad.raw_customers(t["customer"], t["nation"], t["orders"]), CONTRACTS["raw_customers"]),
        orders=conform(orders, CONTRACTS["raw_orders"]),
        order_items=conform(items, CONTRACTS["raw_order_items"]),
        products=conform(ad.raw_products(t["part"]), CONTRACTS["raw_products"]),
        payments=conform(ad.raw_payments(orders, items), CONTRACTS["raw_payments"]),
        events=conform(ad.raw_events(t["events"]), CONTRACTS["raw_events"]),
    )


def from_raw_parquet(spark: SparkSession, root: str) -> RawSources:
    """Raw sources stored as Parquet folders ``<root>/raw_<name>`` (production layout)."""

    def load(name: str) -> DataFrame:
        return conform(spark.read.parquet(f"{root.rstrip('/')}/{name}"), CONTRACTS[name], name)

    return RawSources(
        customers=load("raw_customers"),
        orders=load("raw_orders"),
        order_items=load("raw_order_items"),
        products=load("raw_products"),
        payments=load("raw_payments"),
        events=load("raw_events"),
    )
