"""Sales rollup: the line fact summed up per day and channel, with exact distinct counts that still add up.

Two tables at the grain (date_key, channel_group, channel_key):

* ``sums``: exact revenue (whole ten-thousandths) and priced lines;
* ``members``: the orders and the customers of the group, as bitmaps over
  consecutive numbers (``operators.bitmaps``).

Any report that groups whole days or channels reads these instead of the lines:
revenue is added up and sets are united, so orders and customers are counted
distinct without expanding rows, over any period.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numeric import from_units, round_half_up
from tidewater.operators.bitmaps import bitmaps, consecutive_numbers, united
from tidewater.plans.reports import per_order
from tidewater.session import write_checkpoint_table

GRAIN = ["date_key", "channel_group", "channel_key"]


@dataclass(frozen=True)
class SalesRollup:
    sums: DataFrame  # GRAIN, units, priced
    members: DataFrame  # GRAIN, kind (order or customer), bucket, bits


def sales_rollup(fct_orders: DataFrame) -> SalesRollup:
    """Both tables, written to the shared checkpoint folder (every report reads them)."""
    # Read once for the sums and twice for each set, so it is written, at order grain.
    orders = write_checkpoint_table(per_order(fct_orders, *GRAIN), "rollup_orders")
    by_date = orders.where("order_id is not null").groupBy("order_id").agg(F.min("date_key").alias("_day"))
    order_numbers = consecutive_numbers(by_date, [F.col("_day").asc_nulls_first(), F.col("order_id")])
    customers = orders.where("customer_key is not null").select("customer_key").distinct()
    customer_numbers = consecutive_numbers(customers, [F.col("customer_key")])

    def sets(kind: str, key: str, numbers: DataFrame) -> DataFrame:
        numbered = orders.select(*GRAIN, key).join(numbers.select(key, "number"), key)
        return bitmaps(numbered, GRAIN, "number").withColumn("kind", F.lit(kind))

    members = sets("order", "order_id", order_numbers).unionByName(sets("customer", "customer_key", customer_numbers))
    sums = orders.groupBy(*GRAIN).agg(F.sum("_units").alias("units"), F.sum("_priced").alias("priced"))
    return SalesRollup(write_checkpoint_table(sums, "rollup_sums"), write_checkpoint_table(members, "rollup_members"))


def _grouped(sums: DataFrame, members: DataFrame, groups: list[str]) -> DataFrame:
    """(groups..., units, priced, orders, customers).  Groups may be null; the rows of both tables meet in one aggregate."""
    sizes = united(members, [*groups, "kind"]).select(
        *groups, *[F.when(F.col("kind") == k, F.bitmap_count("bits")).alias(f"{k}s") for k in ("order", "customer")],
        F.lit(None).cast("long").alias("units"), F.lit(None).cast("long").alias("priced"),
    )
    money = sums.select(
        *groups, "units", "priced", F.lit(None).cast("long").alias("orders"), F.lit(None).cast("long").alias("customers")
    )
    return money.unionByName(sizes).groupBy(*groups).agg(
        F.sum("units").alias("units"), F.sum("priced").alias("priced"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("orders", "customers")],
    )


def kpi_summary(r: SalesRollup) -> DataFrame:
    revenue = from_units(F.col("units"))
    return _grouped(r.sums, r.members, []).select(
        F.col("orders").alias("total_orders"), F.col("customers").alias("total_customers"),
        round_half_up(revenue, 2).alias("total_revenue"),
        round_half_up(F.try_divide(revenue, F.col("priced").cast("double")), 2).alias("avg_item_revenue"),
    )


def _dated(table: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select("date_key", "date_day")
    return table.join(days, "date_key")


def revenue_daily(r: SalesRollup, dim_date: DataFrame) -> DataFrame:
    return _grouped(_dated(r.sums, dim_date), _dated(r.members, dim_date), ["date_day"]).select(
        F.col("date_day").alias("order_date"), from_units(F.col("units")).alias("daily_revenue"),
        F.col("orders").alias("daily_orders"),
    ).orderBy("order_date")


def aov_monthly(r: SalesRollup, dim_date: DataFrame) -> DataFrame:
    sums, members = (_dated(t, dim_date).withColumn("month", F.trunc("date_day", "month")) for t in (r.sums, r.members))
    mean = F.try_divide(from_units(F.col("units")), F.col("orders").cast("double"))
    return _grouped(sums, members, ["month"]).select("month", round_half_up(mean, 2).alias("aov")).orderBy("month")


def channel_revenue(r: SalesRollup, dim_channels: DataFrame) -> DataFrame:
    channels = dim_channels.select("channel_key", "channel_category")
    groups = ["channel_group", "channel_category"]
    sums, members = (t.join(channels, "channel_key", "left") for t in (r.sums, r.members))
    return _grouped(sums, members, groups).select(
        *groups, "orders", round_half_up(from_units(F.col("units")), 2).alias("revenue"), "customers"
    ).orderBy(F.col("revenue").desc_nulls_first())
