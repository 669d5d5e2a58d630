"""Reporting result sets over the marts (KPIs, segments, channels, cohorts).

Each report is one lazy DataFrame.  Aggregates run as partial + final hash
aggregates; the few windows here run over already-aggregated rows whose
count is bounded by the calendar (days, months) or the 7 segments.
Rounded outputs are half-away-from-zero through decimals, returned as double.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.numeric import from_units, money_sum, round_half_even_float, round_half_up, units


def _exact_sum(col: str) -> F.Column:
    """Exact money sum, as double."""
    return money_sum(F.col(col))


def per_order(fct_orders: DataFrame, *cols: str) -> DataFrame:
    """Order and customer grain: exact revenue and priced lines.  Where order ids repeat, an order has several
    such rows, so orders and customers are counted distinct over them; the lines are never expanded."""
    return fct_orders.groupBy("order_id", "customer_key", *cols).agg(
        F.sum(units(F.col("revenue"))).alias("_units"),
        F.count("revenue").alias("_priced"),
    )


def _distinct_and_sums(orders: DataFrame, groups: list[str], keys: dict[str, str]) -> DataFrame:
    """(groups..., _units, _priced, <name>...): sums, and distinct counts of the ``keys`` (name -> column).

    Each key is counted over rows grouped by it, so no row is expanded for the
    other; the branches share the exchange of ``orders``.  Their few rows per
    group meet in one last aggregate, where groups may be null.
    """
    names, parts = list(keys), []
    for i, (name, key) in enumerate(keys.items()):
        each = orders.groupBy(*groups, key).agg(F.sum("_units").alias("_units"), F.sum("_priced").alias("_priced"))
        sums = [F.sum(c).alias(c) if i == 0 else F.lit(None).cast("long").alias(c) for c in ("_units", "_priced")]
        counted = [F.count(key).alias(n) if n == name else F.lit(None).cast("long").alias(n) for n in names]
        parts.append(each.groupBy(*groups).agg(*sums, *counted).select(*groups, "_units", "_priced", *names))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return stacked.groupBy(*groups).agg(
        F.sum("_units").alias("_units"), F.sum("_priced").alias("_priced"), *[F.sum(n).alias(n) for n in names]
    )


def kpi_summary(fct_orders: DataFrame) -> DataFrame:
    keys = {"total_orders": "order_id", "total_customers": "customer_key"}
    revenue = from_units(F.col("_units"))
    return _distinct_and_sums(per_order(fct_orders), [], keys).select(
        *keys, round_half_up(revenue, 2).alias("total_revenue"),
        round_half_up(F.try_divide(revenue, F.col("_priced").cast("double")), 2).alias("avg_item_revenue"),
    )


def repeat_customers(dim_customers: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    repeat = F.sum(F.when(F.col("is_repeat_customer"), F.lit(1)).otherwise(F.lit(0))).cast("long")
    return dim_customers.agg(total.alias("total_customers"), repeat.alias("repeat_customers")).withColumn(
        "repeat_rate_pct",
        F.try_divide(F.col("repeat_customers").cast("double"), F.col("total_customers").cast("double")) * 100.0,
    )


def avg_clv(dim_customers: DataFrame) -> DataFrame:
    buyers = dim_customers.where(F.col("lifetime_order_count") > 0)
    return buyers.agg(
        round_half_up(_exact_sum("lifetime_revenue") / F.count("lifetime_revenue").cast("double"), 2).alias(
            "avg_clv"
        )
    )


def between(fact: DataFrame, dim_date: DataFrame, start: dt.date, end: dt.date, month: str | None = None) -> DataFrame:
    """The fact's rows of the days from ``start`` (inclusive) to ``end`` (exclusive) of the date dimension.

    ``month`` names the column of the fact's month folders ('yyyy-MM'), if it is
    stored in such.  The semi join is then on the month as well, so the days that
    are left in the dimension prune the folders before they are listed for
    reading; otherwise they only filter rows.
    """
    days = dim_date.where((F.col("date_day") >= F.lit(start)) & (F.col("date_day") < F.lit(end)))
    days = days.select(F.col("date_key").alias("_dk"), F.date_format("date_day", "yyyy-MM").alias("_month"))
    same = F.col("date_key") == F.col("_dk")
    return fact.join(days, same & (F.col(month) == F.col("_month")) if month else same, "left_semi")


def _dated_orders(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    # Inner join on date_key: orders outside the date spine drop out.
    dd = dim_date.select(F.col("date_key").alias("_dk"), "date_day")
    return per_order(fct_orders, "date_key").join(dd, F.col("date_key") == dd["_dk"], "inner")


def revenue_daily(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (
        _dated_orders(fct_orders, dim_date)
        .groupBy("date_day")
        .agg(from_units(F.sum("_units")).alias("daily_revenue"), F.count_distinct("order_id").alias("daily_orders"))
        .select(F.col("date_day").alias("order_date"), "daily_revenue", "daily_orders")
        .orderBy("order_date")
    )


def revenue_rolling7(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Mean over the last 7 rows present (not calendar days); NULL until 7 rows exist."""
    daily = revenue_daily(fct_orders, dim_date)
    # One row per day with sales: bounded by the calendar, so a global window is fine.
    w = Window.orderBy("order_date").rowsBetween(-6, 0)
    mean7 = from_units(F.sum(units(F.col("daily_revenue"))).over(w)) / F.lit(7.0)
    return daily.withColumn("weekly_avg", F.when(F.count(F.lit(1)).over(w) == 7, mean7)).orderBy("order_date")


def aov_monthly(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    orders = _dated_orders(fct_orders, dim_date).withColumn("month", F.trunc("date_day", "month"))
    mean = F.try_divide(from_units(F.sum("_units")), F.count_distinct("order_id").cast("double"))
    return orders.groupBy("month").agg(round_half_up(mean, 2).alias("aov")).orderBy("month")


def customer_growth(dim_customers: DataFrame) -> DataFrame:
    monthly = dim_customers.groupBy(F.trunc("signup_at", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("new_customers")
    )
    # Default RANGE frame over distinct months = running total; one row per month.
    w = Window.orderBy("month")
    return monthly.withColumn("cumulative_customers", F.sum("new_customers").over(w).cast("long")).orderBy("month")


def segment_distribution(dim_customers: DataFrame) -> DataFrame:
    def avg_of(col: str, cast: str) -> F.Column:
        return F.sum(F.col(col).cast(cast)).cast("double") / F.count(col).cast("double")

    return (
        dim_customers.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            round_half_up(money_sum(F.col("lifetime_revenue")) / F.count("lifetime_revenue").cast("double"), 2).alias(
                "avg_revenue"
            ),
            round_half_up(avg_of("lifetime_order_count", "long"), 1).alias("avg_orders"),
            round_half_up(avg_of("avg_order_value", "decimal(38,10)"), 2).alias("avg_aov"),
        )
        .orderBy(F.col("customer_count").desc())
    )


def segment_heatmap(dim_customers: DataFrame) -> DataFrame:
    """Min-max scaled segment metrics; a constant metric scales to 0."""
    seg = segment_distribution(dim_customers)
    w = Window.partitionBy()  # 7 segment rows at most

    def scaled(col: str) -> F.Column:
        lo, hi = F.min(col).over(w), F.max(col).over(w)
        return F.when(hi != lo, (F.col(col) - lo) / (hi - lo)).otherwise(F.lit(0.0))

    return seg.select(
        "rfm_segment",
        scaled("avg_revenue").alias("avg_revenue_scaled"),
        scaled("avg_orders").alias("avg_orders_scaled"),
        scaled("avg_aov").alias("avg_aov_scaled"),
    )


def revenue_share(dim_customers: DataFrame) -> DataFrame:
    seg = dim_customers.groupBy("rfm_segment").agg(F.sum(units(F.col("lifetime_revenue"))).alias("_rev"))
    grand = F.sum("_rev").over(Window.partitionBy())  # over the grouped segment rows (cents, exact)
    return seg.select(
        "rfm_segment",
        from_units(F.col("_rev")).alias("total_revenue"),
        round_half_up(F.try_divide(from_units(F.col("_rev")), from_units(grand)) * 100.0, 1).alias("revenue_pct"),
    ).orderBy(F.col("total_revenue").desc())


def segment_details(dim_customers: DataFrame) -> DataFrame:
    """Segment table with revenue share recomputed from the rounded averages
    (float rounding to 1 place, half to even on the binary value)."""
    seg = segment_distribution(dim_customers)
    weight = units(F.col("avg_revenue")) * F.col("customer_count")  # exact cents
    total = F.sum(weight).over(Window.partitionBy())
    pct = from_units(weight) / from_units(total) * 100.0
    return seg.select(
        "rfm_segment", "customer_count", "avg_revenue", "avg_orders", "avg_aov",
        round_half_even_float(pct, 1).alias("revenue_pct"),
    )


def channel_revenue(fct_orders: DataFrame, dim_channels: DataFrame) -> DataFrame:
    ch = dim_channels.select(F.col("channel_key").alias("_ck"), "channel_category")
    groups = ["channel_group", "channel_category"]
    orders = per_order(fct_orders, "channel_group", "channel_key").join(ch, F.col("channel_key") == ch["_ck"], "left")
    counted = _distinct_and_sums(orders, groups, {"orders": "order_id", "customers": "customer_key"})
    return counted.select(
        *groups, "orders", round_half_up(from_units(F.col("_units")), 2).alias("revenue"), "customers"
    ).orderBy(F.col("revenue").desc_nulls_first())


def first_order_channel(dim_customers: DataFrame, orders_attributed: DataFrame) -> DataFrame:
    """Channel of the touch before each customer's first order (two-column join)."""
    c = dim_customers.select("customer_id", "first_order_at", "is_repeat_customer")
    a = orders_attributed.select(
        F.col("customer_id").alias("_a_customer_id"), F.col("order_at").alias("_a_order_at"), "attributed_channel"
    )
    return c.join(
        a, (c["customer_id"] == a["_a_customer_id"]) & (c["first_order_at"] == a["_a_order_at"]), "inner"
    ).select("customer_id", F.col("attributed_channel").alias("first_channel"), "is_repeat_customer")


def retention_by_channel(dim_customers: DataFrame, orders_attributed: DataFrame, min_customers: int = 50) -> DataFrame:
    """Repeat rate by first-order channel.  dim_customers has one row per
    customer_id, so its repeat flag rides along the first join instead of a
    second join on the same key."""
    ft = first_order_channel(dim_customers, orders_attributed)
    agg = ft.groupBy("first_channel").agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_distinct(F.when(F.col("is_repeat_customer"), F.col("customer_id"))).alias("repeat_customers"),
    )
    rate = F.try_divide(
        F.col("repeat_customers").cast("double"),
        F.when(F.col("total_customers") != 0, F.col("total_customers")).cast("double"),
    ) * 100.0
    return (
        agg.where(F.col("total_customers") >= min_customers)
        .withColumn("retention_rate", round_half_up(rate, 1))
        .orderBy(F.col("retention_rate").desc_nulls_first())
    )


def cohort_retention(cohorts_monthly: DataFrame, retention_days: tuple[int, ...] = (30, 60, 90, 180, 365)) -> DataFrame:
    def pct(flag: str) -> F.Column:
        hits = F.sum(F.col(flag).cast("int")).cast("double")
        return round_half_up(hits * 100.0 / F.count(flag).cast("double"), 1)

    return (
        cohorts_monthly.groupBy("cohort_month")
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            *[pct(f"is_retained_{d}d").alias(f"retained_{d}d") for d in retention_days],
        )
        .withColumn("cohort_label", F.date_format("cohort_month", "yyyy-MM"))
        .orderBy("cohort_month")
    )


def attribution_coverage(orders_attributed: DataFrame, threshold: float = 75.0) -> DataFrame:
    """Share of orders with an attributed channel, and whether it meets the gate."""
    cov = orders_attributed.agg(
        F.count(F.lit(1)).alias("total_orders"), F.count("attributed_channel").alias("attributed_orders")
    )
    pct = round_half_up(F.col("attributed_orders").cast("double") * 100.0 / F.col("total_orders").cast("double"), 2)
    return cov.withColumn("coverage_pct", pct).withColumn("passed", F.col("coverage_pct") >= F.lit(threshold))
