"""Exact distinct counts that add up: bitmaps over consecutive numbers.

A count of distinct values cannot be added up over days or channels, so a
summary table that holds such counts answers one grouping only.  Here every
value gets a consecutive number, and a group keeps the set of its numbers as
bitmaps of 32,768 bits each (Spark's ``bitmap_*`` functions).  Sets of groups
are united by OR-ing bitmaps of equal bucket, and a distinct count is the number
of set bits, which is exact and needs no second look at the facts.

``consecutive_numbers`` numbers rows by a distributed sort: rows are
range-partitioned and sorted, written once to the shared checkpoint folder with
their (partition, position), and each partition gets the number of rows before
it from a table of one row per partition, the only broadcast.

Numbers should follow the order in which groups hold their values (orders by
date, say), so that a group's bits lie in few buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import write_checkpoint_table

_POSITION_BITS = 33  # monotonically_increasing_id: partition << 33 | position


def consecutive_numbers(df: DataFrame, order_by: list[Column], out: str = "number", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0, 1, 2, ... in the order of ``order_by``, which must be total."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
    rows = write_checkpoint_table(dealt.withColumn("_id", F.monotonically_increasing_id()), "numbers")
    rows = rows.withColumn("_part", F.shiftright("_id", _POSITION_BITS))
    counts = rows.groupBy("_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # one row per partition: the window and the broadcast are as small as that
    shift = counts.select("_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(F.broadcast(shift), "_part").select(*df.columns, (F.col("_id") + F.col("_shift")).alias(out))


def bitmaps(df: DataFrame, groups: list[str], number: str) -> DataFrame:
    """(groups..., bucket, bits): the set of ``number`` of each group; null numbers are in no set."""
    placed = df.where(F.col(number).isNotNull()).select(
        *groups, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("_bit")
    )
    return placed.groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def united(sets: DataFrame, groups: list[str]) -> DataFrame:
    """The sets united over everything but ``groups``."""
    return sets.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def set_sizes(sets: DataFrame, groups: list[str], out: str = "n") -> DataFrame:
    """(groups..., n): the number of distinct values of each group."""
    return united(sets, groups).groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(out))
