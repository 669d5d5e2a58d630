"""Exact ntile over a whole table, without a single-task window.

``ntile(n) over (partition by g order by ...)`` with a low-cardinality g
(here a two-valued flag) makes Spark put every row of a g value into one
task.  This operator computes the same tiles with a distributed sort:

1. range-partition on (g, order keys) and sort inside partitions; the order
   keys must end in a unique column, so the sort is total and even a value
   shared by a third of the rows is split across partitions;
2. ``monotonically_increasing_id`` gives (partition, position) per row;
3. a per-(g, partition) count table (at most partitions + groups rows, a
   proven bound) gives each partition its offset inside its group and the
   group size; it is the only broadcast;
4. position i (0-based) of n rows maps to a tile: with q = n div k and
   r = n mod k, the first r tiles hold q + 1 rows and the rest q rows.

The numbered frame is read twice (counts and rows).  Its ids depend on the
physical partitioning, so it is written once to the shared checkpoint folder
and both reads use the stored ids: the positions agree even if an executor
is lost or the range exchange were planned twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import write_checkpoint_table

_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | position


def exact_ntile(
    df: DataFrame,
    tiles: int,
    order_by: list[Column],
    *,
    out: str,
    group: Column | None = None,
    partitions: int | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Add column ``out`` = ntile(tiles) over (partition by group order by order_by).

    ``order_by`` must be a total order (end it with a unique key).  ``group``
    must have few distinct values (a flag); it may be None for one group.
    ``carry`` limits the output to those columns plus ``out``.  Pass a narrow
    frame (key, sort columns, group) so the sort moves only those columns,
    and join the tile back by key.
    """
    if tiles < 1:
        raise ValueError("tiles must be >= 1")
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    cols = carry or df.columns
    keyed = df.withColumn("_ng", group if group is not None else F.lit(0))

    sort_keys = [F.col("_ng").asc_nulls_first()] + list(order_by)
    numbered = (
        keyed.repartitionByRange(n_parts, *sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_rid", F.monotonically_increasing_id())
    )
    ranged = (
        write_checkpoint_table(numbered, "ntile")
        .withColumn("_pid", F.shiftright("_rid", _POS_BITS))
        .withColumn("_pos", F.col("_rid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
    )
    counts = ranged.groupBy("_ng", "_pid").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")
    )
    before = F.coalesce(
        F.sum("_cnt").over(
            Window.partitionBy("_ng").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    offsets = counts.select(
        F.col("_ng").alias("_og"),
        F.col("_pid").alias("_opid"),
        (before - F.col("_first")).alias("_base"),
        F.sum("_cnt").over(Window.partitionBy("_ng")).alias("_n"),
    )
    joined = ranged.join(
        F.broadcast(offsets),
        (ranged["_ng"].eqNullSafe(offsets["_og"])) & (ranged["_pid"] == offsets["_opid"]),
        "inner",
    )
    i = F.col("_base") + F.col("_pos")
    n = F.col("_n")
    q = F.floor(n / tiles).cast("long")
    r = n - q * tiles
    big = r * (q + 1)
    # q = 0 (fewer rows than tiles) always takes the first branch; the guard
    # only keeps ANSI mode from seeing a zero divisor.
    tile = F.when(i < big, F.floor(i / (q + 1)) + 1).otherwise(F.floor((i - big) / F.greatest(q, F.lit(1))) + r + 1)
    return joined.select(*cols, tile.cast("int").alias(out))
