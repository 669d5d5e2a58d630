"""As-of join: for each left row, the latest right row strictly before it.

Semantics (left outer): for a left row with key k and time t, pick among
right rows with the same key and time < t the one with the greatest
(time, tiebreak); attach its columns, or NULLs when there is none.

Plan
----
A per-key window over the union of both sides is the textbook form, but it
puts all rows of one key into one task, and one customer may own a third of
all rows.  The key is therefore split by a time bucket:

1. A per-(key, bucket) summary holds the latest right row of each bucket
   (a partial/final aggregate, so pre-aggregated before its shuffle).  A
   window over the summary, per key and ordered by bucket, gives every bucket
   the latest right row of all earlier buckets (the carry).  Its size per key
   is the number of the key's buckets: one, or about rows / target for a hot
   key.  Only split keys take part, so the summary has one row per hot
   bucket, not one per key.
2. Each carry becomes one extra row of its bucket with a NULL time, so it
   sorts first.  ``union(left, right, carry rows)`` is windowed per (key,
   bucket), ordered by (time, side, tiebreak) with left rows before right
   rows at equal times, and a running ``last(right, ignorenulls)`` gives each
   left row the latest right row before it: inside the bucket if there is
   one, else the carried one.  No join back is needed.

Buckets.  Only hot keys are split.  One partial/final aggregate counts the
rows of every key; keys with more than ``target`` rows are cut at ``PARTS``
quantiles of their own times, so each bucket holds about as many rows however
the times are spread; every other key keeps one bucket, which holds at most
``target`` rows by definition.  Hot keys number fewer than total / ``target``, and
``target`` is raised to total / ``max_hot_keys`` when needed, so the hot-key table
has at most ``max_hot_keys`` rows of ``PARTS`` numbers: a broadcast with a proven
bound, attached without a shuffle.  Left rows without a key match nothing and
pass by.

Instants.  A time that several quantiles of a key agree on holds many of its
rows and becomes a bucket of its own.  No right row of an instant matches a left
row of the same instant (the match is strictly before), so such a bucket needs
only its carry: its right rows take part in the summary, which aggregates them,
and its left rows are dealt out by hash over as many sub-buckets as quantiles
fell on the instant, each with a copy of the carry row.

The narrow union of both sides is written once to the shared checkpoint folder,
so the sources are read once, and the passes for counts, quantiles, summary and
match read the columns they need of that table.

Hot keys are spread over as many tasks as they have active buckets; no
all-pairs product is formed and no data-sized side is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import write_checkpoint_table

#: Buckets of a hot key.
PARTS = 256


def asof_last_before(
    left: DataFrame,
    right: DataFrame,
    *,
    by: str,
    left_time: str,
    right_time: str,
    right_tiebreak: str,
    right_cols: dict[str, str],
    bucket_seconds: int | None = None,
    target_rows: int = 1_000_000,
    max_hot_keys: int = 10_000,
) -> DataFrame:
    """Attach to ``left`` the latest ``right`` row with the same ``by`` key
    and ``right_time < left_time``.

    ``right_cols`` maps right column -> output column name.  Ties on
    ``right_time`` go to the greatest ``right_tiebreak``.  ``bucket_seconds``
    fixes one time bucket width for all keys; None splits only hot keys
    (see module doc).
    """
    if bucket_seconds is not None and bucket_seconds <= 0:
        raise ValueError("bucket_seconds must be positive")
    left_cols = left.columns
    clash = set(left_cols) & set(right_cols.values())
    if clash:
        raise ValueError(f"output columns already on the left side: {sorted(clash)}")

    def micros(c: str) -> F.Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    # The struct's first two fields order it: time, then tiebreak.
    payload = F.struct(
        F.col(right_time).alias("_rt"),
        F.col(right_tiebreak).alias("_rtie"),
        *[F.col(src).alias(f"_c{i}") for i, src in enumerate(right_cols)],
    )
    tie_type = right.schema[right_tiebreak].dataType
    lhs = left.where(F.col(by).isNotNull()).select(
        *left_cols,
        F.col(by).alias("_key"),
        F.col(left_time).alias("_t"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(tie_type).alias("_tie"),
        micros(left_time).alias("_us"),
    )
    rhs = right.where(F.col(by).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(by).alias("_key"),
        F.col(right_time).alias("_t"),
        F.lit(1).alias("_side"),
        F.col(right_tiebreak).alias("_tie"),
        micros(right_time).alias("_us"),
        payload.alias("_ev"),
    )
    both = write_checkpoint_table(lhs.unionByName(rhs, allowMissingColumns=True), "asof")
    both = in_buckets(both, left_cols, bucket_seconds, target_rows, max_hot_keys)
    # Keys that are not hot keep one bucket, so nothing is carried for them.
    split = both.where("_hot")

    # 1. latest right row of every earlier bucket of the same key
    summary = split.groupBy("_key", "_b").agg(F.max("_ev").alias("_bmax"), F.max("_subs").alias("_subs"))
    w_carry = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        summary.select("_key", "_b", "_subs", F.max("_bmax").over(w_carry).alias("_ev"))
        .where(F.col("_ev").isNotNull() & F.col("_b").isNotNull())
        .withColumn("_sub", F.explode(F.sequence(F.lit(0), F.greatest("_subs", F.lit(1)) - 1)))
        .select("_key", "_b", "_sub", F.lit(None).cast(both.schema["_t"].dataType).alias("_t"),
                F.lit(1).alias("_side"), F.lit(None).cast(tie_type).alias("_tie"), "_ev")
    )

    # 2. carry rows sort first in their bucket; a running last() finds the match
    w_local = (
        Window.partitionBy("_key", "_b", "_sub")
        .orderBy(F.col("_t").asc_nulls_first(), "_side", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = (
        both.where("_side = 0 or _subs = 0")
        .unionByName(carry, allowMissingColumns=True)
        .withColumn("_m", F.last("_ev", ignorenulls=True).over(w_local))
        .where(F.col("_side") == 0)
    )
    matched = out.select(
        *left_cols,
        *[F.col(f"_m._c{i}").alias(name) for i, name in enumerate(right_cols.values())],
    )
    keyless = left.where(F.col(by).isNull()).select(
        *left_cols, *[F.lit(None).cast(right.schema[src].dataType).alias(name) for src, name in right_cols.items()]
    )
    return matched.unionAll(keyless)


def in_buckets(
    both: DataFrame, left_cols: list[str], bucket_seconds: int | None, target_rows: int, max_hot_keys: int = 10_000
) -> DataFrame:
    """Add _hot (whether the key is split), _b (bucket), _subs (sub-buckets of a frequent instant, else 0) and _sub."""
    if bucket_seconds is not None:
        width = F.lit(int(bucket_seconds) * 1_000_000)
        return both.withColumns({
            "_hot": F.lit(True), "_b": F.floor(F.col("_us") / width).cast("long"), "_subs": F.lit(0), "_sub": F.lit(0),
        })
    hot = F.broadcast(_hot_keys(both, target_rows, max_hot_keys))  # <= max_hot_keys rows
    below = F.size(F.filter("_hbounds", lambda b: b <= F.col("_us")))
    joined = both.join(hot, both["_key"] == hot["_hk"], "left").withColumns({
        "_hot": F.col("_hbounds").isNotNull(), "_place": F.when(F.col("_hbounds").isNotNull(), below).otherwise(F.lit(0)),
    })
    # the bound at or before the row, and how many quantiles fell on it
    bound = F.when(F.col("_place") > 0, F.element_at("_hbounds", F.greatest("_place", F.lit(1))))
    joined = joined.withColumns({"_bound": bound, "_agree": F.size(F.filter("_hq", lambda q: q == F.col("_bound")))})
    frequent = F.coalesce(F.col("_agree") > 1, F.lit(False))
    # a bucket begins with its bound's instant; a frequent one is a bucket of its own, the rest of the bucket the next
    rest = (frequent & (F.col("_us") > F.col("_bound"))).cast("int")
    joined = joined.withColumns({
        "_b": (2 * F.col("_place") + F.coalesce(rest, F.lit(0))).cast("long"),
        "_subs": F.when(frequent & (F.col("_us") == F.col("_bound")), F.col("_agree")).otherwise(F.lit(0)),
    })
    spread = F.pmod(F.xxhash64(*left_cols), F.greatest("_subs", F.lit(1))).cast("int")
    return joined.drop("_hk", "_hbounds", "_hq", "_place", "_bound", "_agree").withColumn(
        "_sub", F.when((F.col("_subs") > 0) & (F.col("_side") == 0), spread).otherwise(F.lit(0))
    )


def _hot_keys(both: DataFrame, target_rows: int, max_hot_keys: int) -> DataFrame:
    """(_hk, _hq, _hbounds) for keys with more rows than the bucket target: quantiles of the key's times, and those
    without repeats.

    Rows per key come from a partial + final aggregate (one row per key and
    map task is shuffled).  target = max(target_rows, total / max_hot_keys),
    so fewer than max_hot_keys keys can exceed it.
    """
    total = both.agg(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery, evaluated once
    target = F.greatest(F.lit(int(target_rows)), F.ceil(total / F.lit(int(max_hot_keys)))).cast("long")
    hot = both.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target).select("_key")
    times = both.where(F.col("_us").isNotNull()).select("_key", "_us").join(F.broadcast(hot), "_key", "left_semi")
    cuts = [k / PARTS for k in range(1, PARTS)]
    return times.groupBy("_key").agg(F.percentile_approx("_us", cuts, 20 * PARTS).alias("_hq")).select(
        F.col("_key").alias("_hk"), "_hq", F.array_distinct("_hq").alias("_hbounds")
    )
