"""Type-2 slowly changing dimension merge (batch).

Given the stored history (rows with effective_from / effective_to /
is_current) and a new snapshot, produce the new history:

* unchanged current rows stay as they are;
* a current row whose tracked columns changed is closed at ``change_at``
  and a new current row opens at ``change_at``;
* keys new in the snapshot open a current row at ``change_at``;
* keys missing from the snapshot stay current (no hard-delete handling);
* closed rows are carried over untouched.

Change detection compares the tracked columns themselves, null-safe, in one
full outer join on the natural key (hash-partitioned on the key; AQE splits
skewed keys); each joined row gives its one or two history rows by ``inline``.
A NULL key is a key like any other: it is kept once.  The history key is
md5(natural key, effective_from).

``scd2_splice`` is the form for snapshots that may come late and from which keys
may be missing: the history it keeps is the one that all snapshots taken in time
order give, whatever the order of their arrival.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.dates import ntz
from tidewater.functions.keys import surrogate_key

OPEN_END = dt.datetime(9999, 12, 31)


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    *,
    key: str,
    tracked: list[str],
    change_at: dt.datetime,
    history_key: str = "history_key",
) -> DataFrame:
    """Merge ``snapshot`` into ``history`` (both hold ``key`` and the attribute columns)."""
    attrs = [c for c in snapshot.columns if c != key]
    meta = ["effective_from", "effective_to", "is_current"]
    at, end = ntz(change_at), ntz(OPEN_END)

    old = history.where("is_current").select(F.struct(key, *attrs, *meta).alias("_old"))
    new = snapshot.select(F.struct(key, *attrs).alias("_new"))
    j = old.join(new, F.col(f"_old.{key}").eqNullSafe(F.col(f"_new.{key}")), "full_outer")

    def version(side: str, start: F.Column, stop: F.Column, current: bool) -> F.Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in (key, *attrs)],
            start.alias("effective_from"), stop.alias("effective_to"), F.lit(current).alias("is_current"),
        )

    kept = version("_old", F.col("_old.effective_from"), F.col("_old.effective_to"), True)
    closed = version("_old", F.col("_old.effective_from"), at, False)
    opened = version("_new", at, end, True)
    same = F.struct(*[F.col(f"_old.{c}") for c in tracked]).eqNullSafe(F.struct(*[F.col(f"_new.{c}") for c in tracked]))
    rows = (
        F.when(F.col("_old").isNull(), F.array(opened))
        .when(F.col("_new").isNull() | same, F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    past = history.where("not is_current").select(key, *attrs, *meta)
    out = past.unionByName(j.select(F.inline(rows)))
    return out.select(surrogate_key(key, "effective_from").alias(history_key), key, *attrs, *meta)


def scd2_initial(snapshot: DataFrame, *, key: str, effective_from: F.Column, history_key: str = "history_key") -> DataFrame:
    """First load: every row current from ``effective_from`` to the open end."""
    attrs = [c for c in snapshot.columns if c != key]
    return snapshot.select(
        key,
        *attrs,
        effective_from.cast("timestamp_ntz").alias("effective_from"),
        ntz(OPEN_END).alias("effective_to"),
        F.lit(True).alias("is_current"),
    ).select(surrogate_key(key, "effective_from").alias(history_key), key, *attrs, "effective_from", "effective_to", "is_current")


def scd2_splice(
    history: DataFrame,
    snapshot: DataFrame,
    *,
    key: str,
    tracked: list[str],
    at: dt.datetime,
    observed: list[dt.datetime],
    history_key: str = "history_key",
) -> DataFrame:
    """Splice the snapshot taken ``at`` into a history built from those taken at ``observed``.

    A snapshot says what holds from ``at`` until the next observed time.  So for
    every key the version that covers ``at`` is cut there; the snapshot's row, if
    it has one, goes in until the next observed time; and from then on the old
    version goes on.  A key that the snapshot lacks has no version in between, and
    has one again where a later snapshot had it.  Neighbouring versions that touch
    and agree in the tracked columns become one, with the attributes of the first.

    The history may have gaps; ``snapshot`` has a row per key.  One full outer join
    on the key takes only the versions that cover ``at``; the window that unites
    versions holds one key's versions, at most one per snapshot.
    """
    attrs = [c for c in snapshot.columns if c != key]
    meta = ["effective_from", "effective_to"]
    start, stop = ntz(at), ntz(min((t for t in observed if t > at), default=OPEN_END))
    covers = (F.col("effective_from") <= start) & (F.col("effective_to") > start)
    live = history.where(covers).select(F.struct(key, *attrs, *meta).alias("_old"))
    new = snapshot.select(F.struct(key, *attrs).alias("_new"))
    j = live.join(new, F.col(f"_old.{key}").eqNullSafe(F.col(f"_new.{key}")), "full_outer")

    def version(side: str, begin: F.Column, end: F.Column) -> F.Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in (key, *attrs)],
                        begin.alias("effective_from"), end.alias("effective_to"))

    old_from, old_to = F.col("_old.effective_from"), F.col("_old.effective_to")
    same = F.struct(*[F.col(f"_old.{c}") for c in tracked]).eqNullSafe(F.struct(*[F.col(f"_new.{c}") for c in tracked]))
    before, after = version("_old", old_from, start), version("_old", stop, old_to)
    rows = (
        F.when(F.col("_old").isNull(), F.array(version("_new", start, stop)))
        .when(F.col("_new").isNull(), F.array(before, after))
        .when(same, F.array(version("_old", old_from, old_to)))
        .otherwise(F.array(before, version("_new", start, F.least(stop, old_to)), after))
    )
    pieces = j.select(F.inline(rows)).where("effective_from < effective_to")
    versions = history.where(~covers).select(key, *attrs, *meta).unionByName(pieces)
    return _united(versions, key, attrs, tracked, history_key)


def _united(versions: DataFrame, key: str, attrs: list[str], tracked: list[str], history_key: str) -> DataFrame:
    """Versions that touch and agree in the tracked columns, as one."""
    by_time = Window.partitionBy(key).orderBy("effective_from")
    state = F.struct(*tracked)
    joins_on = (F.lag("effective_to").over(by_time) == F.col("effective_from")) & F.lag(state).over(by_time).eqNullSafe(state)
    runs = versions.withColumn("_opens", F.when(joins_on, 0).otherwise(1)).withColumn("_run", F.sum("_opens").over(by_time))
    first = F.min_by(F.struct(*attrs), "effective_from")
    out = runs.groupBy(key, "_run").agg(
        first.alias("_first"), F.min("effective_from").alias("effective_from"), F.max("effective_to").alias("effective_to")
    )
    return out.select(
        surrogate_key(key, "effective_from").alias(history_key), key, *[F.col(f"_first.{c}").alias(c) for c in attrs],
        "effective_from", "effective_to", (F.col("effective_to") == ntz(OPEN_END)).alias("is_current"),
    )
