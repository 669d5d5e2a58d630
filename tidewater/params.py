"""Run parameters.

The source models read the wall clock (``now()``, ``current_date``,
``current_timestamp``).  Here the clock is a parameter so that every build
is reproducible; ``as_of`` plays the part of the run time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunParams:
    # Run time: replaces now()/current_timestamp; its date replaces current_date.
    as_of: dt.datetime = dt.datetime(2001, 8, 2, 0, 0, 0)
    # Load stamp written by the staging models (defaults to as_of).
    loaded_at: dt.datetime | None = None
    # Date dimension bounds, end exclusive.  None: whole calendar years that
    # contain any order or event (derived from the data by Spark).
    spine_start: dt.date | None = None
    spine_end: dt.date | None = None
    # Trailing window of the RFM model, in days.
    rfm_window_days: int = 365
    # Minimum first-channel group size in the retention-by-channel report.
    min_channel_customers: int = 50
    # Time bucket of the as-of join (seconds) for every customer.  None: only
    # customers with more than asof_target_rows rows are split, each into
    # buckets of about asof_target_rows rows.
    asof_bucket_seconds: int | None = None
    asof_target_rows: int = 1_000_000
    # Range partitions for operators.ntile.exact_ntile (the models' tiles need none); None -> spark.sql.shuffle.partitions.
    rank_partitions: int | None = None
    # Retention windows of the cohort model, in days.
    retention_days: tuple[int, ...] = field(default=(30, 60, 90, 180, 365))

    @property
    def load_stamp(self) -> dt.datetime:
        return self.loaded_at or self.as_of

    @property
    def as_of_date(self) -> dt.date:
        return self.as_of.date()

    @property
    def rfm_cutoff(self) -> dt.datetime:
        """current_date - interval 'N days', at midnight."""
        start = self.as_of_date - dt.timedelta(days=self.rfm_window_days)
        return dt.datetime(start.year, start.month, start.day)


# Spine used by the source project's date dimension when it is built alone
# (fixed values: 2023-07-01 inclusive to 2026-06-30 exclusive).
DEFAULT_SPINE_START = dt.date(2023, 7, 1)
DEFAULT_SPINE_END = dt.date(2026, 6, 30)
