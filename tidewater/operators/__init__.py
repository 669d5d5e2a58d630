"""Operators Spark has no single built-in for, composed from DataFrame ops."""

from tidewater.operators.asof import asof_last_before
from tidewater.operators.ntile import exact_ntile
from tidewater.operators.scd2 import scd2_merge, scd2_splice

__all__ = ["asof_last_before", "exact_ntile", "scd2_merge", "scd2_splice"]
