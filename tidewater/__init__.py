"""tidewater: retail retention analytics as Spark DataFrame jobs.

From order, customer, product, payment and marketing-event tables it builds
a star schema (staging -> intermediate -> marts) and the reports on it:
RFM scoring and segments, last-touch attribution, monthly cohort retention,
lifetime value, revenue/segment/channel reports and data-quality checks.
"""

from tidewater.params import RunParams
from tidewater.plans.graph import ModelGraph
from tidewater.sources import RawSources, from_raw_parquet, from_test_tables

__all__ = ["ModelGraph", "RawSources", "RunParams", "from_raw_parquet", "from_test_tables"]
