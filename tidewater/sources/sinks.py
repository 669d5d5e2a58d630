"""Sink for bulk loads into a relational database: batches of 5,000 rows, replacing
the table (``truncate`` keeps its definition).  The write is spread over the
DataFrame's partitions, one connection each.  Tables in files are refreshed
through ``sources.snapshots``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               batchsize: int = 5000, num_partitions: int | None = None) -> None:
    """Replace ``table`` over JDBC with ``df`` (batched inserts)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    (out.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", str(batchsize))
        .option("truncate", "true")
        .options(**(properties or {}))
        .mode("overwrite")
        .save())
