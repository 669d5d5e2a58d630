"""Bucketed layout: raw tables stored so that joins by order need no shuffle.

Orders, their items and their payments are written once, hash-partitioned on
``order_id`` into the same number of buckets.  Every later job that joins or
groups them by order (order enrichment, the line fact, the RFM base) then reads
matching buckets in one task each; the line items, the largest table, are not
exchanged again.  Customers are bucketed by ``customer_id``; products and
events are plain Parquet.

A layout is a folder: one sub-folder per table, and ``_layout`` (key, buckets and
columns of each table), written last, so a folder without it is an unfinished
layout and is refused.  Buckets belong to Spark's table catalog, so the tables
are registered in the session under generated names; nothing else about the
catalog is used, and the folder can be opened in any session.

Choose at least as many buckets as ``spark.sql.shuffle.partitions``: with fewer,
Spark prefers to shuffle both sides of a join whose other side is not bucketed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources import RawSources
from tidewater.sources.contracts import CONTRACTS, conform

# raw table -> bucketing key
BUCKET_KEYS = {
    "raw_orders": "order_id",
    "raw_order_items": "order_id",
    "raw_payments": "order_id",
    "raw_customers": "customer_id",
}
MANIFEST = "_layout"


class LayoutError(ValueError):
    pass


def _table_name() -> str:
    return f"tidewater_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` at ``path`` in ``buckets`` files, one per bucket of ``key``, sorted by it; the stored table."""
    name = _table_name()
    # the same hash as the buckets', so each task holds exactly one bucket
    laid_out = df.repartition(buckets, F.col(key)).sortWithinPartitions(key)
    (laid_out.write.format("parquet").mode("errorifexists").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """Register files that ``write_bucketed`` left at ``path`` in this session's catalog."""
    name = _table_name()
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lay_out(raw: RawSources, root: str, buckets: int | None = None) -> RawSources:
    """Write the six raw tables under ``root`` (a new folder) and read them from there."""
    tables = raw.as_dict()
    spark = next(iter(tables.values())).sparkSession
    buckets = buckets or default_buckets(spark)
    entries = []
    for name, table in tables.items():
        path, key = f"{root.rstrip('/')}/{name}", BUCKET_KEYS.get(name)
        if key:
            write_bucketed(table, path, key, buckets)
        else:
            table.write.mode("errorifexists").parquet(path)
        entries.append((name, key, buckets if key else None, _columns(table)))
    manifest = spark.createDataFrame(entries, "name string, key string, buckets int, columns string")
    manifest.coalesce(1).write.mode("errorifexists").json(f"{root.rstrip('/')}/{MANIFEST}")
    return open_layout(spark, root)


def open_layout(spark: SparkSession, root: str) -> RawSources:
    """The raw tables of a folder that ``lay_out`` finished."""
    root = root.rstrip("/")
    try:
        manifest = spark.read.schema("name string, key string, buckets int, columns string").json(f"{root}/{MANIFEST}")
        entries = {r["name"]: r for r in manifest.collect()}  # one row per raw table
    except AnalysisException as e:
        raise LayoutError(f"{root} holds no finished layout") from e
    if missing := sorted(set(CONTRACTS) - set(entries)):
        raise LayoutError(f"{root}: the layout lacks {missing}")

    def table(name: str) -> DataFrame:
        entry, path = entries[name], f"{root}/{name}"
        if entry["key"]:
            found = open_bucketed(spark, path, entry["columns"], entry["key"], entry["buckets"])
        else:
            found = spark.read.parquet(path)
        return conform(found, CONTRACTS[name], name)

    return RawSources(**{name.removeprefix("raw_"): table(name) for name in CONTRACTS})


def count_rows(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, row_count) of a finished layout, from the Parquet footers alone.

    The count is pushed down to Spark's newer Parquet reader, which adds up the
    row counts of the row groups; no column is read.  That reader and its push-down
    are settings, so the counts run in a session of their own, which shares
    nothing else with ``spark``.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.parquet.filterPushdown", "true")
    tables = open_layout(spark, root).as_dict()  # refuses an unfinished layout
    counts = [
        own.read.parquet(f"{root.rstrip('/')}/{name}").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count") for name in tables
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
