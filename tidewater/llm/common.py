"""Shared helpers of the text operators: table access, shared folder, sizing."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    A lost executor costs only the tasks that were writing: the finished table
    is in shared storage and is read again from there.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, or a longer one, that none of ``columns`` has (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(n_bytes: int, per_piece: int, at_least: int = 1) -> int:
    """How many groups of about ``per_piece`` bytes hold ``n_bytes``."""
    return max(at_least, -(-int(n_bytes) // per_piece))
