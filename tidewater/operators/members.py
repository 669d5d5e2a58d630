"""Membership of whole-number ids in a dimension, without an exchange of the rows that ask.

The dimension's ids are packed 64 to a word, so its table of (word, bits) has
about a 64th of its rows where ids are dense, and never more.  The table is
written, so Spark knows its size: a small one is broadcast, a large one is
shuffled and joined by word like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import write_checkpoint_table


def with_members(df: DataFrame, column: str, ids: DataFrame, into: str) -> DataFrame:
    """``df`` left-joined to ``ids`` (one column of whole numbers) on ``column``: ``into`` is true for a match, else null.

    As in the join, a row comes once for each equal id, and a null matches nothing.
    """
    ids = ids.toDF("_id").where("_id is not null")
    if not ids.groupBy("_id").count().where("count > 1").isEmpty():
        found = ids.withColumn(into, F.lit(True))
        return df.join(found, df[column] == found["_id"], "left").drop("_id")
    words = ids.groupBy(F.shiftright("_id", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, int(_id & 63)))").alias("_bits")
    )
    words = write_checkpoint_table(words, "members")
    # null also where the word has no bit for the id
    bit = F.getbit("_bits", F.col(column).bitwiseAND(63).cast("int")) == 1
    joined = df.join(words, F.shiftright(df[column], 6) == words["_word"], "left")
    return joined.withColumn(into, F.when(bit, F.lit(True))).drop("_word", "_bits")
