"""Surrogate keys: md5 over the text form of the key columns.

Same shape as the public dbt_utils ``generate_surrogate_key`` macro: each
part is cast to text, NULL is replaced by a sentinel, parts are joined by
'-' and the joined text is hashed with md5 (32 hex characters).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the NULL sentinel of the public surrogate-key macro.
NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols
    ]
    text = parts[0] if len(parts) == 1 else F.concat_ws("-", *parts)
    return F.md5(text)


def constant_key(value: str) -> Column:
    """Key of a fixed member such as 'unattributed' or 'unknown'."""
    return F.md5(F.lit(value))
