"""DuckDB SQL for the unsigned CRC-32 of a string's UTF-8 bytes, which DuckDB has no function for.

``CRC_TABLE`` is the body of a one-row CTE with column ``crc_tab`` (256
remainders, made by rule); ``crc32_sql`` is an expression over a string for
queries that cross join that row.
"""

from __future__ import annotations

#: Fixed value: the polynomial of CRC-32 (zlib), bits reversed.
POLYNOMIAL = 0xEDB88320

CRC_TABLE = f"""
SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, list_transform(range(8), lambda i: 0::BIGINT)),
    lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, {POLYNOMIAL}::BIGINT) ELSE r >> 1 END)) AS crc_tab
"""


def crc32_sql(text: str) -> str:
    codes = (
        f"list_transform(range(1, strlen({text}) + 1), "
        f"lambda i: CAST('0x' || substr(hex({text}), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT))"
    )
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
        "lambda r, b: xor(r >> 8, crc_tab[CAST(xor(r & 255, b) AS BIGINT) + 1])), 4294967295::BIGINT)"
    )
