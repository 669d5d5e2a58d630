"""Exact ntile by order statistics: find the rows where tiles begin, then compare.

A tile edge is the row at a known position of its group's order.  That row is
selected without sorting anything: its sort key, a few 64-bit integers, is found
16 bits at a time.  Each pass counts the rows that agree with the bits found so
far by their next 16 bits, and the running count over those (at most 65,536)
bins tells in which of them the position lies.  Once every bin holds at most
``SMALL`` rows, a window over just those rows picks the edge.

Passes read only the key columns and exchange at most one row per bin and map
task, and what comes back to the driver is one row per edge.  The tile of a row
is then one more than the number of edges at or before it, an expression
without any exchange.  Ties cost nothing extra: a value shared by a third of the
rows is told apart by the next key, and the last key must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16
SMALL = 100_000
LEAST = -(1 << 63)


def tile_starts(n: int, tiles: int) -> list[int]:
    """Positions (0-based) at which tiles 2, 3, ... begin among ``n`` rows; the first n mod tiles tiles hold one row more."""
    q, r = divmod(n, tiles)
    return [s for t in range(1, tiles) if (s := t * q + min(t, r)) < n]


def tile_edges(rows: DataFrame, group: str, keys: list[str], tiles: int, small: int = SMALL) -> dict[object, list[tuple]]:
    """group -> keys of the rows that open tiles 2, 3, ...

    ``keys`` are non-null longs whose last makes them unique; ``group`` must
    have few distinct values.
    """
    if tiles < 1:
        raise ValueError("tiles must be >= 1")
    spark = rows.sparkSession
    rows = rows.select(F.col(group).alias("_g"), *[F.col(k).bitwiseXOR(F.lit(LEAST)).alias(f"_u{i}") for i, k in enumerate(keys)])
    sizes = {r["_g"]: r["count"] for r in rows.groupBy("_g").count().collect()}
    # an edge: its group, position among the rows of its bin, and the bits found so far as one list of digits
    edges = [{"g": g, "rank": s, "bits": ()} for g, n in sizes.items() for s in tile_starts(n, tiles)]
    largest, per_key = max(sizes.values(), default=0), 64 // DIGIT

    def in_bins(level: int) -> tuple[DataFrame, dict]:
        """The rows of the edges' bins, with the number of the bin."""
        bins = {b: i for i, b in enumerate(dict.fromkeys((e["g"], e["bits"]) for e in edges))}
        full, part = divmod(level, per_key)
        have = [_value(F.col(f"_u{i}"), per_key) for i in range(full)]
        if part:
            have.append(_value(F.col(f"_u{full}"), part))
        listed = [(i, g, *_key_parts(bits, per_key)) for (g, bits), i in bins.items()]
        names = ", ".join(f"_p{j} long" for j in range(len(have)))
        kind = rows.schema["_g"].dataType.simpleString()
        table = spark.createDataFrame(listed, f"_bin int, _bg {kind}" + (f", {names}" if names else ""))
        same = F.col("_g").eqNullSafe(F.col("_bg"))
        for j, col in enumerate(have):
            same = same & (col == F.col(f"_p{j}"))
        return rows.join(F.broadcast(table), same), bins  # at most one row per edge

    level = 0
    while edges and largest > small and level < per_key * len(keys):
        found, bins = in_bins(level)
        key, digit = divmod(level, per_key)
        next_bits = F.shiftrightunsigned(F.col(f"_u{key}"), 64 - DIGIT * (digit + 1)).bitwiseAND(F.lit((1 << DIGIT) - 1))
        counts = found.groupBy("_bin", next_bits.alias("_digit")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy("_bin").orderBy("_digit"))
        ranks = spark.createDataFrame(
            [(i, bins[e["g"], e["bits"]], e["rank"]) for i, e in enumerate(edges)], "_edge int, _ebin int, _rank long"
        )
        running = counts.withColumn("_upto", upto)
        hit = running.join(F.broadcast(ranks), (F.col("_bin") == F.col("_ebin")) & (F.col("_rank") < F.col("_upto"))
                           & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
        largest = 0
        for r in hit.collect():  # one row per edge
            e = edges[r["_edge"]]
            e["rank"] -= r["_upto"] - r["_n"]
            e["bits"] += (r["_digit"],)
            largest = max(largest, r["_n"])
        level += 1
    if not edges:
        return {g: [] for g in sizes}
    found, bins = in_bins(level)
    columns = [f"_u{i}" for i in range(len(keys))]
    order = [_unsigned(c) for c in columns]
    placed = found.withColumn("_at", F.row_number().over(Window.partitionBy("_bin").orderBy(*order)) - 1)
    wanted = spark.createDataFrame([(bins[e["g"], e["bits"]], e["rank"]) for e in edges], "_ebin int, _rank long").distinct()
    picked = placed.join(F.broadcast(wanted), (F.col("_bin") == F.col("_ebin")) & (F.col("_at") == F.col("_rank")))
    values = {(r["_bin"], r["_at"]): tuple(_signed(r[c]) for c in columns) for r in picked.collect()}  # one row per edge
    out: dict[object, list[tuple]] = {g: [] for g in sizes}
    for e in edges:
        out[e["g"]].append(values[bins[e["g"], e["bits"]], e["rank"]])
    return out


def _value(col: Column, digits: int) -> Column:
    """The first ``digits`` digits of a key."""
    return F.shiftrightunsigned(col, 64 - DIGIT * digits) if digits * DIGIT < 64 else col


def _key_parts(bits: tuple[int, ...], per_key: int) -> list[int]:
    """Digits as one number for each key, whole keys as signed 64-bit numbers."""
    out = []
    for at in range(0, len(bits), per_key):
        part = bits[at : at + per_key]
        value = 0
        for d in part:
            value = value << DIGIT | d
        out.append(value - (1 << 64) if len(part) == per_key and value >= 1 << 63 else value)
    return out


def _unsigned(name: str) -> Column:
    return F.col(name).bitwiseXOR(F.lit(LEAST))


def _signed(value: int) -> int:
    return value ^ LEAST if value >= 0 else (value + (1 << 64) ^ (1 << 63))


def tile_of(group: Column, keys: list[Column], edges: dict[object, list[tuple]]) -> Column:
    """1 + the number of the group's edges at or before the row."""
    here, tile = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]), F.lit(None).cast("int")
    for g, starts in edges.items():
        n = F.lit(1)
        for start in starts:
            n = n + (here >= F.struct(*[F.lit(x).cast("long").alias(f"k{i}") for i, x in enumerate(start)])).cast("int")
        tile = F.when(group.eqNullSafe(F.lit(g)), n).otherwise(tile)
    return tile
