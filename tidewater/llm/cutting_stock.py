"""Packing documents into padded sequences, planned as a cutting-stock problem.

A sequence costs ``capacity`` tokens, or its own length where that is a power
of two.  Documents longer than ``capacity`` give full sequences and one rest;
what is to be planned is the histogram of the rests and of the shorter
documents, fewer than ``capacity`` lengths whatever the number of documents:

* The linear program over patterns (multisets of lengths) is solved by column
  generation.  As cutting is free, a pattern with padding is never needed: its
  pieces are better left loose, which costs their tokens.  The first basis is
  made of exact fills, longest piece first; a knapsack by dynamic programming
  over exact sums prices further patterns under the present duals, and the
  revised simplex method takes several columns from one pricing.
* Patterns are rounded down, then used again as long as pieces for them are
  left; what remains is filled exactly by bounded subset sums.
* Pieces that no pattern holds without padding are laid end to end and cut at
  sequence ends (cutting is free), the last of them at powers of two.  So
  nothing is padded, and documents are cut only where no pattern took them.

Spark tokenises the documents, ranks the pieces within their length and hands
each rank its place; cut documents alone are tokenised a second time, for the
checksums of their parts.

Defined cases: null text is empty (the end id alone); repeated rows and null
ids are documents of their own; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stored, table
from tidewater.llm.tokens import public_file, tokenizer

CAPACITY = 1024
END_ID = 0
#: The linear program ends when no more than this share of the tokens is loose, or after so many pivots.
GAP = 0.0005
PIVOTS = 600
#: Columns taken from one pricing.
COLUMNS = 40
#: Texts tokenised at a time.
STEP = 256
RANK_BITS = 44

KEY = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, rank long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def padded(total: int, capacity: int = CAPACITY) -> int:
    """What a sequence of ``total`` tokens costs."""
    return total if total & (total - 1) == 0 else capacity


# ---- the plan ----


def _price(sizes: np.ndarray, duals: np.ndarray, capacity: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack by exact sums: most worth of k pieces that add up to s, and the size taken last (-1: none), for k <= most.

    Patterns of very many tiny pieces would use up what fills the others' gaps, hence the bound on pieces.
    """
    best = np.full((most + 1, capacity + 1), -np.inf)
    last = np.full((most + 1, capacity + 1), -1)
    best[0, 0] = 0.0
    rest = np.arange(capacity + 1)[:, None] - sizes[None, :]
    inside = rest >= 0
    rest[~inside] = 0
    for k in range(1, most + 1):
        worth = np.where(inside, best[k - 1][rest] + duals, -np.inf)
        j = worth.argmax(axis=1)
        best[k] = worth[np.arange(capacity + 1), j]
        last[k] = np.where(best[k] > -np.inf, j, -1)
    return best, last


def _column(first: int, total: int, last: np.ndarray, k: int, sizes: np.ndarray) -> np.ndarray:
    copies = np.zeros(len(sizes))
    if first >= 0:
        copies[first] = 1
    while total > 0:
        j = last[k, total]
        copies[j] += 1
        total, k = total - int(sizes[j]), k - 1
    return copies


def _exact_fill(sizes: list[int], left: list[int], target: int) -> dict[int, int] | None:
    """Pieces (index -> copies) whose lengths add up to ``target`` exactly, the long ones first; None if there are none."""
    parts, reach = [], [1]
    mask = (1 << (target + 1)) - 1
    for i, (size, n) in enumerate(zip(sizes, left)):
        n, k = min(n, target // size), 1
        while n > 0:  # copies in powers of two
            k = min(k, n)
            parts.append((i, k, k * size))
            reach.append((reach[-1] | reach[-1] << k * size) & mask)
            n, k = n - k, 2 * k
    if not reach[-1] >> target & 1:
        return None
    found: dict[int, int] = {}
    for (i, k, size), before in zip(reversed(parts), reversed(reach[:-1])):
        if target >= size and before >> (target - size) & 1:
            found[i] = found.get(i, 0) + k
            target -= size
    return found


def _first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[list[np.ndarray | None], np.ndarray]:
    """A feasible basis: exact fills, longest piece first, each used until one of its lengths is out; u for the others."""
    left, columns, amount = demand.copy(), [None] * len(sizes), demand.copy()
    skipped = np.zeros(len(sizes), dtype=bool)
    while True:
        here = np.flatnonzero((left > 1e-9) & ~skipped)
        if not len(here):
            amount = np.where([c is None for c in columns], left, amount)
            return columns, amount
        top, rest = int(here[-1]), np.ceil(left[here]).astype(int).tolist()
        rest[-1] -= 1
        found = _exact_fill(sizes[here].tolist(), rest, capacity - int(sizes[top]))
        if found is None:
            skipped[top] = True
            continue
        copies = np.zeros(len(sizes))
        copies[top] = 1
        for i, k in found.items():
            copies[here[i]] += k
        used = np.flatnonzero(copies)
        ratio = left[used] / copies[used]
        out, many = int(used[ratio.argmin()]), float(ratio.min())
        left[used] -= many * copies[used]
        left[out] = 0.0
        columns[out], amount[out] = copies, many


def solve_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY, pivots: int = PIVOTS
) -> tuple[list[tuple[np.ndarray, float]], float]:
    """Column generation for  min sum size_i u_i  with  sum a_ip x_p + u_i = demand_i  over patterns p without padding.

    u is what no pattern holds.  A pattern's padded size and the sizes in it
    are the same, so these costs, the tokens left loose, are those of the
    cutting-stock program less the token count.  Returns ([(copies, amount)],
    tokens left loose).
    """
    m = len(sizes)
    full = [s for s in range(1, capacity + 1) if padded(s, capacity) == s]
    # demands a little apart, so that few pivots are degenerate; rounding down takes that back
    costs, amount = sizes.astype(float), demand * (1 + 1e-3 * np.random.default_rng(1).random(m))
    least, done = GAP * float(costs @ amount), 0
    most = max(4, 2 * int(-(-capacity * amount.sum() // (sizes @ amount))))
    columns, amount = _first_basis(sizes, amount, capacity)
    basis = np.eye(m)
    for j, copies in enumerate(columns):
        if copies is not None:
            basis[:, j], costs[j] = copies, 0.0
    inverse = np.linalg.inv(basis)
    duals = costs @ inverse
    while done < pivots and costs @ amount > least:
        best, last = _price(sizes, duals, capacity, most)
        pieces = best.argmax(axis=0)
        best = best.max(axis=0)
        tried = [(best[s], -1, s) for s in full if best[s] > 1e-7]
        gain = duals + best[capacity - sizes]
        tried += [(gain[i], int(i), capacity - int(sizes[i])) for i in np.flatnonzero(gain > 1e-7)]
        tried += [(duals[i] - sizes[i], i, 0) for i in np.flatnonzero(duals - sizes > 1e-7)]  # back to loose
        tried.sort(reverse=True)
        moved, seen = 0, set()
        for _, first, rest in tried:
            if moved >= COLUMNS or done >= pivots:
                break
            loose = first >= 0 and rest == 0
            copies = _column(first, rest, last, int(pieces[rest]), sizes)
            cost = float(sizes[first]) if loose and padded(int(sizes[first]), capacity) != sizes[first] else 0.0
            name = copies.tobytes()
            worth = duals @ copies - cost
            if name in seen or worth < 1e-7:
                continue
            seen.add(name)
            used = np.flatnonzero(copies)
            change = inverse[:, used] @ copies[used]
            can = np.flatnonzero(change > 1e-9)
            if not len(can):
                continue
            ratio = amount[can] / change[can]
            r = int(can[ratio.argmin()])
            taken = float(ratio.min())
            row = inverse[r] / change[r]
            change[r] = 0.0
            rows, cols = np.flatnonzero(np.abs(change) > 1e-13), np.flatnonzero(row)
            inverse[np.ix_(rows, cols)] -= np.outer(change[rows], row[cols])
            inverse[r] = row
            amount -= change * taken
            amount[r] = taken
            np.maximum(amount, 0.0, out=amount)
            duals = duals - worth * row
            columns[r], costs[r] = (copies if cost == 0.0 else None), cost
            moved, done = moved + 1, done + 1
        if not moved:
            break
    return [(c.astype(np.int64), float(x)) for c, x in zip(columns, amount) if c is not None], float(costs @ amount)


def plan(lengths: list[int], counts: list[int], capacity: int = CAPACITY) -> tuple[list[tuple[list[int], int]], list[tuple[int, int]]]:
    """(patterns, loose): (lengths in order, sequences of this kind) without padding, and (length, pieces) to be laid end to end.

    Every piece is in one of the two; both lists are bounded by the distinct
    lengths, not by the counts.
    """
    order = np.argsort(lengths)
    sizes, left = np.asarray(lengths, dtype=np.int64)[order], np.asarray(counts, dtype=np.int64)[order]
    sizes, left = sizes[left > 0], left[left > 0]
    patterns: list[tuple[list[int], int]] = []
    if not len(sizes):
        return patterns, []

    def use(copies: np.ndarray, many: int) -> None:
        used = np.flatnonzero(copies)
        many = min(many, int((left[used] // copies[used]).min()))
        if many > 0:
            left[used] -= many * copies[used]
            patterns.append(([int(sizes[i]) for i in used[::-1] for _ in range(int(copies[i]))], many))

    solved, _ = solve_patterns(sizes, left.astype(float), capacity)
    for copies, x in sorted(solved, key=lambda cx: -cx[1]):
        use(copies, int(x + 1e-6))
    for copies, x in sorted(solved, key=lambda cx: int(cx[1] + 1e-6) - cx[1]):
        use(copies, 1)
    loose: list[tuple[int, int]] = []
    while (left > 0).any():
        here = np.flatnonzero(left)
        top, rest = int(here[-1]), left[here].tolist()
        rest[-1] -= 1
        found = _exact_fill(sizes[here].tolist(), rest, capacity - int(sizes[top]))
        if found is None:
            loose.append((int(sizes[top]), int(left[top])))
            left[top] = 0
            continue
        copies = np.zeros(len(sizes), dtype=np.int64)
        copies[top] = 1
        for i, k in found.items():
            copies[here[i]] += k
        use(copies, int(left[top]))
    return patterns, loose


class Places:
    """Sequence and offset of each (length, rank): slots of patterns, then stretches of the loose pieces' line.

    Full sequences (length = capacity) come after both, one for each rank.
    """

    def __init__(self, patterns: list[tuple[list[int], int]], loose: list[tuple[int, int]], capacity: int = CAPACITY):
        rows, following, base = [], {}, 0
        for used, many in patterns:
            offset = 0
            for size in used:
                low = following.get(size, 0)
                rows.append((size, low, base, offset, 0))
                following[size] = low + many
                offset += size
            base += many
        line = 0
        for size, many in loose:
            rows.append((size, following.get(size, 0), base, line, 1))
            line += size * many
        whole, tail = divmod(line, capacity)
        ends = [1 << b for b in range(capacity.bit_length(), -1, -1) if tail >> b & 1]
        # where the line's last sequences begin, after its whole ones
        self.tail = whole * capacity + np.cumsum([0, *ends])[:-1]
        rows.append((capacity, 0, base + whole + len(ends), 0, 0))
        rows.sort()
        self.size, self.low, self.base, self.at, self.loose = (np.array(c, dtype=np.int64) for c in zip(*rows))
        self.key = (self.size << RANK_BITS) + self.low
        self.capacity, self.whole, self.line = capacity, whole, line

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence, offset, loose): of a loose piece, the line's first sequence and the piece's place on the line."""
        k = np.searchsorted(self.key, (length << RANK_BITS) + rank, side="right") - 1
        nth, loose = rank - self.low[k], self.loose[k] == 1
        return self.base[k] + np.where(loose, 0, nth), self.at[k] + np.where(loose, nth * length, 0), loose

    def cut(self, first: int, at: int, length: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of the parts of a loose piece at place ``at`` of the line."""
        out, done = [], 0
        while done < length:
            here = at + done
            if here < self.whole * self.capacity:
                n, offset = divmod(here, self.capacity)
                end = (n + 1) * self.capacity
            else:
                j = int(np.searchsorted(self.tail, here, side="right"))
                n, offset = self.whole + j - 1, here - int(self.tail[j - 1])
                end = int(self.tail[j]) if j < len(self.tail) else self.line
            take = min(length - done, end - here)
            out.append((done, take, first + n, offset))
            done += take
        return out


# ---- the pieces ----


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)


def _tokenised(batch: pa.RecordBatch, path: str) -> Iterator[tuple]:
    words, end = tokenizer(path, True), np.array([END_ID], dtype="<u4").tobytes()
    for at in range(0, batch.num_rows, STEP):
        some = batch.slice(at, STEP)
        for doc, ids in zip(some.column(0).to_pylist(), words.encode(some.column(1).to_pylist())):
            yield doc, ids + end


def _piece_rows(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    """Full sequences and the rest of each document, ranked within the task and length."""
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
    for batch in batches:
        rows = []
        for doc, ids in _tokenised(batch, path):
            n = len(ids) // 4
            for start in range(0, n, capacity):
                length = min(capacity, n - start)
                rows.append((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, part, seen[length]))
                seen[length] += 1
        if rows:
            yield _batch(rows, [*KEY, "part", "rank"], kinds)


def _place(batches: Iterator[pa.RecordBatch], places, loose: bool) -> Iterator[pa.RecordBatch]:
    """Adds sequence_id and offset to the pieces of patterns, or (``loose``) first and at to those of the line."""
    for batch in batches:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        first, at, on_line = places.value.find(length, rank)
        out = pa.RecordBatch.from_arrays(
            [*batch.select(KEY).columns, pa.array(first), pa.array(at)], names=[*KEY, "sequence_id", "offset"]
        )
        yield out.filter(pa.array(on_line if loose else ~on_line))


def _rests(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    """The rest of each document again, with its ids."""
    for batch in batches:
        rows = []
        for doc, ids in _tokenised(batch, path):
            n = len(ids) // 4
            start = n // capacity * capacity
            if start < n:
                rows.append((doc, start, n - start, zlib.crc32(ids[4 * start :]), n, ids[4 * start :]))
        if rows:
            yield _batch(rows, [*KEY, "ids"], [pa.int64()] * 5 + [pa.binary()])


def _cut_rows(batches: Iterator[pa.RecordBatch], places) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"))
        for doc, start, length, n, ids, first, at in zip(*columns):
            for done, take, sequence, offset in places.value.cut(first, at, length):
                rows.append((doc, start + done, take, zlib.crc32(ids[4 * done : 4 * (done + take)]), n, sequence, offset))
        if rows:
            yield _batch(rows, [*KEY, "sequence_id", "offset"], [pa.int64()] * 7)


def pack_padded(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Stored: a piece's rank within its task and length must be the same in each later pass.
    pieces = stored(texts.mapInArrow(lambda b: _piece_rows(b, tokenizer_path, capacity), PIECES), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    histogram.pop(capacity, None)
    patterns, loose = plan(list(histogram), list(histogram.values()), capacity)
    places = spark.sparkContext.broadcast(Places(patterns, loose, capacity))  # by length and pattern: a few MB at most
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).select(*KEY, (F.col("rank") + F.col("base")).alias("rank"))
    placed = ranked.mapInArrow(lambda b: _place(b, places, False), PLACED)
    if not loose:
        return placed
    lengths = [size for size, _ in loose]
    line = stored(ranked.where(F.col("length").isin(lengths)).mapInArrow(lambda b: _place(b, places, True), PLACED), "line")
    ids = line.select("doc_id").distinct()
    again = texts.join(ids, texts["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    rests = again.mapInArrow(lambda b: _rests(b, tokenizer_path, capacity), ", ".join([f"{c} long" for c in KEY] + ["ids binary"]))
    rests = rests.where(F.col("length").isin(lengths)).dropDuplicates(KEY)
    same = [line[c].eqNullSafe(rests[c]) for c in KEY]
    on_line = line.join(rests, same).select(*[line[c] for c in KEY], "ids", "sequence_id", "offset")
    return placed.unionByName(on_line.mapInArrow(lambda b: _cut_rows(b, places), PLACED))


def op12_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_padded(table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"))
