"""Best-fit packing of token pieces into fixed-length sequences.

A configuration (a multiset of lengths that fits one sequence) is priced by
knapsack dynamic programming; the configuration linear program over the
length histogram is solved by multiplicative weights; its rounding gives
pattern classes (lengths, how many sequences look like this) without padding,
and what is left is packed best-fit on the histogram.  All of that works on at most
``capacity`` distinct lengths, whatever the number of pieces.  The pieces
themselves are tokenised, ranked within their length and placed by Spark.

Defined cases: null text is empty (one piece: the end id); repeated rows and
null ids are packed as separate documents; an empty table gives no pieces;
only documents longer than ``capacity`` are cut, their first piece taking the
remainder; extra columns are ignored by ``pack`` and kept by ``pack_documents``.
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

CAPACITY = 2048
END_ID = 0
#: Length classes and iterations of the linear program.
CLASSES = 160
ROUNDS = 300
#: Shares of the solution that are tried as patterns; the rest, of all lengths, is packed best-fit.
SHARES = (1.0, 0.6, 0.3, 0.1, 0.0)
#: Pieces under 1 / SHORT_SHARE of a sequence are kept for the gaps.
SHORT_SHARE = 16
#: Texts tokenised at a time.
STEP = 256
#: Bits for a rank within its length, beside the length in one 64-bit key.
RANK_BITS = 44

PIECES = (
    "doc_id long, piece int, start long, length int, ids_crc32 long, part int, rank long"
)


# ---- the plan: from a histogram of lengths to pattern classes ----


def _classes(lengths: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Class number of each length (ascending): neighbours of about equal total count share one."""
    if len(lengths) <= most:
        return np.arange(len(lengths))
    share = np.cumsum(counts) - counts / 2
    cut = np.minimum((share / counts.sum() * most).astype(int), most - 1)
    return np.unique(cut, return_inverse=True)[1]


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each size in the configuration of most worth (unbounded knapsack by capacity)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    s, w = sizes[order], worth[order]
    upto = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], last[c] = best[c - 1], -1
        k = upto[c]
        if k:
            gain = best[c - s[:k]] + w[:k]
            j = int(gain.argmax())
            if gain[j] > best[c]:
                best[c], last[c] = gain[j], j
    copies = np.zeros(len(sizes), dtype=np.int64)
    c = capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
            continue
        copies[order[last[c]]] += 1
        c -= int(s[last[c]])
    return copies


def solve_configurations(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS, step: float = 0.25
) -> list[tuple[np.ndarray, float]]:
    """Multiplicative weights for  min sum x_c  with  sum a_ic x_c >= demand_i.

    Each round prices one configuration under the present weights, buys enough
    of it to cover ``step`` of the scarcest of its demands, and lowers the
    weights of what it covered.  Returns (copies of each size, amount).
    """
    covered = np.zeros(len(sizes))
    bought: dict[bytes, list] = {}
    # The weight of a demand falls with its coverage; sizes weigh in so that equal weights price by length.
    for _ in range(rounds):
        weight = np.exp(-(covered - covered.min()) * 4) * sizes
        worth = weight / weight.max()
        copies = _knapsack(sizes, worth, capacity)
        used = copies > 0
        if not used.any():
            break
        amount = step * float((demand[used] / copies[used]).min())
        covered += copies * amount / demand
        slot = bought.setdefault(copies.tobytes(), [copies, 0.0])
        slot[1] += amount
    # scaled so that every demand is met: the solution is feasible
    return [(c, x / max(covered.min(), 1e-9)) for c, x in bought.values()] if len(covered) else []


def plan_sequences(lengths: list[int], counts: list[int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Pattern classes (lengths in order, number of sequences) that place every piece.

    The LP solution is rounded for each share of ``SHARES``, and the plan with
    the fewest sequences is taken, of equals that with the most pieces in
    patterns.  The number of classes is bounded by the distinct lengths, not by
    the counts.
    """
    order = np.argsort(lengths)
    sizes = np.asarray(lengths, dtype=np.int64)[order]
    left = np.asarray(counts, dtype=np.int64)[order]
    done: list[tuple[list[int], int]] = [([int(l)], int(c)) for l, c in zip(sizes, left) if l >= capacity and c]
    keep = (sizes < capacity) & (left > 0)
    sizes, left = sizes[keep], left[keep]
    if not len(sizes):
        return done
    # short pieces stay for the gaps: no pattern uses them up
    able = sizes >= capacity // SHORT_SHARE
    chosen: list[tuple[np.ndarray, float]] = []
    group, tops = np.full(len(sizes), -1), np.zeros(0, dtype=np.int64)
    if able.any():
        group[able] = _classes(sizes[able], left[able], CLASSES)
        n_groups = int(group.max()) + 1
        tops = np.array([sizes[group == g].max() for g in range(n_groups)])
        chosen = solve_configurations(tops, np.bincount(group[able], weights=left[able], minlength=n_groups), capacity)
    # fullest configurations first; each is realised by exact lengths of its classes, longest first
    chosen.sort(key=lambda cx: (int(capacity - (cx[0] * tops).sum()), -cx[1]))
    plans = []
    for share in SHARES:
        rest = left.copy()
        open_bins = _realised([(c, int(x * share)) for c, x in chosen], sizes, rest, group, capacity)
        plans.append(_best_fit(open_bins, sizes, rest, capacity))
    return done + min(plans, key=lambda plan: sum(many for _, many in plan))


def _realised(
    wanted_of: list[tuple[np.ndarray, int]], sizes: np.ndarray, left: np.ndarray, group: np.ndarray, capacity: int
) -> list[tuple[int, list[int], int]]:
    """(0, lengths, how many) of the full sequences that the rounded configurations give; takes their pieces out of ``left``."""
    members = [np.flatnonzero(group == g)[::-1].tolist() for g in range(int(group.max()) + 1)]
    place = {int(v): i for i, v in enumerate(sizes)}
    bins: list[tuple[int, list[int], int]] = []
    for copies, todo in wanted_of:
        while todo > 0:
            slots: list[int] = []
            need: dict[int, int] = {}
            free = capacity
            wanted = [g for g in np.flatnonzero(copies)[::-1].tolist() for _ in range(int(copies[g]))]
            head = wanted[:-1] if len(wanted) > 1 else wanted
            for k, g in enumerate(head):
                able = [i for i in members[g] if left[i] > need.get(i, 0)]
                if not able:
                    break
                pick = able[0]
                if k == len(head) - 1:  # with the piece after it, fill the sequence exactly if some pair does
                    for i in able:
                        j = place.get(free - int(sizes[i]), -1)
                        if free == sizes[i] or (j >= 0 and group[j] >= 0 and left[j] > need.get(j, 0) + (i == j)):
                            pick = i
                            break
                need[pick] = need.get(pick, 0) + 1
                slots.append(pick)
                free -= int(sizes[pick])
            if len(slots) < max(1, len(wanted) - 1):
                break  # a class ran out: the rest is left to best fit
            while True:  # the last slot takes the longest piece that fits, and so on while one does
                i = int(np.searchsorted(sizes, free, side="right")) - 1
                while i >= 0 and (left[i] <= need.get(i, 0) or group[i] < 0):
                    i -= 1
                if i < 0:
                    break
                need[i] = need.get(i, 0) + 1
                slots.append(i)
                free -= int(sizes[i])
            many = min(todo, min(int(left[i]) // k for i, k in need.items()))
            if many == 0 or free > 0:
                break  # only sequences without padding
            for i, k in need.items():
                left[i] -= many * k
            bins.append((0, [int(sizes[i]) for i in slots], many))
            todo -= many
            members = [[i for i in m if left[i] > 0] for m in members]
    return bins


def _best_fit(bins, sizes, left, capacity) -> list[tuple[list[int], int]]:
    """Leftover pieces, longest first, into the fullest pattern class that has room; new sequences where none has."""
    by_free: dict[int, list[tuple[list[int], int]]] = {}
    for free, used, many in bins:
        by_free.setdefault(free, []).append((used, many))
    frees = sorted(by_free)
    import bisect

    def put(free: int, used: list[int], many: int) -> None:
        if free not in by_free:
            by_free[free] = []
            bisect.insort(frees, free)
        by_free[free].append((used, many))

    for i in range(len(sizes) - 1, -1, -1):
        size, todo = int(sizes[i]), int(left[i])
        while todo > 0:
            at = bisect.bisect_left(frees, size)
            if at == len(frees):
                fit = capacity // size
                full, rest = divmod(todo, fit)
                if full:
                    put(capacity - fit * size, [size] * fit, full)
                if rest:
                    put(capacity - rest * size, [size] * rest, 1)
                break
            free = frees[at]
            used, many = by_free[free].pop()
            if not by_free[free]:
                del by_free[free]
                frees.pop(at)
            fit = free // size  # as many into each as fit, or what is left
            each = min(fit, -(-todo // many))
            take = min(many, todo // each)
            if take == 0:
                each, take = todo, 1
            put(free - each * size, used + [size] * each, take)
            if many > take:
                put(free, used, many - take)
            todo -= take * each
    return [(used, many) for free in frees for used, many in by_free[free]]


# ---- the pieces: tokenised, ranked and placed by Spark ----


def _cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first takes the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _piece_rows(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    words, seen = tokenizer(path, True), np.zeros(capacity + 1, dtype=np.int64)
    end = np.array([END_ID], dtype="<u4").tobytes()
    for batch in batches:
        rows: list[tuple] = []
        for at in range(0, batch.num_rows, STEP):
            some = batch.slice(at, STEP)
            for doc, ids in zip(some.column(0).to_pylist(), words.encode(some.column(1).to_pylist())):
                ids += end
                for k, (start, n) in enumerate(_cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + n)])
                    rows.append((doc, k, start, n, crc, part, int(seen[n])))
                    seen[n] += 1
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
            )


def _places(batches: Iterator[pa.RecordBatch], slots) -> Iterator[pa.RecordBatch]:
    """Adds sequence_id and offset: the slot whose run of ranks holds the piece's rank within its length."""
    length, low, base, offset = slots.value
    key = (length << RANK_BITS) + low
    for batch in batches:
        n = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
        rank = batch.column("rank").to_numpy(zero_copy_only=False)
        at = np.searchsorted(key, (n << RANK_BITS) + rank, side="right") - 1
        out = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        yield pa.RecordBatch.from_arrays(
            [*out.columns, pa.array(base[at] + rank - low[at]), pa.array(offset[at])],
            names=[*out.schema.names, "sequence_id", "offset"],
        )


def slot_table(plan: list[tuple[list[int], int]]) -> tuple[np.ndarray, ...]:
    """Arrays (length, first rank, first sequence, offset) sorted by length and rank.

    The pattern classes hand out the ranks of each length in turn; a slot of a
    class of m sequences takes m ranks and places them in m successive sequences.
    """
    next_rank: dict[int, int] = {}
    rows, base = [], 0
    for used, many in plan:
        offset = 0
        for size in used:
            low = next_rank.get(size, 0)
            rows.append((size, low, base, offset))
            next_rank[size] = low + many
            offset += size
        base += many
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = documents.sparkSession
    cut = documents.select("doc_id", "text").mapInArrow(lambda b: _piece_rows(b, tokenizer_path, capacity), PIECES)
    # Stored: a piece's rank within its task and length must be the same in each later pass.
    pieces = stored(cut, "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_sequences(list(histogram), list(histogram.values()), capacity)
    slots = spark.sparkContext.broadcast(slot_table(plan))  # by length and pattern: a few MB at most
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        lambda b: _places(b, slots),
        "doc_id long, piece int, start long, length int, ids_crc32 long, sequence_id long, offset long",
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"))
    return packed.withColumn("length", F.col("length").cast("long"))
