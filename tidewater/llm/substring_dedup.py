"""Removal of repeated byte strings, decided by suffix arrays.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
in a document with a smaller doc_id.

Every such string (a window) has an anchor: of the ``GRAM``-byte grams inside
it the one with the least hash, the leftmost of equals.  The anchor depends on
the window's bytes only, so equal windows have equal anchors, and consecutive
windows of a document that share an anchor form a unit, a string of a few dozen
bytes.  Equal windows therefore lie in units of the same anchor, and the units
of an anchor can be examined apart from all others.

1. Tasks cut texts into units and send, per unit, its anchor and a hash of its
   bytes.  Copies of a unit within a part of a task collapse: later documents'
   are decided at once.
2. By anchor, units equal in all bytes collapse likewise.  What is left of an
   anchor are different units; those that agree in the bytes beside the anchor,
   before it, after it or around it, may still share windows.
3. Their bytes are fetched and a suffix array over all units of a few anchors
   is built by the linear grouping construction.  An anchor is one symbol in
   it, as every window of a unit holds the whole anchor.  Equal windows are
   neighbours; each run's least doc_id decides the others.
4. The decided intervals meet their documents, which give up the covered bytes.

Anchors are counted first, over evenly spread stretches of a large input.  The
entries of one with more than ``HOT_ENTRIES`` never meet in a group: an
aggregate by (anchor, unit) finds each unit's least document, and a join, which
adaptive execution splits, decides the others.  Entries name their document by
its doc_id; only for ids of several rows by the hash of its text as well.  With so many units the bytes
beside the anchor tell little apart, so all that are left go on if they are of
several documents.  Anchors with more than ``HOT_UNITS`` different units to
fetch are split by window: each goes to the task of its own hash.  A document
and the entries of its own text do meet in one task.

Defined cases: null text is empty; texts shorter than ``LENGTH`` lose nothing;
a null doc_id counts as larger than any; rows of the same doc_id do not remove
from each other; repeated rows each get a row; an empty table gives no rows;
extra columns are ignored by ``repeated_spans`` and kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, pieces, stored, table
from tidewater.llm.shingles import _powers, mix64
from tidewater.llm.suffix_array import suffix_array

LENGTH = 50
GRAM = 24
SPAN = LENGTH - GRAM + 1  # grams in a window
#: Bytes before and after the anchor: two units with a common window, and that many bytes, share those of one case at least.
SIDES = ((0, 18), (9, 9), (18, 0))
#: Text whose units are collapsed together, most of it that is hashed at a time, text bytes of a group of anchors or documents.
PART_BYTES, STRETCH_BYTES, GROUP_BYTES = 4 << 20, 1 << 19, 10 << 20
#: Bytes of units in one group of suffix arrays, of one array, and different units of an anchor that is split.
ARRAY_GROUP_BYTES, ARRAY_BYTES, HOT_UNITS = 512 << 10, 16 << 10, 8192
#: Units of a group of anchors that are compared at a time; all of an anchor are.
SLICE_ENTRIES = 1 << 17
#: Entries of an anchor that do not meet in one group, and the most such anchors.
HOT_ENTRIES, MAX_HOT = 1 << 17, 1 << 22
#: Ids of several rows that are told apart from the others; with more, all rows are named by their text too.
MOST_REPEATED = 1 << 20
#: Text up to which every stretch is counted for that; of more text every n-th, n being at most the second number.
COUNTED_BYTES, COUNT_EVERY = 32 << 20, 32
NO_ID = np.iinfo(np.int64).max

_values = np.random.default_rng(7001).integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)


# ---- units ----


def units_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, windows, anchor's place, anchor hash, unit hash, marks of its sides) of a stretch of bytes.

    The marks are a byte for each case of SIDES, of the hash of the anchor with
    the bytes around it; 0 where the unit does not reach that far.
    """
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, dtype=np.uint64) for _ in range(6))
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_values[data] * up[:n], out=sums[1:])

    def hashes(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((sums[end] - sums[start]) * down[start])

    grams = n - GRAM + 1
    gram = mix64((sums[GRAM:] - sums[:grams]) * down[:grams])
    # least gram of each window, leftmost of equals: the place fills the low bits, as stretches are short
    low = (gram & ~np.uint64((1 << 20) - 1)) | np.arange(grams, dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < SPAN:
        low = np.minimum(low[: -(SPAN - width)], low[SPAN - width :])
    anchor = (low & np.uint64((1 << 20) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    last = np.r_[first[1:], len(anchor)] - 1
    anchor = anchor[first]
    unit = hashes(first, last + LENGTH) + mix64(((anchor - first) * 64 + (last - first)).astype(np.uint64))
    sides = np.zeros(len(first), dtype=np.uint64)
    for i, (before, after) in enumerate(SIDES):
        there = np.flatnonzero((anchor - first >= before) & (last + LENGTH - anchor >= GRAM + after))
        mark = hashes(anchor[there] - before, anchor[there] + GRAM + after) % np.uint64(255) + np.uint64(1)
        sides[there] |= mark << np.uint64(8 * i)
    return first, last - first + 1, anchor, gram[anchor], mix64(unit), sides


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each number, byte by byte of all numbers, which compresses well."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(raw: bytes, width: int) -> np.ndarray:
    cells = np.frombuffer(raw, dtype=np.uint8).reshape(width, -1)
    out = np.zeros((cells.shape[1], 8), dtype=np.uint8)
    out[:, :width] = cells.T
    return out.reshape(-1).view("<u8")


#: A row: some documents (ids, marks, number of entries of each) and their entries.
UNIT_ROWS = (
    "bucket int, kind int, ids binary, texts binary, counts binary, place binary, windows binary, "
    "anchor binary, unit binary, sides binary"
)
NAMES = [c.split(" ")[0] for c in UNIT_ROWS.split(", ")]
TYPES = [pa.int32(), pa.int32()] + [pa.binary()] * 8
UNITS, DECIDED, WANTED, HOT = 0, 1, 2, 3
LOW48 = np.uint64((1 << 48) - 1)


class _Entries:
    """Entries (document, place, windows, ...) that become rows by bucket."""

    def __init__(self, doc, text, place, windows, anchor=None, unit=None, sides=None):
        zero = np.zeros(len(place), dtype=np.uint64)
        self.doc, self.text = doc.astype(np.int64, copy=False), text.astype(np.uint64, copy=False)
        self.place, self.windows = place.astype(np.int64, copy=False), windows.astype(np.int64, copy=False)
        self.anchor = zero if anchor is None else anchor
        self.unit = zero if unit is None else unit
        self.sides = zero if sides is None else sides

    def rows(self, bucket: np.ndarray, kind: int) -> Iterator[tuple]:
        if not len(self.doc):
            return
        order = np.argsort(bucket.astype(np.int32), kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        for some in np.split(order, cut):
            doc, text, place = self.doc[some], self.text[some], self.place[some]
            # a run of one document's entries at ascending places; where they fall, another run begins
            new = np.r_[True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (place[1:] < place[:-1])]
            at = np.flatnonzero(new)
            step = np.where(new, place, np.r_[0, np.diff(place)])
            whole = kind in (UNITS, HOT)
            yield (
                int(bucket[some[0]]), kind, _planes(np.diff(doc[at], prepend=0), 8), _planes(text[at], 8) if text.any() else b"",
                _planes(np.diff(np.r_[at, len(some)]), 4), _planes(step, 4), _planes(self.windows[some], 1),
                _planes(self.anchor[some], 6) if kind != DECIDED else b"",
                _planes(self.unit[some], 6) if whole else b"", _planes(self.sides[some], len(SIDES)) if whole else b"",
            )

    @classmethod
    def read(cls, rows: list, chosen: np.ndarray | None = None) -> _Entries:
        """Entries of rows (ids, texts, counts, place, windows, anchor, unit, sides); chosen: which of them, if not all."""
        cols: list[list[np.ndarray]] = [[] for _ in range(7)]
        before = 0
        for ids, texts, counts, place, windows, anchor, unit, sides in rows:
            k = _numbers(counts, 4).astype(np.int64)
            step = _numbers(place, 4).astype(np.int64)
            at = np.cumsum(np.r_[0, k[:-1]])
            total = np.cumsum(step)
            zero = np.zeros(len(step), dtype=np.uint64)
            whole = (
                np.repeat(np.cumsum(_numbers(ids, 8).view(np.int64)), k),
                np.repeat(_numbers(texts, 8), k) if len(texts) else zero,
                total - np.repeat(total[at] - step[at], k),
                _numbers(windows, 1).astype(np.uint8),
                _numbers(anchor, 6) if len(anchor) else zero,
                _numbers(unit, 6) if len(unit) else zero,
                _numbers(sides, len(SIDES)) if len(sides) else zero,
            )
            some = slice(None) if chosen is None else np.flatnonzero(chosen[before : before + len(step)])
            for col, x in zip(cols, whole):
                col.append(x[some])
            before += len(step)
        return cls(*(np.concatenate(c) if c else np.zeros(0, np.uint64) for c in cols))

    def take(self, at: np.ndarray) -> _Entries:
        return _Entries(*(x[at] for x in (self.doc, self.text, self.place, self.windows, self.anchor, self.unit, self.sides)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), TYPES)], names=NAMES)


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that brings equal keys together, which of them in that order open a run)."""
    order = np.argsort(key, kind="stable")
    return order, np.r_[True, key[order][1:] != key[order][:-1]] if len(key) else np.zeros(0, dtype=bool)


def _names(anchor: np.ndarray, unit: np.ndarray) -> np.ndarray:
    return mix64(anchor * np.uint64(0x9E3779B97F4A7C15)) ^ unit


def _collapse(docs: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is one of its unit's equals in the least document, the one that stands for them; is of a later document)."""
    order, new = _runs(names)
    one, later = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    if len(order):
        doc, run = docs[order], np.cumsum(new) - 1
        least = np.minimum.reduceat(doc, np.flatnonzero(new))[run]
        at = np.flatnonzero(doc == least)
        at = at[np.r_[True, run[at][1:] != run[at][:-1]]]
        one[order[at]], later[order] = True, doc > least
    return one, later


def _text_hash(data: bytes) -> int:
    """XXH64 with seed 42: as Spark's xxhash64 of the text."""
    import xxhash

    return xxhash.xxh64_intdigest(data, seed=42)


def repeated_ids(docs: DataFrame) -> np.ndarray | None:
    """The ids of several rows, sorted (NO_ID for null); None if they are too many."""
    ids = docs.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("id")).count().where("count > 1").select("id")
    found = ids.limit(MOST_REPEATED + 1).toArrow().column(0).to_numpy()
    return None if len(found) > MOST_REPEATED else np.sort(found)


def _mark(doc: int | None, raw: bytes, again) -> int:
    """What tells the rows of one id apart: the text's hash, or 0 where the id has one row."""
    ids = None if again is None else again.value
    if ids is not None:
        doc = NO_ID if doc is None else doc
        at = np.searchsorted(ids, doc) if len(ids) else 0
        if at == len(ids) or ids[at] != doc:
            return 0
    return _text_hash(raw)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_of_doc(doc: np.ndarray, text: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a row by its doc_id and its mark, so that copies of a text spread over all buckets."""
    return (mix64(mix64(doc.astype(np.int64).view(np.uint64)) ^ text.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _count_anchors(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    """(anchor, its units) in every so many-th stretch; tasks begin at different ones."""
    from pyspark import TaskContext

    turn = TaskContext.get().partitionId()
    for batch in batches:
        found = []
        for text in batch.column(0).to_pylist():
            raw = (text or "").encode()
            for at in range(0, len(raw) - LENGTH + 1, STRETCH_BYTES):
                turn += 1
                if turn % every == 0:
                    data = np.frombuffer(raw[at : at + STRETCH_BYTES + LENGTH - 1], dtype=np.uint8)
                    found.append(units_of(data)[3] & LOW48)
        if found:
            anchor, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int64)), pa.array(n.astype(np.int64))], names=["anchor", "n"])


def hot_anchors(docs: DataFrame, total: int) -> np.ndarray:
    """Anchors with too many entries for one group, sorted; only the way entries take depends on it, not the result."""
    every = min(COUNT_EVERY, pieces(total, COUNTED_BYTES, at_least=1))
    counts = docs.select("text").mapInArrow(lambda b: _count_anchors(b, every), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") * every > max(HOT_ENTRIES, total // MAX_HOT)).select("anchor").toArrow()  # MAX_HOT, as entries are fewer than bytes
    return np.sort(found.column(0).to_numpy().astype(np.uint64))


def _cut_units(batches: Iterator[pa.RecordBatch], buckets: int, hot=None, again=None) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        counts = [len(h[2]) for h in held]
        doc, text = (np.repeat(np.array([h[i] for h in held], dtype=k), counts) for i, k in ((0, np.int64), (1, np.uint64)))
        place, windows, anchor, unit, sides = (np.concatenate([h[i] for h in held]) for i in range(2, 7))
        held.clear()
        e = _Entries(doc, text, place, windows, anchor, unit, sides)
        _, later = _collapse(doc, _names(anchor, unit))
        apart = np.isin(e.anchor, hot.value) if hot is not None else np.zeros(len(later), dtype=bool)
        rows = []
        for some, kind in ((~later & ~apart, UNITS), (~later & apart, HOT), (later, DECIDED)):
            part = e.take(np.flatnonzero(some))
            bucket = (part.anchor % np.uint64(buckets)).astype(np.int64) if kind == UNITS else _bucket_of_doc(part.doc, part.text, buckets)
            rows += part.rows(bucket, kind)
        if rows:
            yield _batch(rows)

    for batch in batches:
        for doc, text in _rows(batch):
            raw = (text or "").encode()
            if len(raw) < LENGTH:
                continue
            data, mark = np.frombuffer(raw, dtype=np.uint8), _mark(doc, raw, again)
            for at in range(0, len(data) - LENGTH + 1, STRETCH_BYTES):  # a stretch of windows and the bytes they reach
                first, windows, _, anchor, unit, sides = units_of(data[at : at + STRETCH_BYTES + LENGTH - 1])
                held.append(
                    (NO_ID if doc is None else doc, mark, first + at, windows.astype(np.uint8),
                     anchor & LOW48, unit & LOW48, sides.astype(np.uint32))
                )
            size += len(raw)
            if size >= PART_BYTES:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def _rows(batch: pa.RecordBatch, some: int = 256) -> Iterator[tuple]:
    """A batch's rows; few at a time become Python objects."""
    for at in range(0, batch.num_rows, some):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, some).columns))


def _slice(rows: list[list], buckets: int, slices: int, turn: int) -> tuple[np.ndarray, ...]:
    """(number among all of the rows' entries, document, anchor, unit, sides) of every so many-th anchor's entries."""
    cols: list[list[np.ndarray]] = [[] for _ in range(5)]
    before = 0
    for ids, _, counts, _, _, anchor, unit, sides in rows:
        anchors = _numbers(anchor, 6)
        some = np.flatnonzero(anchors // np.uint64(buckets) % np.uint64(slices) == np.uint64(turn))
        # the document of each: where its number falls among the ends of the documents' entries
        ends = np.cumsum(_numbers(counts, 4).astype(np.int64))
        doc = np.cumsum(_numbers(ids, 8).view(np.int64))[np.searchsorted(ends, some, side="right")]
        for col, x in zip(cols, (some + before, doc, anchors[some], _numbers(unit, 6)[some], _numbers(sides, len(SIDES))[some])):
            col.append(x)
        before += len(anchors)
    return tuple(np.concatenate(c) for c in cols)


def _judge(doc: np.ndarray, anchor: np.ndarray, unit: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which units are of a later document than an equal one, and of which the bytes are wanted."""
    names = _names(anchor, unit)
    first, later = _collapse(doc, names)
    # units of different documents and one anchor that agree beside it, in a case that both have
    kept = np.flatnonzero(first)
    want = np.zeros(len(kept), dtype=bool)
    for i in range(len(SIDES)):
        side = (sides[kept] >> np.uint64(8 * i)) & np.uint64(255)
        some = np.flatnonzero(side)
        order, new = _runs(anchor[kept][some] * np.uint64(256) + side[some])
        if len(order):
            its, at = doc[kept][some][order], np.flatnonzero(new)
            several = np.minimum.reduceat(its, at) < np.maximum.reduceat(its, at)
            want[some[order[several[np.cumsum(new) - 1]]]] = True
    # every place of a wanted unit in its least document asks for the unit's bytes
    return later, ~later & np.isin(names, names[kept[want]])


def _decide(got: pa.Table, buckets: int) -> pa.Table:
    """Units of one bucket of anchors: decided entries, and those whose bytes are wanted.  Rows of other kinds pass.

    A worker holds the compact rows and a slice of the anchors' entries, not all entries.
    """
    got = got.select(NAMES)
    unit_rows = np.equal(got.column("kind").to_numpy(), UNITS)
    rows = [[got.column(c)[i].as_buffer() for c in NAMES[2:]] for i in np.flatnonzero(unit_rows).tolist()]
    sizes = [r[4].size for r in rows]  # windows, a byte an entry
    later, asks = (np.zeros(sum(sizes), dtype=bool) for _ in range(2))
    slices = pieces(len(later), SLICE_ENTRIES)
    for turn in range(slices if rows else 0):
        at, *entries = _slice(rows, buckets, slices, turn)
        later[at], asks[at] = _judge(*entries)
    out: list[tuple] = []
    for chosen, kind in ((later, DECIDED), (asks, WANTED)):
        e = _Entries.read(rows, chosen)
        out += e.rows(_bucket_of_doc(e.doc, e.text, buckets), kind)
    others = got.filter(pa.array(~unit_rows)).combine_chunks()
    return pa.concat_tables([others, pa.Table.from_batches([_batch(out)]).cast(others.schema)]) if out else others


# ---- units of hot anchors: one row an entry ----

HOT_ROWS = "anchor long, unit long, doc long, text long, place long, windows long"
HOT_NAMES = [c.split(" ")[0] for c in HOT_ROWS.split(", ")]


def _entry_by_entry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in NAMES[2:])):
            e = _Entries.read([row])
            columns = (e.anchor, e.unit, e.doc, e.text, e.place, e.windows)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns], names=HOT_NAMES)


def _by_bucket(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries with their kind as rows of their documents' buckets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = {c: batch.column(c).to_numpy() for c in (*HOT_NAMES, "kind")}
        order = np.lexsort((col["place"], col["text"], col["doc"]))
        u = lambda c: col[c].view(np.uint64)
        e = _Entries(col["doc"], u("text"), col["place"], col["windows"], u("anchor"), u("unit"))
        rows: list[tuple] = []
        for kind in (DECIDED, WANTED):
            some = e.take(order[col["kind"][order] == kind])
            rows += some.rows(_bucket_of_doc(some.doc, some.text, buckets), kind)
        yield _batch(rows)


def _decide_apart(rows: DataFrame, buckets: int) -> DataFrame:
    """Units of hot anchors: as ``_decide``, by aggregates and a join instead of groups."""
    entries = rows.select(*NAMES).mapInArrow(_entry_by_entry, HOT_ROWS)
    least = stored(entries.groupBy("anchor", "unit").agg(F.min("doc").alias("least")), "least")
    several = least.groupBy("anchor").agg(F.min("least").alias("lo"), F.max("least").alias("hi")).where("lo < hi").select("anchor", F.lit(True).alias("several"))
    least = least.join(several, "anchor", "left")
    kind = F.when(F.col("doc") > F.col("least"), F.lit(DECIDED)).when(F.col("several"), F.lit(WANTED))
    known = entries.join(least, ["anchor", "unit"]).select(*HOT_NAMES, kind.alias("kind")).where("kind is not null")
    return known.mapInArrow(lambda b: _by_bucket(b, buckets), UNIT_ROWS)


# ---- the wanted units' bytes and their suffix arrays ----

WANTED_ROWS = "anchor long, doc long, text long, place int, windows int, bytes binary"


def _spread(docs: pa.Table, rows: pa.Table, again) -> Iterator[tuple]:
    """(doc_id, text's bytes, entries of that text) of a bucket of documents."""
    entries = _Entries.read([tuple(r) for r in zip(*(rows.column(c).to_pylist() for c in NAMES[2:]))])
    order = np.lexsort((entries.place, entries.text, entries.doc))
    e = entries.take(order)
    edge = np.flatnonzero(np.r_[True, (e.doc[1:] != e.doc[:-1]) | (e.text[1:] != e.text[:-1])]) if len(order) else np.zeros(0, int)
    ends = np.r_[edge[1:], len(order)]
    where = {(int(e.doc[a]), int(e.text[a])): (a, b) for a, b in zip(edge, ends)}
    for doc, body in zip(docs.column("doc_id").to_pylist(), docs.column("body").to_pylist()):
        raw = _unpack(body)
        a, b = where.get((NO_ID if doc is None else doc, _mark(doc, raw, again)), (0, 0))
        yield doc, raw, e.place[a:b], e.windows[a:b], e.anchor[a:b]


def _fetch(docs: pa.Table, rows: pa.Table, again) -> pa.Table:
    out = []
    for doc, raw, place, windows, anchor in _spread(docs, rows, again):
        if not len(place):
            continue
        name = _signed(_mark(doc, raw, again))
        for p, w, a in zip(place.tolist(), windows.tolist(), anchor.tolist()):
            out.append((a, NO_ID if doc is None else doc, name, p, w, raw[p : p + w + LENGTH - 1]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    names = [c.split(" ")[0] for c in WANTED_ROWS.split(", ")]
    columns = list(zip(*out)) or [[] for _ in kinds]
    return pa.Table.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)


def _anchors(raw: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where the anchor of each unit is: its gram of least hash, the leftmost of equals (as in ``units_of``)."""
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_values[raw] * up[: len(raw)], out=sums[1:])
    gram = mix64((sums[GRAM:] - sums[:-GRAM]) * down[: len(raw) - GRAM + 1])
    at = np.arange(len(gram)) - np.repeat(begin, sizes)[: len(gram)]  # a place in its unit; those past the last gram are left out below
    low = (gram & ~np.uint64((1 << 20) - 1)) | at.astype(np.uint64)
    edges = np.stack([begin, begin + sizes - GRAM + 1], axis=1).ravel()
    least = np.minimum.reduceat(np.r_[low, np.uint64(0)], edges)[::2]
    return begin + (least & np.uint64((1 << 20) - 1)).astype(np.int64)


def repeated_windows(strings: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each unit a mask over its windows: does the window also start in a unit of a smaller doc.

    One suffix array over all units; equal windows are runs of neighbours in it.
    The bytes of an anchor are one symbol, so a window has SPAN of them.
    """
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    raw = np.frombuffer(b"".join(strings), dtype=np.uint8)
    begin = np.cumsum(np.r_[0, sizes[:-1]])
    anchor = _anchors(raw, begin, sizes)
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, GRAM)[anchor]).view(f"V{GRAM}").ravel()
    flat = raw.astype(np.int64) + 2
    flat[anchor] = 258 + np.unique(grams, return_inverse=True)[1]
    kept = np.ones(len(flat), dtype=bool)
    kept[(anchor[:, None] + np.arange(1, GRAM)).ravel()] = False
    sizes = sizes - GRAM + 1
    # between units the symbol 1; the end is the one smallest
    flat = np.insert(flat[kept], np.cumsum(sizes), 1)
    starts, length = np.cumsum(np.r_[0, sizes[:-1] + 1]), SPAN
    order = np.array(suffix_array([*flat.tolist(), 0]), dtype=np.int64)[1:]
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)[order]
    inside = order + length <= starts[owner] + sizes[owner]
    order, owner = order[inside], owner[inside]
    masks = [np.zeros(max(0, int(k) - length + 1), dtype=bool) for k in sizes]
    if not len(order):
        return masks
    windows = np.lib.stride_tricks.sliding_window_view(flat, length)
    new = np.ones(len(order), dtype=bool)
    for a in range(1, len(order), 20_000):
        b = min(len(order), a + 20_000)
        new[a:b] = (windows[order[a:b]] != windows[order[a - 1 : b - 1]]).any(axis=1)
    run = np.flatnonzero(new)
    least = np.minimum.reduceat(docs[owner], run)
    later = docs[owner] > least[np.cumsum(new) - 1]
    for at, who in zip(order[later].tolist(), owner[later].tolist()):
        masks[who][at - int(starts[who])] = True
    return masks


def _arrays(got: pa.Table, buckets: int) -> pa.Table:
    """Suffix arrays over the units of a group's anchors, a few anchors at a time; decided entries."""
    anchor = np.array(got.column("anchor").to_pylist(), dtype=np.int64)
    order = np.argsort(anchor, kind="stable")
    doc, text, place = (np.array(got.column(c).to_pylist(), dtype=np.int64) for c in ("doc", "text", "place"))
    raw = got.column("bytes").to_pylist()
    edges = np.r_[np.flatnonzero(np.r_[True, np.diff(anchor[order]) != 0]), len(order)] if len(order) else np.zeros(1, int)
    out: list[tuple] = []
    some: list[int] = []
    size = 0

    def build() -> None:
        names = [(int(doc[i]), raw[i]) for i in some]
        strings = list(dict.fromkeys(names))  # a document's equal units are one string
        masks = dict(zip(strings, repeated_windows([x[1] for x in strings], np.array([x[0] for x in strings]))))
        for i, name in zip(some, names):
            mask = masks[name]
            edge = np.flatnonzero(np.diff(np.r_[0, mask.view(np.int8), 0]))
            out.extend((doc[i], text[i], place[i] + a, b - a) for a, b in zip(edge[::2], edge[1::2]))

    for a, b in zip(edges[:-1], edges[1:]):
        some += order[a:b].tolist()
        size += sum(len(raw[i]) for i in order[a:b])
        if size >= ARRAY_BYTES:
            build()
            some, size = [], 0
    if some:
        build()
    rows: list[tuple] = []
    if out:
        d, t, p, w = (np.array(c, dtype=np.int64) for c in zip(*out))
        rows = list(_Entries(d, t.view(np.uint64), p, w).rows(_bucket_of_doc(d, t.view(np.uint64), buckets), DECIDED))
    return pa.Table.from_batches([_batch(rows)]) if rows else pa.Table.from_arrays([pa.array([], type=t) for t in TYPES], names=NAMES)


def _entry_rows(got: pa.Table, buckets: int) -> pa.Table:
    d, t, p, w = (np.array(got.column(c).to_pylist(), dtype=np.int64) for c in ("doc", "text", "place", "windows"))
    rows = list(_Entries(d, t.view(np.uint64), p, w).rows(_bucket_of_doc(d, t.view(np.uint64), buckets), DECIDED))
    return pa.Table.from_batches([_batch(rows)])


# ---- the whole ----


def _pack(batches: Iterator[pa.RecordBatch], buckets: int, again=None) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        names, bodies = [], []
        for doc, text in _rows(batch):
            raw = (text or "").encode()
            names.append(_mark(doc, raw, again))
            bodies.append(pack.compress(raw))
        docs = batch.column(0).cast(pa.int64())
        bucket = _bucket_of_doc(docs.fill_null(NO_ID).to_numpy(), np.array(names, dtype=np.uint64), buckets)
        yield pa.RecordBatch.from_arrays(
            [docs, pa.array(bucket.astype(np.int32)), pa.array(bodies, type=pa.binary())], names=["doc_id", "bucket", "body"]
        )


def _unpack(body: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(body)


def _remove(docs: pa.Table, rows: pa.Table, give_text: bool, again) -> pa.Table:
    out = []
    for doc, raw, place, windows, _ in _spread(docs, rows, again):
        gone = np.zeros(len(raw) + 1, dtype=np.int64)
        np.add.at(gone, place, 1)
        np.add.at(gone, place + windows + LENGTH - 1, -1)
        covered = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(raw, dtype=np.uint8)[~covered].tobytes() if covered.any() else raw
        spans = int((np.diff(np.r_[0, covered.view(np.int8)]) == 1).sum())
        row = (doc, len(raw), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
        out.append((*row, _signed(_text_hash(raw)), kept.decode("utf-8", "ignore")) if give_text else row)
    names, kinds = _result(give_text)
    columns = list(zip(*out)) or [[] for _ in kinds]
    return pa.Table.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)


def _result(give_text: bool) -> tuple[list[str], list[pa.DataType]]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text_hash", "kept"] * give_text
    return names, [pa.int64()] * 4 + [pa.string()] + [pa.int64(), pa.string()] * give_text


def repeated_spans(documents: DataFrame, give_text: bool = False) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept text)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    again = docs.sparkSession.sparkContext.broadcast(repeated_ids(docs))  # at most MOST_REPEATED numbers
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = pieces(total, GROUP_BYTES, at_least=4)
    found = hot_anchors(docs, total)
    hot = docs.sparkSession.sparkContext.broadcast(found) if len(found) else None  # at most MAX_HOT numbers
    units = docs.mapInArrow(lambda b: _cut_units(b, buckets, hot, again), UNIT_ROWS)
    decided = stored(units.groupBy("bucket").applyInArrow(lambda t: _decide(t, buckets), UNIT_ROWS), "units")
    if hot is not None:
        apart = stored(_decide_apart(decided.where(F.col("kind") == HOT), buckets), "units-apart")
        decided = decided.where(F.col("kind") != HOT).unionByName(apart)
    packed = docs.mapInArrow(lambda b: _pack(b, buckets, again), "doc_id long, bucket int, body binary")

    asked = decided.where(F.col("kind") == WANTED)
    with_requests = packed.join(asked.select("bucket").distinct(), "bucket", "left_semi")
    wanted = stored(
        with_requests.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(lambda d, r: _fetch(d, r, again), WANTED_ROWS), "unit-bytes"
    )
    sizes = wanted.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    groups = pieces(sizes, ARRAY_GROUP_BYTES)
    hot = wanted.groupBy("anchor").agg(F.count("*").alias("c")).where(F.col("c") > HOT_UNITS).select("anchor")
    split = not hot.isEmpty()
    cold = wanted.join(hot, "anchor", "left_anti") if split else wanted
    cold = cold.withColumn("g", F.pmod(F.xxhash64("anchor"), F.lit(groups)))
    known = decided.where(F.col("kind") == DECIDED).unionByName(
        cold.groupBy("g").applyInArrow(lambda t: _arrays(t, buckets), UNIT_ROWS)
    )
    if split:
        known = known.unionByName(_by_window(wanted.join(hot, "anchor", "left_semi"), groups, buckets))
    known = stored(known, "spans")
    names, kinds = _result(give_text)
    schema = ", ".join(f"{n} {'string' if k == pa.string() else 'long'}" for n, k in zip(names, kinds))
    return (
        packed.groupBy("bucket")
        .cogroup(known.groupBy("bucket"))
        .applyInArrow(lambda d, r: _remove(d, r, give_text, again), schema)
    )


def _by_window(units: DataFrame, groups: int, buckets: int) -> DataFrame:
    """Units of hot anchors, window by window: the least document of each window decides the others."""
    windows = units.select(
        "doc", "text", "place",
        F.posexplode(F.transform(F.sequence(F.lit(1), "windows"), lambda i: F.sha2(F.substring("bytes", i, F.lit(LENGTH)), 256))).alias("at", "w"),
    ).select("doc", "text", (F.col("place") + F.col("at")).alias("place"), "w")
    least = windows.groupBy("w").agg(F.min("doc").alias("least"))
    later = windows.join(least, "w").where("doc > least").select("doc", "text", "place", F.lit(1).alias("windows"))
    return later.groupBy(F.pmod(F.xxhash64("text", "place"), F.lit(groups)).alias("g")).applyInArrow(
        lambda t: _entry_rows(t.select(["doc", "text", "place", "windows"]), buckets), UNIT_ROWS
    )


def remove_repeats(documents: DataFrame) -> DataFrame:
    """The documents with the repeated bytes taken out of their text; all rows and columns stay.

    Where a removed run cuts a character in two, its left-over bytes go as
    well.  A null text stays null.  Only the other columns are shuffled beside
    the kept texts.
    """
    id_, no_id, its_hash, kept_text, none = (fresh(documents.columns, c) for c in ("id_", "no_id", "its_hash", "kept_text", "none"))
    # keys without nulls, the same of aggregate and join, so that the kept texts are shuffled once
    keys = {id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), no_id: F.col("doc_id").isNull()}
    kept = repeated_spans(documents.select("doc_id", "text"), give_text=True).select(
        *[c.alias(k) for k, c in keys.items()], F.col("text_hash").alias(its_hash), F.col("kept").alias(kept_text)
    )
    kept = kept.groupBy(*keys, its_hash).agg(F.first(kept_text).alias(kept_text))  # equal rows keep equal texts
    named = documents.withColumns(
        {**keys, its_hash: F.xxhash64(F.coalesce("text", F.lit(""))), none: F.col("text").isNull()}
    ).drop("text")
    out = named.join(kept, [*keys, its_hash]).withColumn("text", F.when(~F.col(none), F.col(kept_text)))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in documents.columns])


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))
