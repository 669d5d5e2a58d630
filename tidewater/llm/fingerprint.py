"""Document fingerprints from prefix polynomial hashes.

A text's code points are hashed into two modular prefix arrays.  From them any
span's hash, the equality of any two spans and, by binary search, the longest
common extension of two places follow without touching the text again.  The
fingerprint is the whole text's hash and length with sketches of its spans:
the hashes of all runs of ``SHORT_SPAN`` code points, and in texts of ``SHORT``
or more also of ``SPAN``, fall into ``BINS`` bins and each bin keeps a byte of
its least one.  Equal texts have equal fingerprints; two fingerprints tell the
share of common spans, of the longest spans that both have a sketch of.

Defined cases: null text is empty; an empty text is one empty span; documents
are ordered by doc_id with nulls first, ties by text, repeated rows follow each
other; the document after the last is the first (a single one follows itself);
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import pieces, table

# Two primes below 2**31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: Span lengths of the sketches; texts shorter than SHORT have few long spans and only a sketch of short ones.
SPAN, SHORT_SPAN, SHORT = 16, 4, 128
BINS = 128
#: Text that one range of documents holds, and the most ranges.
RANGE_BYTES = 24 << 20
MAX_RANGES = 4096

_POWERS: list[np.ndarray] = []  # base**i and base**-i for each prime


def _powers(n: int) -> list[np.ndarray]:
    """Tables of base**i mod p and their inverses, at least n long."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        del _POWERS[:]
        for p, b in zip(PRIMES, BASES):
            for base in (b, pow(b, -1, p)):
                out = np.ones(size, dtype=np.uint64)
                done = 1
                while done < size:  # out[done:2 done] = out[:done] * base**done
                    out[done : 2 * done] = out[:done] * np.uint64(pow(base, done, p)) % np.uint64(p)
                    done *= 2
                _POWERS.append(out)
    return _POWERS


class PrefixHash:
    """Modular prefix arrays of a text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        tables = _powers(self.n + 1)
        self.prefix = []
        for k, p in enumerate(PRIMES):
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(codes * tables[2 * k][: self.n] % np.uint64(p), out=sums[1:])  # below 2**64 for 2**33 terms
            self.prefix.append(sums % np.uint64(p))

    def spans(self, length: int) -> np.ndarray:
        """62-bit hashes of all spans of a length, by start."""
        tables, parts = _powers(self.n + 1), []
        for k, p in enumerate(PRIMES):
            at = self.prefix[k]
            count = self.n - length + 1
            diff = at[length:] + np.uint64(p) - at[:count]
            parts.append(diff % np.uint64(p) * tables[2 * k + 1][:count] % np.uint64(p))
        return (parts[0] << np.uint64(31)) | parts[1]

    def span(self, start: int, length: int) -> int:
        """62-bit hash of one span; the same for equal spans of any two texts."""
        tables, out = _powers(self.n + 1), 0
        for k, p in enumerate(PRIMES):
            diff = int(self.prefix[k][start + length]) - int(self.prefix[k][start])
            out = out << 31 | diff * int(tables[2 * k + 1][start]) % p
        return out

    def extension(self, at: int, other: PrefixHash, there: int) -> int:
        """Longest l with self[at:at+l] == other[there:there+l], by binary search."""
        low, high = 0, min(self.n - at, other.n - there)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(at, mid) == other.span(there, mid):
                low = mid
            else:
                high = mid - 1
        return low


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the span hashes over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprint:
    """Whole hash, length and span sketches of a text."""

    def __init__(self, text: str):
        self.hashes = PrefixHash(text)
        n = self.hashes.n
        self.whole, self.n = self.hashes.span(0, n), n
        scales = (SPAN, SHORT_SPAN) if n >= SHORT else (SHORT_SPAN,)
        self.sketches = {k: self._sketch(min(k, n)) for k in scales}  # by span length: bins in use, their bytes

    def _sketch(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        spread = _mix(self.hashes.spans(length))
        least = np.full(BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
        np.minimum.at(least, (spread >> np.uint64(57)).astype(np.intp), spread & np.uint64((1 << 57) - 1))
        return least != np.iinfo(np.uint64).max, (least & np.uint64(0xFF)).astype(np.uint8)

    def __str__(self) -> str:
        parts = [f"{self.whole:016x}", f"{self.n:x}"]
        for full, sketch in self.sketches.values():
            parts += [np.packbits(full).tobytes().hex(), np.where(full, sketch, 0).astype(np.uint8).tobytes().hex()]
        return "-".join(parts)

    def likeness(self, other: Fingerprint) -> float:
        """Estimated share of common spans: 1 for equal texts, about 0 for unrelated ones."""
        if self.whole == other.whole and self.n == other.n:
            return 1.0
        scale = max(self.sketches.keys() & other.sketches.keys())
        (full, sketch), (full2, sketch2) = self.sketches[scale], other.sketches[scale]
        either = int((full | full2).sum())
        equal = int((full & full2 & (sketch == sketch2)).sum())
        jaccard = max(0.0, (equal / either - 1 / 256) / (1 - 1 / 256))
        return 2 * jaccard / (1 + jaccard)


def edit(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of the start of ``following``."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the one after it; a range ends with a copy of the next range's first row."""
    held = None  # (range, doc_id, halo, text, fingerprint)
    for batch in batches:
        out = []
        for group, doc, halo, text in zip(*(batch.column(c).to_pylist() for c in ("range_no", "doc_id", "halo", "text"))):
            own = Fingerprint(text)
            if held is not None and held[0] == group and not held[2]:
                before, print_of = held[3], held[4]
                changed = edit(before, text)
                new = Fingerprint(changed)
                out.append(
                    (
                        held[1], len(before), hashlib.sha256(changed.encode()).hexdigest(), str(print_of), str(new),
                        print_of.likeness(new), print_of.likeness(own),
                        print_of.hashes.extension(0, new.hashes, 0), print_of.hashes.extension(0, own.hashes, 0),
                    )
                )
            held = (group, doc, halo, text, own)
        if out:
            names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=names)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_edited long, common_next long"
)


def _range_of(key: Column, bounds: list[int], low: int, high: int) -> Column:
    """Number of bounds at or below the key, as a balanced tree of comparisons."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(key < bounds[mid], _range_of(key, bounds, low, mid)).otherwise(_range_of(key, bounds, mid + 1, high))


def fingerprints(documents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprint of each document and of its edit by the next one; texts are shuffled once.

    Ranges of doc_id are set by their quantiles.  Each range also gets the next
    range's first row, so a row and its successor always meet in one task,
    which streams them.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    docs = documents.select(key.alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(MAX_RANGES, pieces(total, range_bytes))
    cuts = [k / n for k in range(1, n)]
    bounds = docs.agg(F.percentile_approx("key", cuts, 100 * n)).first()[0] if cuts else []
    bounds = sorted(set(bounds or []))
    docs = docs.withColumn("range_no", _range_of(F.col("key"), bounds, 0, len(bounds)))
    # the first row of each range: a row for each of at most MAX_RANGES ranges
    firsts = docs.groupBy("range_no").agg(F.min("key").alias("key"))
    order = sorted(r["range_no"] for r in firsts.select("range_no").collect())
    goes_to = F.lit(None).cast("int")
    if order:
        moves = {b: a for a, b in zip(order, order[1:] + order[:1])}
        goes_to = F.element_at(F.create_map(*[F.lit(x) for kv in moves.items() for x in kv]), F.col("range_no"))
    heads = docs.join(F.broadcast(firsts), ["range_no", "key"]).groupBy("range_no", "key", "doc_id").agg(F.min("text").alias("text"))
    halo = heads.select("key", "doc_id", "text", goes_to.alias("range_no"), F.lit(1).alias("halo"))
    rows = docs.select("key", "doc_id", "text", "range_no", F.lit(0).alias("halo")).unionByName(halo)
    return (
        rows.repartitionById(len(bounds) + 1, F.col("range_no"))  # a task for each range
        .sortWithinPartitions("range_no", "halo", "key", "text")
        .select("range_no", "doc_id", "halo", "text")
        .mapInArrow(_rows, SCHEMA)
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
