"""WARC archives with revisit records and an externally merged URL index.

Tasks write archives (a gzip member for each record) and, beside each, a run
of its index sorted by URL key, time and page.  The runs stay on shared
storage; a k-way merge by a loser tree, one task for each range of keys, gives
the globally ordered capture histories.  Records are read back by the places
that the merged index names.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, that with
the smallest page_id is a response and the others revisit it; smaller ones are
all responses.

Defined cases: null html is an empty payload; rows that share the smallest
page_id of a payload are responses all; a null page_id counts as the largest,
so it revisits, unless no page of its payload has an id; a null url has the
empty key and no target header; an empty table writes no archive and gives no
rows; extra columns are ignored.  A task that is run again writes new files:
only files named by the manifest that the finished tasks returned are read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from datetime import UTC, datetime
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import pieces, shared_path, stored, table

MIN_REVISIT = 100
#: Payload bytes in one archive before the next one begins.
ARCHIVE_BYTES = 64 << 20
#: Lines of a run between two entries of its sparse index.
STRIDE = 128
#: Runs that one task merges at a time; more are merged in several passes.
FAN_IN = 256
#: Index bytes in one range of the merge, keys sampled to set the ranges (in all).
RANGE_BYTES = 16 << 20
SAMPLES = 65_536
#: First capture of the given pages, which have no time of their own.
EPOCH = 1_600_000_000


# ---- shared storage ----


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _write(path: str, data: bytes) -> None:
    store, at = _open(path)
    with store.open_output_stream(at, compression=None) as out:
        out.write(data)


# ---- records ----


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then path and query; no scheme, user, fragment, "www." or default port."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return quote(url, safe="")
    host = host.removeprefix("www.")
    keep = f":{port}" if port and port not in (80, 443) else ""
    query = f"?{parts.query}" if parts.query else ""
    return quote(f"{','.join(reversed(host.split('.')))}{keep}){parts.path or '/'}{query}", safe="%/:?=&;,)+@!$*'(~")


def _header_text(value: str) -> str:
    """A header value in one line of visible ASCII."""
    return quote(value, safe="%/:?=&;,)+@!$*'(~#[]")


def build_record(page, url, captured: datetime, payload: bytes, digest: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none' if page is None else page}>",
        f"WARC-Date: {captured:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Page, type, payload size and digest of a record; a response's are taken from its payload and checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    page = headers["WARC-Record-ID"][len("<urn:page:") : -1]
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != told):
        raise ValueError(f"payload of page {page} does not match its digest")
    to = headers.get("WARC-Refers-To")
    return {
        "page_id": None if page == "none" else int(page),
        "payload_bytes": size,
        "payload_digest": told,
        "record_type": kind,
        "refers_to": None if to is None else int(to[len("<urn:page:") : -1]),
    }


# ---- archives and their sorted runs ----


def _sort_key(key: str, captured: datetime, page) -> str:
    number = "-" if page is None else f"{page + 2**63:020d}"
    return f"{key} {captured:%Y%m%d%H%M%S} {number}"


def _write_run(path: str, lines: Iterable[str]) -> tuple[int, int, list[str]]:
    """A sorted run and its sparse index (each STRIDE-th key and its place); lines, bytes and sampled keys."""
    store, at = _open(path)
    n = size = 0
    marks: list[str] = []
    with store.open_output_stream(at, compression=None) as out:
        for line in lines:
            if n % STRIDE == 0:
                marks.append(f"{line.split(chr(9), 1)[0]}\t{size}")
            data = (line + "\n").encode()
            out.write(data)
            n += 1
            size += len(data)
    _write(path + ".marks", "\n".join(marks).encode())
    keys = [m.split("\t")[0] for m in marks]
    return n, size, keys[:: max(1, len(keys) // 64)]


RUNS = "run string, entries long, bytes long, samples array<string>"


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()))
    names = ["run", "entries", "bytes", "samples"]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)


def _write_archives(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, done = TaskContext.get().partitionId(), []
    stream, name, size, offset, lines = None, "", 0, 0, []

    def close() -> None:
        stream.close()
        done.append((run := f"{folder}/{name}.run", *_write_run(run, sorted(lines))))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "captured", "html", "digest", "refers_to")]
        for page, url, seconds, html, digest, to in zip(*columns):
            if stream is None or size >= ARCHIVE_BYTES:
                if stream is not None:
                    close()
                name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.warc.gz"
                store, at = _open(f"{folder}/{name}")
                store.create_dir(at.rpartition("/")[0], recursive=True)
                stream, size, offset, lines = store.open_output_stream(at, compression=None), 0, 0, []
            payload, captured = html.encode(), datetime.fromtimestamp(seconds, UTC)
            data = gzip.compress(build_record(page, url, captured, payload, digest, to), 4, mtime=0)
            stream.write(data)
            lines.append(f"{_sort_key(url_key(url), captured, page)}\t{name}\t{offset}\t{len(data)}")
            offset += len(data)
            size += len(payload)
    if stream is not None:
        close()
        yield _manifest(done)


def with_revisits(pages: DataFrame) -> DataFrame:
    """Adds digest and refers_to (the response's page_id; null for a response)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), "captured")
    rows = rows.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    firsts = (
        rows.where(F.octet_length("html") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    repeat = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return rows.join(firsts, "digest", "left").withColumn("refers_to", F.when(repeat, F.col("first")))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives and their runs under ``folder``; the manifest of runs, stored.

    ``pages``: page_id, url, html and captured (seconds).
    """
    columns = with_revisits(pages).select("page_id", "url", "captured", "html", "digest", "refers_to")
    return stored(columns.mapInArrow(lambda b: _write_archives(b, folder), RUNS), "warc-runs")


# ---- the merge ----


class LoserTree:
    """Merges sorted iterators: inner nodes hold the losers of their matches, the winner stands on top."""

    def __init__(self, sources: list[Iterator[str]]):
        self._sources = sources
        self._heads = [next(s, None) for s in sources]
        k = len(sources)
        self._losers = [-1] * k
        for leaf in range(k):  # each leaf climbs until it waits for an opponent
            self._climb(leaf, filling=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        return y is None and x is not None or (x is not None and y is not None and (x, a) < (y, b))

    def _climb(self, leaf: int, filling: bool = False) -> None:
        k, winner = len(self._sources), leaf
        node = (leaf + k) // 2
        while node > 0:
            other = self._losers[node]
            if filling and other < 0:
                self._losers[node] = winner
                return
            if self._beats(other, winner):
                self._losers[node], winner = winner, other
            node //= 2
        self._losers[0] = winner

    def __iter__(self) -> Iterator[str]:
        while self._sources and self._heads[top := self._losers[0]] is not None:
            yield self._heads[top]
            self._heads[top] = next(self._sources[top], None)
            self._climb(top)


def _run_lines(path: str, low: str | None, high: str | None) -> Iterator[str]:
    """Lines of a run with low <= key < high, read from the sparse index's nearest place on."""
    store, at = _open(path)
    with store.open_input_stream(at + ".marks", compression=None) as f:
        marks = [m.rsplit("\t", 1) for m in f.read().decode().split("\n") if m]
    first = max(0, bisect.bisect_left([m[0] for m in marks], low) - 1) if low is not None else 0
    last = bisect.bisect_left([m[0] for m in marks], high) if high is not None else len(marks)
    if first >= last:
        return
    start = int(marks[first][1])
    with store.open_input_file(at) as f:
        end = int(marks[last][1]) if last < len(marks) else f.size()
        f.seek(start)
        left, tail = end - start, b""
        while left > 0:
            data = f.read(min(left, 64 << 10))
            left -= len(data)
            *whole, tail = (tail + data).split(b"\n")
            for raw in whole:
                line = raw.decode()
                key = line.split("\t", 1)[0]
                if (low is None or key >= low) and (high is None or key < high):
                    yield line


def _merged(runs: list[str], low: str | None, high: str | None) -> Iterator[str]:
    return iter(LoserTree([_run_lines(r, low, high) for r in runs]))


HISTORY = "range_no int, place long, url_key string, captured string, archive string, offset long, length long"


def _merge_range(batches: Iterator[pa.RecordBatch], runs: Callable[[], list[str]]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
    names = [c.split(" ")[0] for c in HISTORY.split(", ")]
    for batch in batches:
        for number, low, high in zip(*(batch.column(c).to_pylist() for c in ("range_no", "low", "high"))):
            rows = []
            for place, line in enumerate(_merged(runs(), low, high)):
                key, archive, offset, length = line.split("\t")
                url, when, _ = key.rsplit(" ", 2)
                rows.append((number, place, url, when, archive, int(offset), int(length)))
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)


def _merge_group(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One longer run out of each group of runs."""
    for batch in batches:
        for runs in batch.column("runs").to_pylist():
            path = f"{folder}/merged-{uuid.uuid4().hex}.run"
            yield _manifest([(path, *_write_run(path, _merged(sorted(runs), None, None)))])


def merge_index(runs: DataFrame, folder: str, fan_in: int = FAN_IN, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Globally ordered capture histories (by range_no, place) out of the sorted runs, stored."""
    spark = runs.sparkSession
    while (count := runs.count()) > fan_in:
        groups = runs.withColumn("g", F.pmod(F.xxhash64("run"), F.lit(-(-count * 2 // fan_in))))
        groups = groups.groupBy("g").agg(F.collect_list("run").alias("runs")).select("runs").repartition(-(-count * 2 // fan_in))
        runs = stored(groups.mapInArrow(lambda b: _merge_group(b, folder), RUNS), "warc-runs")
    total = runs.agg(F.sum("bytes")).first()[0] or 0
    n = pieces(total, range_bytes, at_least=min(12, max(1, count)))
    each = max(1, SAMPLES // max(1, count))
    some = F.filter("samples", lambda _, i: i % F.greatest(F.lit(1), F.ceil(F.size("samples") / each)) == 0)
    keys = sorted(r[0] for r in runs.select(F.explode(some)).collect())  # at most SAMPLES and a key for each run
    bounds = sorted({keys[len(keys) * k // n] for k in range(1, n)}) if keys else []
    names = spark.sparkContext.broadcast(sorted(r["run"] for r in runs.select("run").collect()))  # at most fan_in names
    edges = [None, *bounds, None]
    ranges = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "range_no int, low string, high string"
    ).repartitionByRange(len(edges) - 1, "range_no")
    return stored(ranges.mapInArrow(lambda b: _merge_range(b, lambda: names.value), HISTORY), "warc-index")


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    name, stream = None, None
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(),
             "refers_to": pa.int64(), "url_key": pa.string(), "captured": pa.string()}
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("archive", "offset", "length", "url_key", "captured")]
        for archive, offset, length, key, when in zip(*columns):
            if archive != name:
                if stream is not None:
                    stream.close()
                store, at = _open(f"{folder}/{archive}")
                name, stream = archive, store.open_input_file(at)
            stream.seek(offset)
            rows.append(parse_record(gzip.decompress(stream.read(length))) | {"url_key": key, "captured": when})
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], type=k) for c, k in kinds.items()], names=list(kinds)
            )
    if stream is not None:
        stream.close()


def read_records(histories: DataFrame, folder: str) -> DataFrame:
    """The records that the index names, each archive read once from front to back."""
    by_archive = histories.select("archive", "offset", "length", "url_key", "captured")
    n = by_archive.select("archive").distinct().count()
    return (
        by_archive.repartition(max(1, min(n, 4096)), "archive")
        .sortWithinPartitions("archive", "offset")
        .mapInArrow(
            lambda b: _read(b, folder),
            "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
            "url_key string, captured string",
        )
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("captured", F.lit(EPOCH) + F.coalesce(F.pmod("page_id", F.lit(10**9)), F.lit(0)))
    folder = shared_path(spark, "warc")
    histories = merge_index(write_archives(pages, folder), folder)
    return read_records(histories, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= {MIN_REVISIT} GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN f.first < coalesce(p.page_id, 9223372036854775807) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first < coalesce(p.page_id, 9223372036854775807) THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""
