"""Similarity join of shingle sets by token-combination prefixes.

Tokens (shingle hashes) are ordered by their corpus frequency.  Rare tokens
form class 1; frequent ones are dealt by hash into subclasses of class 2 and 3.
A document's prefix is the shortest run of its ordered tokens whose classes
yield more than its allowed mismatches: n tokens of a subclass of class k
yield n - k + 1, as that many must mismatch before no k of them are shared.  So
two sets that link share, within their prefixes, a class-1 token or k tokens
of a subclass of class k; these single tokens and k-token combinations are
indexed.  Subclasses depend on a level (a band of set sizes), so that their
combinations stay in proportion to the prefix; a document is indexed on its
own level and the next, and two sets that link have a level in common.

Shared signatures are then verified on the whole sets.  Within a signature's
documents the one with the fewest rare tokens is the hub: it is verified
against the others, links are closed to components, and only pairs of
different components are compared further.  In the end documents that many
signatures bring together, as edits of one text are, get a hub once more, and
are paired by tokens in which both differ from it.  No pair is left out that
could join two components, no cap is set, and no group meets in one task.

Frequencies are counted exactly, by Spark: documents are read in parts, a part
sends its distinct tokens (KEY_BITS of each) once to the buckets that count
them, and each bucket answers with the counts in the order of the part's
tokens.  Nothing of that is held by the driver or by all tasks.  Being only an
order, tokens that agree in their KEY_BITS cost time, never a link.

Defined cases: a document without words or text has an empty set and links
with nothing; rows of the same doc_id are one document, linked by each of
their texts; a null doc_id cannot be named by a component: such rows get a
null component and link with nothing; repeated rows each get a row; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import pieces, stored, table
from tidewater.llm.components import components
from tidewater.llm.shingles import mix64, shingle_set
from tidewater.llm.substring_dedup import _numbers, _planes, _rows

#: Text bytes of a part, and those whose tokens one bucket counts; bits of a token by which it is counted.
PART_BYTES, BUCKET_BYTES, KEY_BITS = 4 << 20, 8 << 20, 40
#: Counters of ``prefix_signatures``, where counts come by slot.
COUNTERS = 1 << 22
#: Tokens seen more often than this are of class 2, or 3.
FREQUENT, VERY_FREQUENT = 8, 256
#: Hub rounds go on while the pairs left exceed this many for each posting left.
PAIRS_PER_POSTING = 8


class Threshold:
    """Jaccard >= num/den, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def mismatches(self, n: int) -> int:
        """Most tokens of a set of n that a linked set may lack."""
        return n - -(-self.num * n // self.den)

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        if self.den * min(len(a), len(b)) < self.num * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)

    def level(self, n: int) -> int:
        return int(math.log(n) / math.log(self.den / self.num) + 1e-9)

    def may_link(self, size_a: Column, rest_a: Column, size_b: Column, rest_b: Column) -> Column:
        """Size filter, and room for enough common tokens from the shared signature on."""
        return (self.den * F.least(size_a, size_b) >= self.num * F.greatest(size_a, size_b)) & (
            (self.num + self.den) * F.least(rest_a, rest_b) >= self.num * (size_a + size_b)
        )

    def may_differ(self, apart: Column, sizes: Column) -> Column:
        """Sets of these sizes (their sum) link if and only if they differ by as few tokens."""
        return (self.num + self.den) * apart <= (self.den - self.num) * sizes

    def may_be_first(self, linked: Column, i: Column, n: Column, size: Column) -> Column:
        """Of a set's n tokens that differ from a hub, the i-th may be the first that a linked set has too."""
        return F.when(linked, (self.num + self.den) * i < self.den * n).otherwise(self.num * i <= (self.den - self.num) * size)


# ---- first pass: sizes, set hashes and each part's tokens ----

SURVEY = "part long, doc_id long, n long, set_hash binary, body binary, bucket int, tokens binary, counts binary"
SURVEY_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary())


def _keys(tokens: np.ndarray) -> np.ndarray:
    return tokens >> np.uint64(64 - KEY_BITS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split(" ")[0] for c in SURVEY.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), SURVEY_TYPES)], names=names)


def _survey(batches: Iterator[pa.RecordBatch], size: int, buckets: int, least: int) -> Iterator[pa.RecordBatch]:
    """A row for each document, with its text if it is to be indexed, and rows of each part's tokens by bucket."""
    import xxhash
    from pyspark import TaskContext

    pack = zstandard.ZstdCompressor(level=1)
    part, n_bytes = TaskContext.get().partitionId() << 32, 0
    rows: list[tuple] = []
    sets: dict[bytes, np.ndarray] = {}

    def tokens() -> Iterator[tuple]:
        if sets:
            keys, counts = np.unique(_keys(np.concatenate([*sets.values()])), return_counts=True)
            bucket = _bucket(keys, buckets)
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for at, k, c in zip(bucket[np.r_[0, cut]].tolist(), np.split(keys, cut), np.split(counts, cut)):
                yield (part, None, None, None, None, at, _planes(np.diff(k, prepend=np.uint64(0)), KEY_BITS // 8), _planes(c, 4))

    for batch in batches:
        for doc, text in _rows(batch):
            found = shingle_set(text, size)
            name, body = xxhash.xxh3_128_digest(found.tobytes()), None
            if len(found) >= least and doc is not None:
                raw = text.encode()
                sets[name], body = found, pack.compress(raw)
                n_bytes += len(raw)
            rows.append((part, doc, len(found), name, body, None, None, None))
            if n_bytes >= PART_BYTES or len(rows) >= PART_BYTES // 64:
                yield _batch(rows + [*tokens()])
                part, n_bytes, rows, sets = part + 1, 0, [], {}
    if rows:
        yield _batch(rows + [*tokens()])


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of keys, so a part's sorted keys are those of its buckets one after the other."""
    return ((keys >> np.uint64(KEY_BITS - 24)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts in a byte: as they are up to 200, then in steps of a quarter of an octave."""
    above = 200 + np.minimum(55, 4 * np.log2(np.maximum(counts, 200) / 200))
    return np.where(counts <= 200, counts, above).astype(np.uint8)


def _count(got: pa.Table) -> pa.Table:
    """The counts of a bucket's tokens over all parts, to each part in the order of its tokens."""
    keys = [np.cumsum(_numbers(raw, KEY_BITS // 8)) for raw in got.column("tokens").to_pylist()]
    each = np.concatenate([_numbers(raw, 4) for raw in got.column("counts").to_pylist()])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    level = _levels(np.bincount(at, weights=each))[at]
    often = [x.tobytes() for x in np.split(level, np.cumsum([len(k) for k in keys])[:-1])]
    return pa.Table.from_arrays([got.column("part"), got.column("bucket"), pa.array(often, type=pa.binary())], names=["part", "bucket", "often"])


def token_counts(survey: DataFrame) -> DataFrame:
    """(part, bucket, often): how often the tokens of a part occur in all parts."""
    sent = survey.where("bucket is not null").select("part", "bucket", "tokens", "counts")
    return sent.groupBy("bucket").applyInArrow(_count, "part long, bucket int, often binary")


# ---- second pass: signatures of each distinct set ----


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - 22)).astype(np.int64)


def prefix_signatures(
    tokens: np.ndarray, counts: np.ndarray, limits: tuple[float, float], threshold: Threshold
) -> tuple[np.ndarray, np.ndarray]:
    """As ``signatures``, of tokens whose counts are found by their slot."""
    return signatures(tokens, counts[_slot(tokens)], limits, threshold)


def signatures(
    tokens: np.ndarray, often: np.ndarray, limits: tuple[float, float], threshold: Threshold
) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, tokens that stand before each and are not shared where it is the first shared one)."""
    n = len(tokens)
    need = threshold.mismatches(n) + 1
    order = np.lexsort((tokens, often))
    tokens, often = tokens[order], often[order]
    rare = int(np.searchsorted(often, limits[0], side="right"))
    if rare >= need:
        return mix64(tokens[:need]).astype(np.int64), np.arange(need)
    out, before = [mix64(tokens[:rare]).astype(np.int64)], [np.arange(rare)]
    own = threshold.level(n)
    for level in (own, own + 1):
        top = threshold.mismatches(int((threshold.den / threshold.num) ** (level + 1)) + 1) + 1
        kinds = {2: -(-top // 2), 3: -(-top // 3)}
        members: dict[tuple[int, int], list[int]] = {}
        gained = rare
        for t, c in zip(tokens[rare:].tolist(), often[rare:].tolist()):
            if gained >= need:
                break
            k = 2 if c <= limits[1] else 3
            group = members.setdefault((k, t % kinds[k]), [])
            group.append(t)
            gained += len(group) >= k
        found = [
            (level * 4 + k, *(c if k == 3 else (*c, 0)))
            for (k, _), group in members.items()
            for c in itertools.combinations(sorted(group), k)
        ]
        if found:
            x = np.array(found, dtype=np.uint64)
            s = mix64(x[:, 1]) * np.uint64(3) + mix64(x[:, 2]) * np.uint64(5) + mix64(x[:, 3]) * np.uint64(7)
            out.append(mix64(s + mix64(x[:, 0])).astype(np.int64))
            before.append(np.full(len(found), rare))
    return np.concatenate(out), np.concatenate(before)


SIGNED = "node long, set_hash binary, size int, sig array<long>, rest array<int>"


def _signatures(docs: pa.Table, counts: pa.Table, size: int, limits, threshold: Threshold) -> pa.Table:
    """Signatures of the documents of a part, given the counts of its tokens."""
    unpack = zstandard.ZstdDecompressor()
    sets: dict[bytes, np.ndarray] = {}
    for name, body in zip(docs.column("set_hash").to_pylist(), docs.column("body").to_pylist()):
        if name not in sets:
            sets[name] = shingle_set(unpack.decompress(body).decode(), size)
    by_bucket = sorted(zip(counts.column("bucket").to_pylist(), counts.column("often").to_pylist()))
    often = np.frombuffer(b"".join(x for _, x in by_bucket), dtype=np.uint8)
    keys, at = np.unique(_keys(np.concatenate([*sets.values()])), return_inverse=True)
    if len(keys) != len(often):
        raise ValueError("a part's tokens and their counts differ")
    often = np.split(often[at], np.cumsum([len(x) for x in sets.values()])[:-1])
    found = {}
    for (name, tokens), o in zip(sets.items(), often):
        # the first are those of tokens that no other set has: nothing shares these signatures
        alone = np.count_nonzero(o == 1)
        sig, before = signatures(tokens, o, limits, threshold)
        found[name] = sig[alone:], before[alone:]
    rows = []
    for doc, name in zip(docs.column("doc_id").to_pylist(), docs.column("set_hash").to_pylist()):
        (sig, before), n = found[name], len(sets[name])
        if len(sig):
            rows.append((doc, name, n, sig, (n - before).astype(np.int32)))
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    names = [c.split(" ")[0] for c in SIGNED.split(", ")]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)


def smallest_varied(threshold: Threshold) -> int:
    """Least size of a set that can link with a different set (smaller ones link with equal sets only)."""
    n = 1
    while threshold.den * n < threshold.num * (n + 1):
        n += 1
    return n


# ---- verification ----


def _verify(batches: Iterator[pa.RecordBatch], size: int, threshold: Threshold) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    last, hub = None, None
    for batch in batches:
        rows = []
        for u, v, one, other in zip(*(batch.column(c).to_pylist() for c in ("u", "v", "body_u", "body_v"))):
            if last is None or last != one:
                last, hub = one, shingle_set(unpack.decompress(one).decode(), size)
            if threshold.links(hub, shingle_set(unpack.decompress(other).decode(), size)):
                rows.append((u, v))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows)], names=["u", "v"])


DIFFERENCES = "u long, hub_set long, v long, own_set long, size int, n int, linked boolean, apart array<long>"
DIFFERENCE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int64()))
#: Tokens of a batch of differences.
BATCH_TOKENS = 1 << 20


def _differences(batches: Iterator[pa.RecordBatch], size: int, threshold: Threshold) -> Iterator[pa.RecordBatch]:
    """For each hub u and document v the tokens that only one of their sets has, and whether they link."""
    import xxhash

    unpack = zstandard.ZstdDecompressor()
    name = lambda tokens: xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)
    names = [c.split(" ")[0] for c in DIFFERENCES.split(", ")]
    make = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), DIFFERENCE_TYPES)], names=names)
    last, hub, hub_set = None, None, 0
    for batch in batches:
        rows, held = [], 0
        for u, v, one, other in zip(*(batch.column(c).to_pylist() for c in ("u", "v", "body_u", "body_v"))):
            if last is None or last != one:
                last, hub = one, shingle_set(unpack.decompress(one).decode(), size)
                hub_set = name(hub)
            own = shingle_set(unpack.decompress(other).decode(), size)
            apart = np.setxor1d(hub, own, assume_unique=True).astype(np.int64)
            rows.append((u, hub_set, v, name(own), len(own), len(apart), threshold.links(hub, own), apart))
            held += len(apart)
            if held >= BATCH_TOKENS:
                yield make(rows)
                rows, held = [], 0
        if rows:
            yield make(rows)


def _with_bodies(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    side = lambda c: bodies.select(F.col("node").alias(c), F.col("body").alias(f"body_{c}"))
    return pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "body_u", "body_v")


def _links(pairs: DataFrame, bodies: DataFrame, size: int, threshold: Threshold) -> DataFrame:
    """The pairs (u, v) whose whole sets link."""
    return _with_bodies(pairs, bodies).mapInArrow(lambda b: _verify(b, size, threshold), "u long, v long")


# ---- the join ----


def similarity_classes(documents: DataFrame, size: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id (least doc_id reachable by links of Jaccard >= num/den)."""
    spark, threshold = documents.sparkSession, Threshold(num, den)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, least = pieces(total, BUCKET_BYTES, at_least=4), smallest_varied(threshold)
    survey = stored(docs.mapInArrow(lambda b: _survey(b, size, buckets, least), SURVEY), "survey")
    limits = tuple(int(x) for x in _levels(np.array([FREQUENT, VERY_FREQUENT])))

    sets = survey.where("bucket is null and n > 0 and doc_id is not null").groupBy("set_hash").agg(F.min("doc_id").alias("node"))
    indexed = survey.where("body is not null").select("part", "doc_id", "set_hash", "body")
    signed = indexed.groupBy("part").cogroup(token_counts(survey).groupBy("part")).applyInArrow(
        lambda d, c: _signatures(d, c, size, limits, threshold), SIGNED
    )
    # one document of each distinct set is indexed
    rows = stored(signed.join(sets, ["node", "set_hash"], "left_semi").select("node", "size", "sig", "rest"), "signatures")
    postings = rows.select("node", "size", F.inline(F.arrays_zip("sig", "rest")))
    shared = postings.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1").select("sig")
    live = stored(postings.join(shared, "sig"), "postings")
    bodies = indexed.select(F.col("doc_id").alias("node"), "body").join(live.select("node").distinct(), "node", "left_semi")
    bodies = stored(bodies, "bodies")

    linked = _close(live, bodies, size, threshold)
    own = survey.where("bucket is null").select("doc_id", F.col("n").alias("n_shingles"), "set_hash")
    named = (
        own.where("n_shingles > 0 and doc_id is not null")
        .join(sets, "set_hash")
        .join(linked, "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    )
    rest = own.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return _one_document(named).unionByName(rest)


def _one_document(named: DataFrame) -> DataFrame:
    """Rows that share a doc_id but not a set join their components: an edge for each such row.

    Ids are unique in a sound table, so this is an empty edge table as a rule.
    """
    several = named.groupBy("doc_id").agg(F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).where("lo <> hi")
    if several.isEmpty():
        return named
    edges = named.join(several.select("doc_id", "lo"), "doc_id").where("component_id <> lo")
    joined = components(edges.select(F.col("component_id").alias("u"), F.col("lo").alias("v")))
    return (
        named.join(joined, named["component_id"] == joined["node"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "component_id").alias("component_id"))
    )


def _close(live: DataFrame, bodies: DataFrame, size: int, threshold: Threshold) -> DataFrame:
    """(node, component) of the nodes that link, hub by hub and then pair by pair across components."""
    edges: DataFrame | None = None
    labels: DataFrame | None = None
    left = live.select("sig", "node", "size", "rest", F.col("node").alias("label"))
    while True:
        # all pairs with the signature's hub: the document with the most tokens from here on, then the least id
        hubs = left.groupBy("sig").agg(
            F.max(F.struct((F.col("rest") - F.col("size")).alias("k"), (-F.col("node")).alias("m"), "size", "rest", "label")).alias("hub")
        )
        hubs = hubs.select("sig", (-F.col("hub.m")).alias("hub"), F.col("hub.size").alias("hub_size"),
                           F.col("hub.rest").alias("hub_rest"), F.col("hub.label").alias("hub_label"))
        pairs = (
            left.join(hubs, "sig")
            .where((F.col("label") != F.col("hub_label")) & threshold.may_link(F.col("size"), F.col("rest"), F.col("hub_size"), F.col("hub_rest")))
            .select(F.col("hub").alias("u"), F.col("node").alias("v"))
            .distinct()
        )
        found = stored(_links(pairs, bodies, size, threshold), "links")
        some = not found.isEmpty()
        if some:
            edges = found if edges is None else edges.unionAll(found)
            labels = components(edges)
        # what may still join two components: postings of signatures with several, without their hubs
        rest = left.join(hubs.select("sig", F.col("hub").alias("node")), ["sig", "node"], "left_anti").drop("label")
        if labels is not None:
            rest = rest.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
        else:
            rest = rest.withColumn("label", F.col("node"))
        open_ = rest.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("sig")
        left = stored(rest.join(open_, "sig", "left_semi").select("sig", "node", "size", "rest", "label"), "open")
        same = left.groupBy("sig", "label").agg(F.count("*").alias("c"))
        size_of = same.groupBy("sig").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("s"))
        count = size_of.agg(F.sum("n").alias("n"), F.sum((F.col("n") * F.col("n") - F.col("s")) / 2).alias("pairs")).first()
        if not count["n"] or not some or count["pairs"] <= PAIRS_PER_POSTING * count["n"]:
            break
    if count["n"]:
        linked, pairs = _across(left, bodies, size, threshold)
        found = stored(linked.unionAll(_links(pairs, bodies, size, threshold)), "links")
        if not found.isEmpty():
            edges = found if edges is None else edges.unionAll(found)
            labels = components(edges)
    if labels is None:
        return live.sparkSession.createDataFrame([], "node long, component long")
    return labels


def _across(left: DataFrame, bodies: DataFrame, size: int, threshold: Threshold) -> tuple[DataFrame, DataFrame]:
    """Links found on the way, and distinct pairs (u, v) of different components that may still link.

    Documents of a signature that few share are paired with each other; those
    of the others are paired by what sets them apart from a common hub.
    """
    many = left.groupBy("sig").agg(F.count("*").alias("c")).where(F.col("c") > FREQUENT).select("sig")
    few = _small_groups(left.join(many, "sig", "left_anti"), threshold)
    if many.isEmpty():
        return few.limit(0), few
    linked, pairs = _by_hub(left.join(many, "sig", "left_semi"), bodies, size, threshold)
    return linked, few.unionAll(pairs).distinct()


def _small_groups(left: DataFrame, threshold: Threshold) -> DataFrame:
    """Distinct pairs (u, v) of different components with a common signature and room enough.

    Documents with the same label, size and signatures meet the same others, so
    they are joined as one group, whose pairs are spread out once in the end.
    """
    sigs = F.sort_array(F.collect_set(F.struct("sig", "rest")))
    member = left.groupBy("node", "label", "size").agg(sigs.alias("sigs"))
    member = stored(member.select("node", "label", "size", "sigs", F.xxhash64("label", "size", "sigs").alias("g")), "alike")
    groups = member.groupBy("g", "label", "size").agg(F.first("sigs").alias("sigs"))
    groups = groups.select("g", "label", "size", F.inline("sigs"))
    a, b = groups.alias("a"), groups.alias("b")
    met = (
        a.join(b, F.col("a.sig") == F.col("b.sig"))
        .where((F.col("a.g") < F.col("b.g")) & (F.col("a.label") != F.col("b.label")))
        .where(threshold.may_link(F.col("a.size"), F.col("a.rest"), F.col("b.size"), F.col("b.rest")))
        .select(F.col("a.g").alias("gu"), F.col("b.g").alias("gv"))
        .distinct()
    )
    one = member.select(F.col("g").alias("gu"), F.col("node").alias("u"))
    other = member.select(F.col("g").alias("gv"), F.col("node").alias("v"))
    return met.join(one, "gu").join(other, "gv").select("u", "v").distinct()


def _by_hub(left: DataFrame, bodies: DataFrame, size: int, threshold: Threshold) -> tuple[DataFrame, DataFrame]:
    """As ``_across``, by each document's difference from its signatures' hub.

    Sets of sizes s and t link if and only if they differ by at most
    most(s, t) = (den - num) / (den + num) * (s + t) tokens.  Two sets differ
    by what their differences from a hub differ by, so of differences of a and
    b tokens a link needs (a + b - most) / 2 in common.  Where both link with
    the hub nothing is left to find; if b's set does not, a + b - most is more
    than 2 * a * num / (num + den), as the sizes of a's set and the hub's are
    within a tokens: a token in common is certain.  Tokens are ordered by how
    many differences from the hub have them, and the first one in common must
    leave enough behind it on either side.
    """
    often = left.groupBy("node").agg(F.count("*").alias("w"))
    hubs = left.join(often, "node").groupBy("sig").agg(F.max(F.struct("w", (-F.col("node")).alias("m"))).alias("hub"))
    hubs = hubs.select("sig", (-F.col("hub.m")).alias("u"))
    met = left.join(hubs, "sig").where("node <> u").select("u", F.col("node").alias("v")).distinct()
    far = _with_bodies(met, bodies).mapInArrow(lambda b: _differences(b, size, threshold), DIFFERENCES)
    far = stored(far, "differences")

    hub, own = ["u", "hub_set"], ["v", "own_set", "size", "n", "linked"]
    each = far.select(*hub, *own, F.explode("apart").alias("token"))
    shared = each.groupBy(*hub, "token").agg(F.count("*").alias("c")).where("c > 1")
    order = each.join(shared, [*hub, "token"]).groupBy(*hub, *own).agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("t"))
    order = order.join(left.select(F.col("node").alias("v"), "label").distinct(), "v")
    # those of one document alone come first and are not listed
    at = order.select(*hub, *own, "label", (F.col("n") - F.size("t")).alias("alone"), F.posexplode("t").alias("i", "t"))
    at = at.select(*hub, *own, "label", (F.col("alone") + F.col("i")).alias("i"), F.col("t.token").alias("token"))
    at = stored(at.where(threshold.may_be_first(F.col("linked"), F.col("i"), F.col("n"), F.col("size"))), "apart")
    a, b = at.alias("a"), at.alias("b")
    c = lambda name: (F.col(f"a.{name}"), F.col(f"b.{name}"))
    behind = F.least(*(n - i for n, i in zip(c("n"), c("i"))))
    pairs = (
        a.join(b, [F.col(f"a.{x}") == F.col(f"b.{x}") for x in (*hub, "token")])
        .where((F.col("a.v") < F.col("b.v")) & (F.col("a.label") != F.col("b.label")) & ~(F.col("a.linked") & F.col("b.linked")))
        .where(threshold.may_differ(sum(c("n")) - 2 * behind, sum(c("size"))))
        .select(F.col("a.v").alias("u"), F.col("b.v").alias("v"))
        .distinct()
    )
    return far.where("linked").select("u", "v"), pairs


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reached = e.x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id
JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""
