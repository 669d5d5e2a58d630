"""Benchmark decontamination: find test n-grams in training documents.

Built from DataFrame functions only.  The benchmark's normalised windows form
a broadcast hash table; every document is turned into an array of window
hashes, probed against it, and each hash hit is verified word by word.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased.  A window is ``n`` consecutive words of an item; an item of fewer
words, but not none, is one window.  A document word that lies inside any
occurrence of a window is hit.

Defined cases: null text has no words; a null ``doc_id`` or ``item_id`` is a
value like any other (a null item is not named in the list of items);
repeated rows each get their own result row; an empty benchmark or an empty
document table gives no hits or no rows; extra columns on either side are
ignored by ``contamination`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, fresh, table

WINDOW = 10
#: Windows in one broadcast; a larger benchmark is probed in blocks of this size.
MAX_BROADCAST_WINDOWS = 500_000
#: Hash value of the marker row; a window that happens to have it is told apart by its words.
MARKER = 0
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct (item_id, window, len, h): the items' windows and their hash."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0)))
    return (
        items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, n))).alias("window"))
        .distinct()
        .select("item_id", "window", F.size("window").alias("len"), F.xxhash64("window").alias("h"))
    )


def _window_hashes(length: int) -> Column:
    """Hash of each run of ``length`` words; empty for a shorter document."""
    every = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("n_words") - length, F.lit(0))),
        lambda i: F.xxhash64(F.slice("w", i + 1, length)),
    )
    return F.when(F.col("n_words") >= length, every).otherwise(F.array().cast("array<bigint>"))


def contamination(
    documents: DataFrame, benchmark: DataFrame, n: int = WINDOW, block: int = MAX_BROADCAST_WINDOWS
) -> DataFrame:
    """Per document row: doc_id, text_hash, n_words, spans, items.

    ``spans`` are the hit (start, len) word windows, ``items`` the ids of the
    items with an occurring window.  The documents' texts are read once for
    each block of ``block`` windows and never shuffled: what moves is a row per
    document and one per verified hit.
    """
    windows = benchmark_windows(benchmark, n)
    known = windows.agg(F.count("*").alias("c"), F.collect_set("len").alias("lens")).first()
    lens, blocks = sorted(known["lens"]), max(1, -(-known["c"] // block))
    docs = (
        documents.select("doc_id", F.col("text"))
        .select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
        .withColumn("n_words", F.size("w"))
    )
    # Entry 0 of a document's array stands for the document itself; a marker row among the windows keeps it.
    hashes = F.concat(F.array(F.lit(MARKER).cast("bigint")), *[_window_hashes(x) for x in lens])
    spark = documents.sparkSession
    marker = spark.range(1).select(
        F.lit(MARKER).cast("bigint").alias("wh"), F.lit(None).cast("array<string>").alias("window"),
        F.lit(None).cast(windows.schema["item_id"].dataType).alias("item_id"),
    )
    probes = docs.select("doc_id", "text_hash", "n_words", "w", F.posexplode(hashes).alias("p", "h"))
    first, length, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1)
    for x in lens:  # which run of which length stands at place p of the array
        here = F.col("p") >= before
        first, length = F.when(here, F.col("p") - before).otherwise(first), F.when(here, F.lit(x)).otherwise(length)
        before = before + F.greatest(F.col("n_words") - x + 1, F.lit(0))
    parts = []
    for k in range(blocks):
        part = windows.where(F.pmod("h", F.lit(blocks)) == k) if blocks > 1 else windows
        # at most `block` windows by count (hash blocks vary by a little), of n words each
        part = part.select(F.col("h").alias("wh"), "window", "item_id")
        part = F.broadcast(part.unionAll(marker) if k == 0 else part)
        is_hit = (F.col("p") > 0) & (F.slice("w", first + 1, length) == F.col("window"))
        parts.append(
            probes.join(part, F.col("h") == F.col("wh"))
            .where(is_hit | ((F.col("p") == 0) & F.col("window").isNull()))
            .select("doc_id", "text_hash", "n_words", "p", first.alias("start"), length.alias("span_len"), "item_id")
        )
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionAll(more)
    hit = F.col("p") > 0
    return (
        rows.groupBy("doc_id", "text_hash", "n_words")
        .agg(
            F.count(F.when(~hit, 1)).cast("int").alias("copies"),
            F.collect_set(F.when(hit, F.struct("start", "span_len"))).alias("spans"),
            F.collect_set(F.when(hit, F.col("item_id"))).alias("items"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .drop("copies", "copy")
    )


def hit_words(spans: Column) -> Column:
    """Number of distinct word positions in a list of (start, span_len)."""
    each = F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["span_len"] - 1))
    return F.size(F.array_distinct(F.flatten(each)))


def decontaminate(documents: DataFrame, benchmark: DataFrame, n: int = WINDOW, min_hit_share: float = 0.0) -> DataFrame:
    """The rows of ``documents`` without the contaminated ones.

    A document goes when more than ``min_hit_share`` of its words are hit.
    Columns and untouched rows stay as they are; null ids are matched as null.
    """
    id_, hash_ = fresh(documents.columns, "id_"), fresh(documents.columns, "hash_")
    bad = (
        contamination(documents.select("doc_id", "text"), benchmark, n)
        .where(F.size("spans") > 0)
        .where(hit_words(F.col("spans")) > F.lit(min_hit_share) * F.col("n_words"))
        .select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
        .distinct()
    )
    same = documents["doc_id"].eqNullSafe(F.col(id_)) & (F.xxhash64(documents["text"]) == F.col(hash_))
    return documents.join(bad, same, "left_anti")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit_words(F.col("spans")).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS l
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT l FROM win
), pos AS (
  SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lens WHERE len(w) >= l)
), hit AS (SELECT pos.doc_id, pos.i, pos.l, win.item_id FROM pos JOIN win ON pos.g = win.g AND pos.l = win.l
), n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(it.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(it.names, '')) AS items_sha256,
  coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""
