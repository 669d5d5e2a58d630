"""Spelling variants: words one edit apart, each grouped under its most frequent neighbour.

The words form a trie that is kept as a distributed edge table, and the search
for neighbours is a frontier of (word, position, node) states that is joined
with that table level by level.  A state has used no edit while it is on the
word's own path, and one edit once it has left it:

* Chains without branches are one edge (first character, label, child), so a
  level is one branching or word-ending node, not one character.
* On its own path a state leaves by an edge whose first character differs from
  the word's next: the character was replaced, or the neighbour has it in
  addition.  Deletions are the same pairs read the other way round.
* After that the label must equal the word's next characters, and a state that
  has read its whole word at a word-ending node is a neighbour.
* An edit is only looked for in a word's second half; the trie of the reversed
  words finds those of the first half.  Own paths are long and edges few there,
  so a state has a handful of successors where an edit at the root would have
  one for each first letter, and nothing in the frontier pairs words by group.

A node has at most one edge a character of the alphabet (90 here), so states
are linear in the words, also where a third of them share a node; that node's
join is split by adaptive execution, as each frontier is written straight
after its join.

Defined cases: null and empty texts have no words; repeated rows count again;
a null doc_id is written as an empty string before the colon; extra columns
are ignored; an empty table gives no rows.  Among near words of equal count the
smallest in code-point order is the form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, stored, table
from tidewater.llm.crc_sql import CRC_TABLE, crc32_sql
from tidewater.llm.shingles import mix64

#: Fixed value of the contract: a run of letters.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form is at least so many times as frequent as the word.
RATIO = 2
#: A run whose hash this divides loses one code point.
THINNED = 97

NODE = ["side", "depth", "k1", "k2"]
_SEEDS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


def word_counts(
    documents: DataFrame, thinned: int = THINNED, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n): runs of letters, A-Z lowered, counted over all documents."""
    runs = documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    # of a run of ASCII letters, lower() is the same and much faster
    run = F.col("run")
    lowered = F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(ascii_lower(run))
    runs = runs.select("doc_id", lowered.alias("run"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = runs.select("run", F.crc32(F.encode(name, "UTF-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    thin = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % thinned == 0, thin).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


# ---- the trie as relations ----


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes on each word's path, forward (side 0) and reversed (side 1), from its middle on.

    A node's key is a sum of 64-bit mixes of (place, character), twice, beside its depth.
    ``next`` is the character after the node, -1 at the word's end.
    """
    for batch in batches:
        words = batch.column("word").to_pylist()
        size = np.array([len(w) for w in words], dtype=np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        start = np.cumsum(size) - size
        place = np.arange(len(code)) - np.repeat(start, size)
        for side in (0, 1):
            if side:
                code = code[np.repeat(start + size - 1, size) - place]
            low = (size - 1) // 2
            count = size - low + 1
            row = np.repeat(np.arange(len(words)), count)
            depth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[row]
            keys = []
            for seed in _SEEDS:
                part = mix64((code.astype(np.uint64) << np.uint64(40)) ^ place.astype(np.uint64) ^ seed)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
                keys.append((sums[start[row] + depth] - sums[start[row]]).view(np.int64))
            ends = depth == size[row]
            following = np.where(ends, -1, code[np.minimum(start[row] + depth, max(len(code) - 1, 0))])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(row), side, np.int8)), pa.array(depth.astype(np.int32)),
                    pa.array(keys[0]), pa.array(keys[1]), pa.array(following.astype(np.int32)),
                    batch.column("word").take(pa.array(row)), batch.column("n").take(pa.array(row)),
                ],
                names=[*NODE, "next", "word", "n"],
            )


def _sided(side: Column, word: Column) -> Column:
    return F.when(side == 1, F.reverse(word)).otherwise(word)


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(own, edges): each word's branching or word-ending nodes, and the edges between such nodes.

    own: side, depth, k1, k2, word, n, forks (whether a path other than the word's leads on).  edges: side, k1, k2 (parent), head (first
    character), label, c1, c2 (child), ends, ends_n (the word that ends at the child, or null),
    heads (the first characters of the edges below the child).
    """
    path = words.mapInArrow(_prefixes, "side byte, depth int, k1 long, k2 long, next int, word string, n long")
    nodes = path.groupBy(*NODE).agg(F.min("next").alias("least"), F.max("next").alias("most"))
    nodes = nodes.where("least <> most or least = -1").select(*NODE, F.expr("least <> most").alias("forks"))
    own = stored(path.drop("next").join(nodes, NODE), "trie-nodes")
    down = Window.partitionBy("side", "word").orderBy("depth")
    steps = own.withColumns({
        "below": F.lead("depth").over(down), "c1": F.lead("k1").over(down), "c2": F.lead("k2").over(down),
    }).where("below is not null")
    label = F.substring(_sided(F.col("side"), F.col("word")), F.col("depth") + 1, F.col("below") - F.col("depth"))
    last = F.col("below") == F.length("word")
    edges = steps.groupBy("side", "k1", "k2", label.alias("label"), "c1", "c2").agg(
        F.max(F.when(last, F.col("word"))).alias("ends"), F.max(F.when(last, F.col("n"))).alias("ends_n")
    )
    edges = stored(edges.withColumn("head", F.substring("label", 1, 1)), "trie-steps")
    below = edges.groupBy("side", F.col("k1").alias("c1"), F.col("k2").alias("c2")).agg(
        F.concat_ws("", F.collect_set("head")).alias("heads")  # as many as the alphabet has, at most
    )
    return own, stored(edges.join(below, ["side", "c1", "c2"], "left"), "trie-edges")


# ---- the frontier ----

STATE = ["side", "word", "n", "pos", "k1", "k2", "ends", "ends_n"]


def _alive(pos: Column, letters: Column) -> Column:
    """Whether a state at an edge's child can go on: at its word's end where a word ends, else where its next character leads."""
    onward = F.instr(F.col("heads"), F.substring(letters, pos + 1, F.lit(1))) > 0
    return F.when(pos == F.length("word"), F.col("ends").isNotNull()).otherwise(onward)


def _leave(own: DataFrame, edges: DataFrame) -> DataFrame:
    """States with one edit: from each node of the second half of a word's own path, by an edge it does not follow itself."""
    word = _sided(F.col("side"), F.col("word"))
    rest, size = F.expr("substring(label, 2)"), F.length("label")
    here = own.where(F.col("forks") & (F.col("depth") >= F.floor(F.length("word") / 2)))
    here = here.select("side", "k1", "k2", "depth", "word", "n", word.alias("letters"))
    met = here.join(edges, ["side", "k1", "k2"]).where(
        (F.col("depth") == F.length("word")) | (F.substring("letters", F.col("depth") + 1, F.lit(1)) != F.col("head"))
    )
    replaced = (F.col("depth") < F.length("word")) & (
        F.substring("letters", F.col("depth") + 2, size - 1) == rest
    )
    added = F.substring("letters", F.col("depth") + 1, size - 1) == rest
    ends = F.array_compact(F.array(
        F.when(replaced, F.col("depth") + size), F.when(added, F.col("depth") + size - 1)
    ))
    ends = F.filter(ends, lambda pos: _alive(pos, F.col("letters")))
    return met.select("side", "word", "n", F.explode(ends).alias("pos"), F.col("c1").alias("k1"), F.col("c2").alias("k2"),
                      "ends", "ends_n")


def _follow(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The next level: by the edge of the word's next character, if its whole label agrees."""
    open_ = states.where(F.col("pos") < F.length("word")).drop("ends", "ends_n")
    open_ = open_.withColumn("letters", _sided(F.col("side"), F.col("word")))
    open_ = open_.withColumn("head", F.substring("letters", F.col("pos") + 1, F.lit(1)))
    met = open_.join(edges, ["side", "k1", "k2", "head"]).where(
        F.substring("letters", F.col("pos") + 1, F.length("label")) == F.col("label")
    )
    met = met.withColumn("pos", F.col("pos") + F.length("label")).where(_alive(F.col("pos"), F.col("letters")))
    return met.select("side", "word", "n", "pos", F.col("c1").alias("k1"), F.col("c2").alias("k2"), "ends", "ends_n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of distinct words exactly one edit apart.

    ``words`` (word, n) has each word once; words are not empty.
    """
    own, edges = trie(words)
    states, found = stored(_leave(own, edges), "frontier"), None
    while not states.isEmpty():
        hits = states.where((F.col("pos") == F.length("word")) & F.col("ends").isNotNull())
        hits = hits.select("word", "n", F.col("ends").alias("near"), F.col("ends_n").alias("near_n"))
        found = hits if found is None else found.unionAll(hits)
        states = stored(_follow(states, edges), "frontier")
    if found is None:
        found = words.limit(0).select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    longer = found.where(F.length("near") > F.length("word"))
    back = longer.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.unionAll(back).distinct()


# ---- forms ----


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by pointer doubling; counts at least double at each step, so few rounds do."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if now.join(further, "root", "left_semi").isEmpty():
            return now
        now = stored(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word of (word, n): word, form, root, n, n_near, form_n."""
    words = stored(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("fewer"), "near"))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    full = words.join(near, "word", "left")
    form_n = -F.col("best.fewer")
    is_form = form_n >= ratio * F.col("n")
    formed = stored(full.select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, form_n).alias("form_n"),
    ), "forms")
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(table(spark, sf_dir, "documents")))


#: Near words are found by the strings with one character left out; roots by a recursive walk over forms.
ORACLE_SQL = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(text, '{RUN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
per_doc AS (SELECT id || ':' || run AS name, run, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (SELECT run, k, {crc32_sql("name")} AS h FROM per_doc, crc),
kept AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
         ELSE run END AS word, k
  FROM hashed
),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top FROM near GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 2 * w.n THEN b.top END AS form_n,
         CASE WHEN b.top >= 2 * w.n THEN (SELECT min(x.near) FROM near x WHERE x.word = w.word AND x.near_n = b.top) END AS form
  FROM words w LEFT JOIN best b ON w.word = b.word
),
walk AS (
  SELECT word, word AS at, 0 AS steps FROM forms
  UNION ALL SELECT k.word, f.form, k.steps + 1 FROM walk k JOIN forms f ON f.word = k.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, (SELECT arg_max(k.at, k.steps) FROM walk k WHERE k.word = f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f
"""
