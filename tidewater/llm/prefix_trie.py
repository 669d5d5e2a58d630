"""Conversation prefix trie with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it, and it is named by its smallest member and
its depth.  Nodes come from sums over the turns: a prefix's key is the sum of
128 bits of hash of (place, role, text), added up by windows in blocks and
carried from block to block, so that a conversation of any length spreads over
tasks.  Turns are numbered the same way, by ranges of (conversation, turn).

Totals over subtrees come from the forest of parent edges, not from a walk
down the levels, so a chain as deep as the table is long takes a logarithm of
rounds:

* ``below`` of a node is the number of turns its members have from it on; it is
  the subtree total of the member counts and is known from one aggregate.
* In a component, the nodes that hold more than half of its ``below`` are the
  path from its top to its centroid, the least of them.  The total of what
  hangs from the centroid is summed up and added to every node on that path;
  then the centroid is done, each of its children tops a component of its own,
  and the part above remains one.  Every component is at most half as large.
* Which side a node is on follows from the ancestor of its smallest member at
  the centroid's depth, one join on (conversation, depth).
* Components of at most ``PIECE`` turns are dealt out whole and decomposed to
  the end by the same steps within a task.

At most turns / PIECE components are larger than that, and PIECE grows with the
table where there would be more than 65,536 of them, which bounds what is
broadcast.  Nodes shared by many conversations are joined apart, by broadcast,
with the same bound.

Defined cases: rows without a conv_id belong to no conversation; null role and
text are empty; turns are ordered by (turn, role, text), null turns first, so
repeated rows stay as turns of their own; extra columns are ignored; a table
without conversations gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import shuffle_width, stored, table
from tidewater.llm.crc_sql import CRC_TABLE, crc32_sql

#: Turns below the top of a component that one task decomposes.
PIECE = 65_536
#: Bound on broadcast rows: large components, and nodes with many members.
MOST_LARGE = 65_536
#: Turns of a conversation that are added up in one window.
BLOCK = 4096
#: Conversation ids hashed as one string at a time.
ENDS = 8192

SUMS = ["s1", "s2", "s3", "s4"]
NAMED = ["conv_id", "depth"]
TOP = ["top_conv", "top_depth"]


# ---- turns ----


def number_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, code, bytes, part): turns numbered from 1; code is a hash of (role, text), bytes the text's length."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    spread = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.substring("role", 1, 16), F.substring("text", 1, 32)]
    dealt = rows.repartitionByRange(shuffle_width(rows.sparkSession), *spread)
    dealt = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    code = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    # Stored: a row's number must be the same in each later pass.
    at = F.monotonically_increasing_id()
    rows = stored(dealt.select("conv_id", code.alias("code"), F.octet_length("text").alias("bytes"), at.alias("at")), "turns")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    runs = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", (F.coalesce(F.sum("k").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"))
    return rows.join(runs, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") + F.col("shift")).alias("pos"), "code", "bytes", "part"
    )


def with_borrowed_heads(turns: DataFrame, most: int = 9, family: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rebuilt (turns, conversations): the first h turns of conversation c - c % family, then c's own after its first h.

    h is crc32 of c in decimal, modulo ``most``.  conversations: conv_id, n_turns.
    """
    own = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("k"))
    lengths = own.groupBy("conv_id").agg(F.sum("k").alias("n"))
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most
    plan = lengths.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % family})
    based = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(based, "base", "left").select(
        "conv_id", "base", "n", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")
    )
    plan = stored(plan, "borrowed")
    spans = own.select("conv_id", "part").join(plan.select("conv_id", "h", "taken"), "conv_id")
    tails = turns.join(spans, ["conv_id", "part"]).where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "code", "bytes"
    )
    lent = turns.where(F.col("pos") < most).select(F.col("conv_id").alias("base"), "pos", "code", "bytes")
    heads = plan.join(lent, "base").where("pos <= taken").select("conv_id", "pos", "code", "bytes")
    n_turns = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return heads.unionByName(tails), plan.select("conv_id", n_turns.alias("n_turns"))


# ---- nodes ----


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, s1..s4, bytes, below) of each turn's prefix."""
    a, b = F.xxhash64("code", "pos"), F.xxhash64("pos", "code", F.lit(1))
    low = F.lit((1 << 32) - 1)
    rows = turns.select(
        "conv_id", "pos", "bytes", F.expr(f"(pos - 1) div {BLOCK}").alias("block"),
        a.bitwiseAND(low).alias("s1"), F.shiftrightunsigned(a, 32).alias("s2"),
        b.bitwiseAND(low).alias("s3"), F.shiftrightunsigned(b, 32).alias("s4"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({s: F.sum(s).over(inside) for s in SUMS})
    blocks = rows.groupBy("conv_id", "block").agg(*[F.max(s).alias(s) for s in SUMS], F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "conv_id", "block", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"c{s}") for s in SUMS],
        F.sum("k").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    return rows.join(carried, ["conv_id", "block"]).select(
        "conv_id", F.col("pos").alias("depth"), "bytes", *[(F.col(s) + F.col(f"c{s}")).alias(s) for s in SUMS],
        (F.col("n_turns") - F.col("pos") + 1).alias("below"),
    )


def _owners(prefixes: DataFrame, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths): the nodes by their smallest member, and the node (its name) of each conversation at each depth."""
    key = ["depth", *SUMS]
    nodes = stored(prefixes.groupBy(*key).agg(
        F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.sum("below").alias("below"),
    ), "trie-nodes")
    names = nodes.select(*key, "node", "n_convs")
    limit = max(10_000, -(-n_rows // MOST_LARGE))
    # member counts sum up to n_rows, so at most MOST_LARGE nodes have more than limit
    hot, cold = names.where(F.col("n_convs") > limit), names.where(F.col("n_convs") <= limit)
    rows = prefixes.select("conv_id", *key, (F.col("below") == 1).alias("last"))
    paths = rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot), key, "left_anti").join(cold, key)
    )
    return nodes, paths.select("conv_id", "depth", "node", "last")


# ---- centroid decomposition ----


def _decompose(parent: list[int], below: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree totals of small components, by centroids; parent is -1 at a component's top."""
    kids: list[list[int]] = [[] for _ in parent]
    for v, p in enumerate(parent):
        if p >= 0:
            kids[p].append(v)
    sums = [[0] * len(v) for v in values]
    gone = [False] * len(parent)
    tops = [v for v, p in enumerate(parent) if p < 0]
    while tops:
        top = tops.pop()
        half, path = below[top] / 2, [top]
        while True:
            heavy = next((x for x in kids[path[-1]] if not gone[x] and below[x] > half), None)
            if heavy is None:
                break
            path.append(heavy)
        centroid = path[-1]
        under, at = [centroid], 0
        while at < len(under):
            under += [x for x in kids[under[at]] if not gone[x]]
            at += 1
        for value, total in zip(values, sums):
            t = sum(value[v] for v in under)
            for v in path:
                total[v] += t
        cut = below[centroid]
        for v in path[:-1]:
            below[v] -= cut
        gone[centroid] = True
        tops += [x for x in kids[centroid] if not gone[x]]
        if centroid != top:
            tops.append(top)
    return sums


def _finish(data: pa.Table, values: list[str]) -> pa.Table:
    """One bucket of whole components: the totals of its nodes."""
    column = {n: data.column(n).to_pylist() for n in data.column_names}
    tops = list(zip(column["top_conv"], column["top_depth"]))
    place = {(*top, c, d): i for i, (top, c, d) in enumerate(zip(tops, column["conv_id"], column["depth"]))}
    parent = [place.get((*top, p, d - 1), -1) for top, p, d in zip(tops, column["parent"], column["depth"])]
    sums = _decompose(parent, column["below"], [column[v] for v in values])
    kept = [data.column("conv_id"), data.column("depth")]
    added = [pa.array([a + b for a, b in zip(column[f"sum_{v}"], s)], type=pa.int64()) for v, s in zip(values, sums)]
    return pa.Table.from_arrays([*kept, *added], names=[*NAMED, *[f"sum_{v}" for v in values]])


def subtree_totals(nodes: DataFrame, paths: DataFrame, values: list[str], piece: int = PIECE) -> DataFrame:
    """(conv_id, depth, sum_<value>...): each node's totals over its subtree, itself included.

    nodes: conv_id, depth, parent (conv_id of the node above; null at a top),
    below, and the value columns.  paths: conv_id, depth, node, up (the name of
    the node above it), for each conversation that names a node.
    """
    state = nodes.select(
        *NAMED, "parent", "below", *values, *[F.lit(0).cast("long").alias(f"sum_{v}") for v in values],
    )
    tops = nodes.where("parent is null")
    weight, trees = tops.agg(F.sum("below"), F.count(F.lit(1))).first()
    if not trees:
        return state.select(*NAMED, *[f"sum_{v}" for v in values])
    piece = max(piece, -(-weight // MOST_LARGE))
    if trees == 1:
        name = tops.select(*NAMED).first()
        state = state.withColumns({"top_conv": F.lit(name[0]).cast("long"), "top_depth": F.lit(name[1]).cast("long")})
    else:  # tops at depth 0 or 1: the path of the node's own conversation leads to it
        least = paths.groupBy("conv_id").agg(F.min_by("node", "depth").alias("top_conv"), F.min("depth").alias("top_depth"))
        state = state.join(least, "conv_id")
    state = stored(state, "components")
    done, small = [], []
    while True:
        large = state.groupBy(*TOP).agg(F.max("below").alias("total")).where(F.col("total") > piece)
        if large.isEmpty():
            small.append(state)
            break
        small.append(state.join(F.broadcast(large), TOP, "left_anti"))
        state = state.join(F.broadcast(large), TOP)
        on_path = 2 * F.col("below") > F.col("total")
        centroids = state.where(on_path).groupBy(*TOP).agg(F.min(F.struct("below", *NAMED)).alias("c"))
        centroids = centroids.select(*TOP, F.col("c.below").alias("c_below"), F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"))
        state = state.join(F.broadcast(centroids), TOP).withColumn("stretch", F.expr(f"depth div {BLOCK}"))
        # the ancestor just below the centroid's depth, once for each stretch of a chain
        asked = state.where("depth > c_depth").select("conv_id", "c_conv", "c_depth", "stretch").distinct()
        step = paths.select("conv_id", (F.col("depth") - 1).alias("c_depth"), "node", F.col("up").alias("c_conv"))
        asked = asked.join(step, ["conv_id", "c_depth", "c_conv"]).withColumnRenamed("node", "child")
        state = state.join(asked, ["conv_id", "c_conv", "c_depth", "stretch"], "left")
        under = (F.col("depth") > F.col("c_depth")) & F.col("child").isNotNull()
        is_centroid = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
        state = stored(state.withColumns({"under": under, "centroid": is_centroid, "on_path": on_path}).drop("stretch"), "split")
        hung = state.where("under or centroid").groupBy(*TOP).agg(*[F.sum(v).alias(f"t_{v}") for v in values])
        state = state.join(F.broadcast(hung), TOP).withColumns(
            {f"sum_{v}": F.col(f"sum_{v}") + F.when(F.col("on_path"), F.col(f"t_{v}")).otherwise(0) for v in values}
        )
        done.append(state.where("centroid").select(*NAMED, *[f"sum_{v}" for v in values]))
        state = stored(state.where("not centroid").select(
            *NAMED, "parent", *values, *[f"sum_{v}" for v in values],
            F.when(F.col("on_path"), F.col("below") - F.col("c_below")).otherwise(F.col("below")).alias("below"),
            F.when(F.col("under"), F.col("child")).otherwise(F.col("top_conv")).alias("top_conv"),
            F.when(F.col("under"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        ), "components")
    columns = [*NAMED, *TOP, "parent", "below", *values, *[f"sum_{v}" for v in values]]
    rest = reduce(DataFrame.unionByName, [s.select(*columns) for s in small])
    buckets = max(1, -(-weight // piece))
    dealt = rest.withColumn("bucket", F.pmod(F.xxhash64(*TOP), F.lit(buckets)))
    kinds = ", ".join(["conv_id long", "depth long", *[f"sum_{v} long" for v in values]])
    finished = dealt.groupBy("bucket").applyInArrow(lambda t: _finish(t.drop(["bucket"]), values), kinds)
    return reduce(DataFrame.unionByName, [finished, *done])


# ---- the trie ----


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the strings of each node, which arrive in order; a hash is one pass, so only its state is held."""
    kinds, name, hashing = (pa.int64(), pa.int64(), pa.string()), None, None

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=[*NAMED, "ends_sha256"])

    for batch in batches:
        rows = []
        for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in (*NAMED, "ids"))):
            if (conv, depth) != name:
                if name:
                    rows.append((*name, hashing.hexdigest()))
                name, hashing = (conv, depth), hashlib.sha256(ids.encode())
            else:
                hashing.update(b"," + ids.encode())
        if rows:
            yield out(rows)
    if name:
        yield out([(*name, hashing.hexdigest())])


def _ends(ending: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of (conv_id, depth, member): members in order, in strings of bounded length."""
    chunks = ending.groupBy(*NAMED, F.floor(F.col("member") / ENDS).alias("chunk")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("member")), lambda m: m.cast("string"))).alias("ids")
    )
    ordered = chunks.repartition(*NAMED).sortWithinPartitions(*NAMED, "chunk")
    return ordered.select(*NAMED, "ids").mapInArrow(_hash_ends, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, pos (from 1), code, bytes; conversations: conv_id, n_turns (those without turns, too).
    """
    prefixes = stored(_prefixes(turns), "prefixes")
    whole = conversations.agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n"), F.sum("n_turns").alias("turns")).first()
    least, n, total = whole["least"], whole["n"], whole["turns"] or 0
    nodes, paths = _owners(prefixes, total)
    paths = stored(paths, "paths")
    above = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("up"))
    # (conversation, depth) is unique, so this join has no frequent key
    lineage = paths.join(above, NAMED, "left").withColumn("up", F.when(F.col("depth") == 1, F.lit(least)).otherwise(F.col("up")))
    lineage = stored(lineage, "lineage")
    parents = lineage.where("conv_id = node").select(*NAMED, F.col("up").alias("parent"))
    named = nodes.select(F.col("node").alias("conv_id"), "depth", "n_convs", "bytes", "below").join(parents, NAMED)
    root = conversations.sparkSession.createDataFrame(
        [(least, 0, n, 0, n + total, None)] if n else [],
        "conv_id long, depth long, n_convs long, bytes int, below long, parent long",
    )
    named = named.unionByName(root)
    kids = named.where("parent is not null").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    forest = stored(named.join(kids, NAMED, "left").select(
        *NAMED, "parent", "n_convs", "below", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    ), "forest")
    totals = subtree_totals(forest, lineage, ["leaf", "saved"], piece)
    ending = lineage.where("last").select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    turnless = conversations.where("n_turns = 0").select(
        F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member")
    )
    ends = _ends(ending.unionByName(turnless))
    return forest.join(totals, NAMED).join(ends, NAMED, "left").select(
        *NAMED, F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("sum_leaf").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*with_borrowed_heads(number_turns(table(spark, sf_dir, "conversations"))))


#: Subtrees are all pairs of a node and an ancestor here; prefixes are hashed as strings.
ORACLE_SQL = f"""
WITH crc AS ({CRC_TABLE}),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id),
named AS (SELECT conv_id, n, CAST(conv_id AS VARCHAR) AS name FROM convs),
hashed AS (SELECT conv_id, n, {crc32_sql("name")} % 9 AS h FROM named, crc),
planned AS (
  SELECT a.conv_id, a.h, a.conv_id - a.conv_id % 5 AS base, least(a.h, coalesce(b.n, 0)) AS taken
  FROM hashed a LEFT JOIN convs b ON b.conv_id = a.conv_id - a.conv_id % 5
),
rebuilt AS (
  SELECT p.conv_id, o.pos, o.role, o.text FROM planned p JOIN own o ON o.conv_id = p.base AND o.pos <= p.taken
  UNION ALL
  SELECT p.conv_id, o.pos - p.h + p.taken, o.role, o.text FROM planned p JOIN own o ON o.conv_id = p.conv_id AND o.pos > p.h
),
coded AS (SELECT *, md5(strlen(role) || ':' || role || text) AS code, max(pos) OVER (PARTITION BY conv_id) AS n FROM rebuilt),
prefix AS (
  SELECT a.conv_id, a.pos AS depth, a.n, strlen(any_value(a.text)) AS bytes, md5(string_agg(b.code, ',' ORDER BY b.pos)) AS k
  FROM coded a JOIN coded b ON a.conv_id = b.conv_id AND b.pos <= a.pos GROUP BY ALL
  UNION ALL
  SELECT c.conv_id, 0, coalesce((SELECT max(n) FROM coded x WHERE x.conv_id = c.conv_id), 0), 0, '' FROM convs c
),
path AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, k) AS node FROM prefix),
node AS (
  SELECT node, depth, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM path GROUP BY node, depth
),
parent AS (
  SELECT DISTINCT a.node, a.depth, b.node AS parent FROM path a JOIN path b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1
),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS k FROM parent GROUP BY ALL),
full_node AS (
  SELECT n.*, p.parent, coalesce(k.k, 0) AS n_children FROM node n
  LEFT JOIN parent p ON n.node = p.node AND n.depth = p.depth LEFT JOIN kids k ON n.node = k.parent AND n.depth = k.depth
),
above AS (
  SELECT DISTINCT a.node, a.depth, b.node AS top, b.depth AS top_depth FROM path a JOIN path b ON a.conv_id = b.conv_id AND b.depth <= a.depth
),
totals AS (
  SELECT top, top_depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM above a JOIN full_node n ON a.node = n.node AND a.depth = n.depth GROUP BY ALL
)
SELECT n.node AS conv_id, n.depth, n.parent AS parent_conv_id, n.n_convs, n.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_node n JOIN totals t ON n.node = t.top AND n.depth = t.top_depth
"""
