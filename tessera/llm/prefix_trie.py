"""Prefix trie of conversations, totals of subtrees by depth-band rollup.

Conversations are rebuilt (a shared head of turns, then their own), and each distinct sequence of
first turns is a node.  A node is named by two 64-bit sums: of hashes of its turns with their places,
put together by exclusive or, so that they can be summed along a conversation in pieces.  Depths are
cut into bands of HEIGHT.  Inside a band a node explodes only to its ancestors of that band, found on
the path of one member.  Sums of whole bands go to their roots, which are the nodes of a trie that is
HEIGHT times as flat; that one is cut into bands again, until a single band is left.  On the way back
completed totals of roots hang below the nodes above them, and each band is exploded once more.  So a
node makes at most HEIGHT rows a level, and there are as many levels as digits of the depth in base HEIGHT.

Turns are dealt out by ranges of conversation and order; counts and sums of each range go before those
of the next ones, so a conversation of any length is spread over tasks.  The members that end in a node
are hashed as a stream, never held together.

Turns of a null conversation are left out.  A null role or text is an empty one, turns of equal number
are ordered by role, then text; rows repeated in full are turns of their own.  An empty table gives no
rows: there is no conversation whose root it would be.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, saved, shuffles, table

#: Depths of a band: rows that a node makes at most.
HEIGHT = 16
#: A conversation takes its first turns from the one whose id is the next multiple of this below.
GROUP = 20
#: Bound of the parents that are sent to every task: those with more than one in so many of all nodes as children.
HOT = 10_000
WORDS = r"[^\x20\x09-\x0D]+"
NODE = ["d", "k1", "k2"]


def dealt_turns(conversations: DataFrame) -> DataFrame:
    """(conv, at, part, f1, f2, words) of each turn: at is its place in the order of all, part its range."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), "turn", text("role"), text("text"))
    rows = rows.repartitionByRange(shuffles(rows.sparkSession), *order).sortWithinPartitions(*order)
    first, second = F.xxhash64("role", "text"), F.xxhash64(F.sha1(F.col("text").cast("binary")), "role")
    rows = rows.select("conv", F.monotonically_increasing_id().alias("at"), first.alias("f1"), second.alias("f2"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"))
    return saved(rows.withColumn("part", F.shiftright("at", 33).cast("int")), "turns")


def _before(sums: DataFrame, keys: list[str], value: Column) -> Column:
    """Of the ranges of a conversation before this one."""
    return F.coalesce(value.over(Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def _keyed(d: Column, turn: Column | None = None) -> list[Column]:
    of = F.col if turn is None else lambda name: turn[name]
    return [F.xxhash64(d, of("f1")), F.xxhash64(of("f2"), d)]


def paths(turns: DataFrame) -> DataFrame:
    """(c, d, k1, k2, g1, g2, words, len): for each rebuilt conversation and each d up to its length, the node
    of its first d turns, what the last of them added to it, and that turn's words."""
    in_part = Window.partitionBy("conv", "part").orderBy("at")
    places = turns.groupBy("conv", "part").agg(F.count("*").alias("n"))
    places = saved(places.select("conv", "part", "n", _before(places, ["conv"], F.sum("n")).alias("before")), "places")
    # the first turns of those that others begin with
    bases = turns.where(F.col("conv") % GROUP == 0).withColumn("r", F.row_number().over(in_part)).where("r <= 3").join(places.where("before < 3").drop("n"), ["conv", "part"])
    bases = bases.withColumn("i", F.col("before") + F.col("r") - 1).where("i < 3")
    bases = bases.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("i", "f1", "f2", "words"))).alias("head"))
    convs = places.groupBy("conv").agg(F.sum("n").alias("n")).withColumn("base", F.col("conv") - F.col("conv") % GROUP)
    convs = convs.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")).join(bases, "base", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<i:bigint,f1:bigint,f2:bigint,words:bigint>>")), F.lit(1), F.col("h")))
    shared = F.size("head").cast("long")
    convs = convs.select("conv", "h", shared.alias("shared"), (shared + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"),
                         F.transform("head", lambda x, i: F.struct((i + 1).cast("long").alias("d"), *(g.alias(f"g{j}") for j, g in enumerate(_keyed((i + 1).cast("long"), x), 1)), x["words"].alias("words"))).alias("head"))
    whole = lambda g: F.aggregate("head", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x[g]))
    convs = saved(convs.withColumns({"s1": whole("g1"), "s2": whole("g2")}), "convs")
    zero = F.lit(0).cast("long")
    root = F.struct(zero.alias("d"), zero.alias("g1"), zero.alias("g2"), zero.alias("words"))
    upto = lambda g: F.aggregate(F.filter("head", lambda x: x["d"] <= F.col("t.d")), zero, lambda a, x: a.bitwiseXOR(x[g]))
    heads = convs.select("*", F.explode(F.concat(F.array(root), "head")).alias("t"))
    heads = heads.select(F.col("conv").alias("c"), "t.d", upto("g1").alias("k1"), upto("g2").alias("k2"), "t.g1", "t.g2", "t.words", "len")
    # its own turns after that
    known = places.drop("n").join(convs.drop("head"), "conv")
    own = turns.withColumn("r", F.row_number().over(in_part)).join(known, ["conv", "part"]).withColumn("i", F.col("before") + F.col("r") - 1).where("i >= h")
    own = own.withColumn("d", F.col("i") - F.col("h") + F.col("shared") + 1)
    g1, g2 = _keyed(F.col("d"))
    own = own.withColumns({"g1": g1, "g2": g2})
    up = in_part.rowsBetween(Window.unboundedPreceding, 0)
    own = saved(own.select("conv", "part", "d", "g1", "g2", F.bit_xor("g1").over(up).alias("x1"), F.bit_xor("g2").over(up).alias("x2"), "words", "len", "s1", "s2"), "own")
    sums = own.groupBy("conv", "part").agg(F.bit_xor("g1").alias("p1"), F.bit_xor("g2").alias("p2"))
    sums = sums.select("conv", "part", *(_before(sums, ["conv"], F.bit_xor(p)).alias(p) for p in ("p1", "p2")))
    key = lambda j: F.col(f"s{j}").bitwiseXOR(F.col(f"p{j}")).bitwiseXOR(F.col(f"x{j}")).alias(f"k{j}")
    tails = own.join(sums, ["conv", "part"]).select(F.col("conv").alias("c"), "d", key(1), key(2), "g1", "g2", "words", "len")
    out = saved(heads.unionByName(tails), "paths")
    discard(places, convs, own)
    return out


def _exploded(rows: DataFrame, path: DataFrame, unit: int, height: int) -> DataFrame:
    """Totals (d, k1, k2, conv, leaves, tokens) of nodes at depths that unit divides, from rows (conv, d, leaves, tokens):
    each counts for its node and the node's ancestors in its band."""
    band = lambda d: F.floor(F.col(d) / (unit * height)).alias("band")
    near = path.where(F.col("d") % unit == 0).select(F.col("c").alias("conv"), band("d"), F.col("d").alias("up"), "k1", "k2")
    met = rows.withColumn("band", band("d")).join(near, ["conv", "band"]).where("up <= d")
    return met.groupBy(F.col("up").alias("d"), "k1", "k2").agg(F.min("conv").alias("conv"), F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens"))


def rollup(rows: DataFrame, path: DataFrame, deepest: int, height: int = HEIGHT) -> DataFrame:
    """Totals of subtrees (d, k1, k2, conv, leaves, tokens).  rows (conv, d, leaves, tokens): what each node has of its own;
    path (c, d, k1, k2): the nodes on the way to each conversation's end."""
    levels, unit = [], 1
    while deepest >= unit * height:
        levels.append(rows)
        root = (F.floor(F.col("d") / (unit * height)) * (unit * height)).alias("d")
        roots = rows.select("conv", root, "leaves", "tokens").join(path.select(F.col("c").alias("conv"), *NODE), ["conv", "d"])
        rows = saved(roots.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens")).select("conv", "d", "leaves", "tokens"), "bands")
        unit *= height
    tables, totals = [rows] if levels else [], saved(_exploded(rows, path, unit, height), "totals")
    for level in reversed(levels):
        unit //= height
        hanging = totals.where("d > 0").select("conv", (F.col("d") - unit).alias("d"), "leaves", "tokens")
        tables.append(totals)
        totals = saved(_exploded(level.unionByName(hanging), path, unit, height), "totals")
    discard(*tables, *levels[1:])
    return totals


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal nodes in sorted rows (k1, k2, c), their conversations joined by commas."""
    for batch in batches:
        k1, k2, c = (batch.column(x).to_numpy() for x in ("k1", "k2", "c"))
        if not len(c):
            continue
        cuts = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))))
        ends = np.append(cuts[1:], len(c))
        runs = [",".join(map(str, c[a:b].tolist())) for a, b in zip(cuts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(c[cuts]), pa.array(runs)], names=["k1", "k2", "c", "run"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's runs, which come in order."""
    now, digest = None, None
    for batch in batches:
        k1, k2, out = [], [], []
        for a, b, run in zip(*(batch.column(x).to_pylist() for x in ("k1", "k2", "run")), strict=True):
            if (a, b) == now:
                digest.update(b",")
            else:
                if now is not None:
                    k1.append(now[0]), k2.append(now[1]), out.append(digest.hexdigest())
                now, digest = (a, b), hashlib.sha256()
            digest.update(run.encode())
        yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(out, pa.string())], names=["k1", "k2", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([digest.hexdigest()])], names=["k1", "k2", "ends_sha256"])


def ends(path: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes in which conversations end."""
    order, parts = ["k1", "k2", "c"], shuffles(path.sparkSession)
    rows = path.where("d = len").select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    runs = saved(rows.mapInArrow(_joined, "k1 long, k2 long, c long, run string"), "runs")
    return runs.repartition(parts, "k1", "k2").sortWithinPartitions(*order).mapInArrow(_hashed, "k1 long, k2 long, ends_sha256 string")


def _parents(nodes: DataFrame) -> DataFrame:
    """(d, k1, k2, parent_conv_id).  Parents of more than one in HOT of all nodes, fewer than HOT by that, are sent
    to every task; the others have few children each and meet them by a shuffle."""
    up = nodes.where("n_children > 0").select(F.col("d").alias("pd"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv").alias("parent_conv_id"), "n_children")
    least = nodes.count() // HOT
    hot, cold = F.broadcast(up.where(F.col("n_children") > least).drop("n_children")), up.where(F.col("n_children") <= least).drop("n_children")
    below = nodes.where("d > 0").select(*NODE, (F.col("d") - 1).alias("pd"), "u1", "u2")
    keys = ["pd", "u1", "u2"]
    return below.join(hot, keys).unionByName(below.join(hot, keys, "left_anti").join(cold, keys)).select(*NODE, "parent_conv_id")


def prefix_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """A row for each node (see op13_prefix_trie), and its name k1, k2.  conversations: conv_id, turn, role, text."""
    turns = dealt_turns(conversations)
    path = paths(turns)
    of = path.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("c").alias("conv"), F.min("words").alias("words"), *(F.min(F.col(f"k{j}").bitwiseXOR(F.col(f"g{j}"))).alias(f"u{j}") for j in (1, 2)))
    of = saved(of, "nodes")
    children = of.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = saved(of.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    rows = nodes.select("conv", "d", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("tokens"))
    deepest = path.agg(F.max("d")).first()[0] or 0
    totals = rollup(rows, path, deepest, height).drop("conv")
    out = nodes.join(totals, NODE).join(_parents(nodes), NODE, "left").join(ends(path), ["k1", "k2"], "left")
    out = saved(out.select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "k1", "k2",
    ), "trie")
    discard(turns, path, of, nodes)
    return out


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node: its least member, depth, parent's least member, members, children, leaves below, tokens saved below, who ends in it."""
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("k1", "k2")


SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(list_transform(range(1, length(s) + 1), lambda j: CAST(ascii(s[j]) AS BIGINT)),
  lambda a, b: list_reduce(range(8), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), CAST(4294967295 AS BIGINT))) % 4 AS h FROM u),
r AS (SELECT c.conv_id, 0 AS k, i, role, text FROM c JOIN t ON t.conv_id = base AND i < h UNION ALL SELECT c.conv_id, 1, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND i >= h),
p AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY k, i) AS seq FROM r GROUP BY conv_id),
a AS (SELECT c.conv_id, coalesce(seq, []) AS seq FROM c LEFT JOIN p USING (conv_id)),
m AS (SELECT conv_id, len(seq) AS n, unnest(range(0, len(seq) + 1)) AS d, seq FROM a),
n AS (SELECT d, seq[1:d] AS node, min(conv_id) AS conv, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends FROM m GROUP BY 1, 2),
k AS (SELECT d - 1 AS d, node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * CASE WHEN n.d = 0 THEN 0 ELSE len(regexp_extract_all(n.node[n.d].t, '[^\x20\x09-\x0D]+')) END AS own FROM n LEFT JOIN k ON n.d = k.d AND n.node = k.node),
e AS (SELECT unnest(range(0, d + 1)) AS e, node, n_children, own FROM v),
b AS (SELECT e AS d, node[1:e] AS node, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens FROM e GROUP BY 1, 2)
SELECT v.conv AS conv_id, v.d AS depth, q.conv AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves, b.saved_tokens, v.ends AS ends_sha256
FROM v JOIN b ON v.d = b.d AND v.node = b.node LEFT JOIN n q ON v.d > 0 AND q.d = v.d - 1 AND q.node = v.node[1:v.d - 1]
"""
