"""Louvain and Leiden communities, and their fixed-depth refinement, as rounds of DataFrame jobs.

Parents that are too large for a task are worked on over packed rows (adjacency).  What follows is about those
with too many vertices for that, which go by joins.

All parents of a level are worked on at once: every table carries the parent, and nothing of a graph
is ever gathered in one task.  In a round, the vertices that look (at first all, then those with a
neighbour that moved or that did not get their turn, and all once more before the end) find the communities near them,
which is the work that grows with the edges.  They are then moved one after the other by one task for each
parent, which knows their weights to communities and the edges among them, while all others stay: each move's rise is exact, so
modularity only rises.  If they have more of either than TOGETHER, those come first that want to move most.
A large graph without communities starts in groups of vertices by hash, each a task: moves inside of a group need
nothing of the others, as communities don't reach across; then the communities of all groups are joined.

So a phase of rounds ends: modularity rises each time and stays below one.  It rarely
needs more than a few dozen; MOST_ROUNDS bounds them, and a phase that meets it goes on from what it has.
When no vertex is left that would move, communities become vertices, until that changes nothing.
Leiden starts again from what it found, until that raises modularity no more.
Moves depend on labels and hashes only, so results are the same on any cluster, without a seed.

The edges of a phase are kept in buckets of one end: a round joins them with the state of vertices,
which is small, without shuffling them for it.  A parent with at most IN_TASK edges and vertices, given or left by
contractions, is finished in one task, by the same moves one vertex at a time; that is where the many
small parents of deeper levels are worked on, all in one job.  There, sweeps over all vertices at once find those that gain as soon
as communities are few, so a move costs no step for each neighbour that stays.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import adjacency
from tessera.operators.adjacency import DENSE, LEAST_GAIN, settled, together
from tessera.operators.graph import induced, modularity, sizes
from tessera.shared import cut, numbered, passing, small

#: Rounds of a phase at most.
MOST_ROUNDS = 500
#: Edges and vertices of a parent that one task may hold (some 100 bytes each), as many as links of TOGETHER.
IN_TASK = 2_000_000
#: Weights to communities, and links of vertices to each other, that one task may hold while it moves vertices of a large parent.
TOGETHER = 4_000_000


def _halves(edges: DataFrame) -> DataFrame:
    """Both directions of each edge; loops once, with their weight doubled in `strength` sums."""
    turned = edges.where("a <> b").select("parent", F.col("b").alias("a"), F.col("a").alias("b"), "w")
    return edges.select("parent", "a", "b", "w").unionByName(turned)


def _strengths(both: DataFrame) -> DataFrame:
    """(parent, v, k, m2): summed weights of each vertex that has an edge, and of all of its parent."""
    k = both.groupBy("parent", F.col("a").alias("v")).agg(F.sum(F.when(F.col("a") == F.col("b"), 2 * F.col("w")).otherwise(F.col("w"))).alias("k"))
    return k.join(k.groupBy("parent").agg(F.sum("k").alias("m2")), "parent").select("parent", "v", "k", "m2")


def _quality(links: DataFrame, state: DataFrame, resolution: float) -> DataFrame:
    """(parent, quality, m2): modularity but for a constant factor and the loops, which no move changes."""
    a, b = state.select("parent", F.col("v").alias("a"), "c"), state.select("parent", F.col("v").alias("b"), F.col("c").alias("d"))
    inside = links.join(a, ["parent", "a"]).join(b, ["parent", "b"]).where("c = d").groupBy("parent").agg((F.sum("w") / 2).alias("inside"))
    total = state.groupBy("parent", "c", "m2").agg(F.sum("k").alias("k")).groupBy("parent", "m2").agg(F.sum(F.col("k") * F.col("k")).alias("squares"))
    return total.join(inside, "parent", "left").select("parent", (F.coalesce("inside", F.lit(0.0)) - resolution * F.col("squares") / (2 * F.col("m2"))).alias("quality"), "m2")


def choices(links: DataFrame, state: DataFrame, resolution: float, within: bool = False) -> DataFrame:
    """(parent, v, c, bound, k, m2, tot, near, links, rise) of each vertex that looks and is linked to another community: near
    (to, tot_to, w) are the communities it is linked to, links the number of its links, rise by how much its best move
    raises the quality (below 0: lowers).
    links (parent, a, b, w): both directions, no loops; state (parent, v, c, bound, k, m2, look)."""
    full = state.join(state.groupBy("parent", "c").agg(F.sum("k").alias("tot")), ["parent", "c"])
    to = full.select("parent", F.col("v").alias("b"), F.col("c").alias("to"), F.col("tot").alias("tot_to"), F.col("bound").alias("bound_b"))
    own = full.where("look").select("parent", F.col("v").alias("a"), "c", "bound", "k", "m2", "tot")
    near = links.join(to, ["parent", "b"]).join(own, ["parent", "a"])
    if within:
        near = near.where("bound = bound_b")
    own = ["parent", "v", "c", "bound", "k", "m2", "tot"]
    near = near.withColumnRenamed("a", "v").groupBy(*own, "to", "tot_to").agg(F.sum("w").alias("w"), F.count("*").alias("links"))
    stays, pull = F.col("to") == F.col("c"), resolution * F.col("k") / F.col("m2")
    gain = F.round(F.col("w") - pull * (F.col("tot_to") - F.when(stays, F.col("k")).otherwise(0.0)), 9)
    best = near.withColumn("gain", gain).groupBy(*own).agg(
        F.max(F.when(stays, F.col("gain"))).alias("stay"), F.max(F.when(~stays, F.col("gain"))).alias("go"), F.collect_list(F.struct("to", "tot_to", "w")).alias("near"), F.sum("links").alias("links"),
    )
    stay = F.coalesce("stay", F.round(-pull * (F.col("tot") - F.col("k")), 9))
    return best.where("go is not null").select(*own, "near", "links", (F.col("go") - stay).alias("rise"))


def _wants() -> Column:
    return F.col("rise") > LEAST_GAIN * F.greatest("m2", F.lit(1.0))


def _turns(found: DataFrame, turn: int) -> DataFrame:
    """The vertices of each parent that may move in this round: all that look, or about so many as a task can hold, those
    whose best moves raise most, or lower least.  If these have more links than the average, a share of them is taken by hash, with the best."""
    held = found.groupBy("parent").agg(F.sum(F.size("near")).alias("weights"), F.sum("links").alias("all_links"), F.max(F.struct("rise", "v"))["v"].alias("top"), F.percentile_approx("rise", F.array(*(F.lit(1 - i / 20) for i in range(1, 20))), F.lit(1000)).alias("ranks"))
    share = F.least(TOGETHER / F.col("weights"), F.sqrt(TOGETHER / F.col("all_links")), F.lit(1.0))
    rank = F.when(share < 1, F.get("ranks", F.least(F.greatest((20 * share).cast("int") - 1, F.lit(0)), F.lit(18))))
    some = found.join(held.select("parent", "top", "all_links", rank.alias("rank")), "parent").where("rank is null or rise >= rank")
    again = some.groupBy("parent").agg(F.sum(F.size("near")).alias("weights"), F.sum("links").alias("some_links"))
    share = F.least(TOGETHER / F.col("weights"), F.sqrt(TOGETHER * F.col("all_links")) / F.col("some_links"))
    chosen = F.pmod(F.xxhash64("v", F.lit(turn)), F.lit(1_000_000)) < 1_100_000 * share
    return some.join(again, "parent").where(chosen | (F.col("v") == F.col("top"))).select(*found.columns)


def _numbers(values: pa.ChunkedArray | pa.Array, names: pa.Array) -> np.ndarray:
    """The place of each value among the names."""
    return np.asarray(pc.fill_null(pc.index_in(values, value_set=names), -1)).astype(np.int64)


def _together(links: DataFrame, wants: DataFrame, resolution: float) -> DataFrame:
    """(parent, v, target): gainful moves of these vertices one after the other, until there are none; all others stay."""
    def solve(wants: pa.Table, edges: pa.Table) -> pa.Table:
        wants = wants.sort_by("v")
        n, names, near = len(wants), wants["v"].combine_chunks(), wants["to"].combine_chunks()
        sizes, given = pc.list_value_length(near).to_numpy(), lambda x: wants[x].combine_chunks().flatten().to_numpy()
        both = pa.concat_arrays([wants["c"].combine_chunks(), near.flatten()])
        labels = both.unique()
        labels = labels.take(pc.sort_indices(labels))
        codes = _numbers(both, labels)
        c, tot = codes[:n].copy(), np.zeros(len(labels))
        tot[codes] = np.concatenate((wants["tot"].to_numpy(), given("tot_to")))
        a, b = (_numbers(edges[x], names) for x in ("a", "b"))
        x, y, w = np.concatenate((a, b)), np.concatenate((b, a)), np.tile(edges["w"].to_numpy().astype(np.float64), 2)
        order = np.lexsort((y, x))
        x, y, w = x[order], y[order], w[order]
        k, total, start = wants["k"].to_numpy(), wants["m2"][0].as_py(), c.copy()
        c = together(c, tot, k, np.repeat(np.arange(n), sizes), codes[n:], given("w"), x, y, w, total, resolution)
        moved = pa.array(np.flatnonzero(c != start))
        return pa.table({"parent": wants["parent"].take(moved), "v": names.take(moved), "target": labels.take(pa.array(c).take(moved))})

    kind = dict(wants.dtypes)
    side = lambda x: wants.select("parent", F.col("v").alias(x), F.coalesce("bound", F.lit("")).alias(f"bound_{x}"))
    among = links.where("a < b").join(side("a"), ["parent", "a"]).join(side("b"), ["parent", "b"]).where("bound_a = bound_b").select("parent", "a", "b", "w")
    rows = wants.select("parent", "v", "c", "k", "m2", "tot", F.col("near.to").alias("to"), F.col("near.tot_to").alias("tot_to"), F.col("near.w").alias("w"))
    return rows.groupBy("parent").cogroup(among.groupBy("parent")).applyInArrow(solve, f"parent {kind['parent']}, v {kind['v']}, target {kind['c']}")


def _in_groups(links: DataFrame, state: DataFrame, groups: int, resolution: float) -> DataFrame:
    """(parent, v, c) from single vertices, by moves and contractions inside of groups: by hash, and by bound."""
    def solve(nodes: pa.Table, edges: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("v")
        names, n = nodes["v"].combine_chunks(), len(nodes)
        a, b = (_numbers(edges[x], names) for x in ("a", "b"))
        order = np.lexsort((b, a))
        graph = _Local(a[order], b[order], edges["w"].to_numpy().astype(np.float64)[order], n, nodes["k"].to_numpy(), nodes["m2"][0].as_py())
        return pa.table({"parent": nodes["parent"], "v": names, "c": names.take(pa.array(graph.solved(np.arange(n), resolution, False)))})

    kind = dict(state.dtypes)
    nodes = state.where("m2 is not null").select("parent", "v", "k", "m2", F.concat_ws("/", F.pmod(F.xxhash64("v"), F.lit(groups)), F.coalesce("bound", F.lit(""))).alias("g"))
    side = lambda x: nodes.select("parent", F.col("v").alias(x), F.col("g").alias(f"g_{x}"))
    among = links.where("a < b").join(side("a"), ["parent", "a"]).join(side("b"), ["parent", "b"]).where("g_a = g_b").select("parent", F.col("g_a").alias("g"), "a", "b", "w")
    return nodes.groupBy("parent", "g").cogroup(among.groupBy("parent", "g")).applyInArrow(solve, f"parent {kind['parent']}, v {kind['v']}, c {kind['v']}")


def _started(links: DataFrame, state: DataFrame, resolution: float) -> DataFrame:
    """The state, with communities found in groups of vertices instead of single vertices; those of all groups
    are joined if a task can hold what is between them."""
    parts = math.ceil(math.sqrt(links.count() / IN_TASK))
    found = cut(_in_groups(links, state, parts, resolution))
    own = cut(state.drop("c").join(found, ["parent", "v"]))
    side = lambda x, y: found.select("parent", F.col("v").alias(x), F.col("c").alias(y))
    between = links.join(side("a", "ca"), ["parent", "a"]).join(side("b", "cb"), ["parent", "b"]).where("ca <> cb")
    between = cut(between.groupBy("parent", F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("w").alias("w")))
    if between.count() <= IN_TASK:
        nodes = own.groupBy("parent", F.col("c").alias("v"), "bound", "m2").agg(F.sum("k").alias("k"))
        joined = _in_groups(between, nodes, 1, resolution).select("parent", F.col("v").alias("c"), F.col("c").alias("whole"))
        found = found.join(joined, ["parent", "c"]).select("parent", "v", F.col("whole").alias("c"))
    rest = state.withColumnRenamed("c", "alone").join(found, ["parent", "v"], "left")
    return rest.select("parent", "v", F.coalesce("c", "alone").alias("c"), "bound", "k", "m2", "look")


def _move(edges: DataFrame, state: DataFrame, resolution: float, within: bool, trace: list | None = None) -> DataFrame:
    """Rounds of local moves.  edges (parent, a, b, w), loops allowed; state (parent, v, c, bound):
    vertex, community, and a community that its own must stay inside (within) or null."""
    spark = edges.sparkSession
    with passing(spark) as keep:
        both = cut(_halves(edges))
        links = cut(both.where("a <> b"), ["parent", "a"])
        own = state.join(_strengths(both), ["parent", "v"], "left")
        state = cut(own.select("parent", "v", "c", "bound", F.coalesce("k", F.lit(0.0)).alias("k"), "m2", F.col("k").isNotNull().alias("look")))
        if links.count() > IN_TASK and state.where("v <> c").isEmpty():
            state = cut(_started(links, state, resolution))
        everyone = True
        for turn in range(MOST_ROUNDS):
            with passing(spark) as keep_state:
                found = cut(choices(links, state, resolution, within))
                wants = found.where(_wants())
                if wants.isEmpty():
                    if everyone:
                        break
                    state, everyone = keep_state(cut(state.withColumn("look", F.col("m2").isNotNull()))), True
                    continue
                moves = cut(_together(links, cut(_turns(found, turn)), resolution))
                touched = links.join(moves.select("parent", F.col("v").alias("b")), ["parent", "b"]).select("parent", F.col("a").alias("v"))
                waiting = wants.select("parent", "v").join(moves, ["parent", "v"], "left_anti")
                touched = touched.unionByName(waiting).distinct().withColumn("look", F.lit(True))
                state = state.drop("look").join(moves, ["parent", "v"], "left").join(touched, ["parent", "v"], "left")
                state = keep_state(cut(state.select("parent", "v", F.coalesce("target", "c").alias("c"), "bound", "k", "m2", F.coalesce("look", F.lit(False)).alias("look"))))
                everyone = False
                if trace is not None:
                    trace.append((turn, wants.count(), moves.count()))
        return keep(state.select("parent", "v", "c", "bound"))


def _contract(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between communities; those inside become loops."""
    a, b = small(labels.select("parent", F.col("v").alias("a"), F.col("c").alias("ca")), adjacency.KNOWN), small(labels.select("parent", F.col("v").alias("b"), F.col("c").alias("cb")), adjacency.KNOWN)
    joined = edges.join(a, ["parent", "a"]).join(b, ["parent", "b"])
    return joined.groupBy("parent", F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w"))


class _Local:
    """A graph of one task: both directions of each edge by vertex, strengths of vertices (given, if it is a part of a graph)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int, k: np.ndarray | None = None, total: float | None = None):
        self.edges, self.n, apart = (a, b, w), n, a != b
        x, y, z = np.concatenate((a[apart], b[apart])), np.concatenate((b[apart], a[apart])), np.concatenate((w[apart], w[apart]))
        order = np.lexsort((y, x))
        self.to, self.w, self.at = y[order], z[order], np.searchsorted(x[order], np.arange(n + 1))
        self.k = np.bincount(a, w, n) + np.bincount(b, w, n) if k is None else k
        self.total = self.k.sum() if total is None else total

    def moved(self, c: np.ndarray, resolution: float, bound: np.ndarray | None = None) -> np.ndarray:
        """Communities (numbers below n) after gainful moves of single vertices, until there are none; bound: only to
        communities of the same bound."""
        c, tot, least = c.copy(), np.bincount(c, self.k, self.n), LEAST_GAIN * max(self.total, 1.0)
        ends, weights, at = self.to, self.w, self.at
        vertex = np.repeat(np.arange(self.n), np.diff(at))
        if bound is not None:
            same = bound[vertex] == bound[ends]
            vertex, ends, weights = vertex[same], ends[same], weights[same]
            at = np.searchsorted(vertex, np.arange(self.n + 1))
        positive = len(weights) > 0 and weights.min() > 0
        queue, waits, looks = deque(range(self.n)), np.ones(self.n, bool), 0
        while queue:
            if positive and looks and looks % self.n == 0:  # communities may be few by now
                labels, codes = np.unique(c, return_inverse=True)
                many = len(labels)
                if self.n * many <= DENSE:
                    dense = np.bincount(vertex * many + codes[ends], weights, self.n * many).reshape(self.n, many)
                    return labels[settled(codes, dense, np.bincount(codes, self.k, many), self.k, at, ends, weights, self.total, resolution, least)]
            looks += 1
            v = queue.popleft()
            waits[v] = False
            near, w = ends[at[v] : at[v + 1]], weights[at[v] : at[v + 1]]
            if not len(near):
                continue
            own, pull = c[v], resolution * self.k[v] / self.total
            tot[own] -= self.k[v]
            there, which = np.unique(c[near], return_inverse=True)
            gain = np.round(np.bincount(which, w) - pull * tot[there], 9)
            stay = gain[there == own].sum() if own in there else round(-pull * tot[own], 9)
            best = int(gain.argmax())
            if gain[best] > stay + least:
                c[v] = there[best]
                again = near[(c[near] != c[v]) & ~waits[near]]
                waits[again] = True
                queue.extend(again.tolist())
            tot[c[v]] += self.k[v]
        return c

    def quality(self, c: np.ndarray, resolution: float) -> float:
        a, b, w = self.edges
        return w[c[a] == c[b]].sum() - resolution * (np.bincount(c, self.k, self.n) ** 2).sum() / (2 * max(self.total, 1e-300))

    def contracted(self, fine: np.ndarray, n: int) -> _Local:
        a, b = np.minimum(fine[self.edges[0]], fine[self.edges[1]]), np.maximum(fine[self.edges[0]], fine[self.edges[1]])
        pair, which = np.unique(a * n + b, return_inverse=True)
        return _Local(pair // n, pair % n, np.bincount(which, self.edges[2], len(pair)), n, np.bincount(fine, self.k, n), self.total)

    def solved(self, c: np.ndarray, resolution: float, leiden: bool) -> np.ndarray:
        while True:
            before, graph, member = c, self, np.arange(self.n)
            while True:
                c = graph.moved(c, resolution)
                found = c[member]
                _, some, fine = np.unique(graph.moved(np.arange(graph.n), resolution, c) if leiden else c, return_index=True, return_inverse=True)
                if len(some) == graph.n:
                    break
                c = np.unique(c[some], return_inverse=True)[1]
                graph, member = graph.contracted(fine, len(some)), fine[member]
            _, some, which = np.unique(found, return_index=True, return_inverse=True)
            c = some[which]
            if not leiden or self.quality(c, resolution) <= self.quality(before, resolution) + LEAST_GAIN * max(self.total, 1.0):
                return c


def _in_tasks(edges: DataFrame, state: DataFrame, method: str, resolution: float) -> DataFrame:
    """(parent, v, c) of parents small enough for a task each, from the communities state (parent, v, c)."""
    def solve(edges: pa.Table, state: pa.Table) -> pa.Table:
        state = state.select(["parent", "v", "c"]).sort_by("v")
        if not len(edges):
            return state
        names = state["v"].combine_chunks()
        ends = [_numbers(edges[x], names) for x in ("a", "b")]
        order = np.lexsort(ends)
        graph = _Local(ends[0][order], ends[1][order], edges["w"].to_numpy().astype(np.float64)[order], len(names))
        found = graph.solved(_numbers(state["c"], names), resolution, method == "leiden")
        return pa.table({"parent": state["parent"], "v": names, "c": names.take(pa.array(found))})

    kind = dict(state.dtypes)
    own = state.select("parent", "v", "c").groupBy("parent")
    return edges.select("parent", "a", "b", "w").groupBy("parent").cogroup(own).applyInArrow(solve, f"parent {kind['parent']}, v {kind['v']}, c {kind['c']}")


def _heavy(edges: DataFrame, vertices: DataFrame, most: int) -> DataFrame:
    """Parents with more edges and vertices than a task may hold."""
    return edges.select("parent").unionByName(vertices.select("parent")).groupBy("parent").count().where(F.col("count") > most).select("parent")


def communities(edges: DataFrame, vertices: DataFrame, method: str = "leiden", resolution: float = 1.0, in_task: int = IN_TASK, trace: list | None = None) -> DataFrame:
    """(parent, v, c): c is the least vertex of the community.  edges (parent, a, b, w) without
    loops, vertices (parent, v).  Louvain has no resolution.  Isolated vertices stay alone."""
    spark = edges.sparkSession
    if method == "louvain":
        resolution = 1.0
    with passing(spark) as keep:
        edges = cut(edges.select("parent", "a", "b", "w"))
        start = cut(vertices.select("parent", "v", F.col("v").alias("c")))
        heavy = cut(_heavy(edges, start, in_task))
        out = cut(_in_tasks(edges.join(heavy, "parent", "left_anti"), start.join(heavy, "parent", "left_anti"), method, resolution))
        if heavy.isEmpty():
            return keep(out)
        vast = cut(start.join(heavy, "parent", "left_semi").groupBy("parent").count().where(F.col("count") > adjacency.KNOWN).select("parent"))
        known = small(heavy.join(vast, "parent", "left_anti"))
        if not known.isEmpty():
            vertices = start.join(known, "parent", "left_semi").select("parent", "v")
            out = out.unionByName(adjacency.solved(edges.join(known, "parent", "left_semi"), vertices, method, resolution, in_task, IN_TASK, MOST_ROUNDS, trace))
        if vast.isEmpty():
            return keep(cut(out))
        edges, found = cut(edges.join(vast, "parent", "left_semi")), cut(start.join(vast, "parent", "left_semi"))
        while True:
            with passing(spark) as keep_found:
                before, found = found, keep_found(_hierarchy(edges, found, method, resolution, in_task, trace))
            if method == "louvain" or not _risen(edges, before, found, resolution):
                return keep(cut(out.unionByName(found)))


def moves_left(edges: DataFrame, labels: DataFrame, whole: bool = False, resolution: float = 1.0) -> DataFrame:
    """Gainful moves (parent, v, c, rise) that a partition (parent, v, c) leaves: of single vertices, or (whole) of communities into others.
    Vertices are numbered, so that of each link only numbers are shuffled."""
    if whole:
        edges, labels = cut(_contract(edges, labels)), labels.select("parent", F.col("c").alias("v"), "c").distinct()
    own = cut(numbered(labels.select("parent", "v", "c"), [F.col("parent"), F.col("v")], name="i"))
    own = cut(own.join(own.groupBy("parent", "c").agg(F.min("i").alias("j")), ["parent", "c"]))
    side = lambda x: small(own.select("parent", F.col("v").alias(x), F.col("i").alias(f"i{x}"), F.col("j").alias(f"j{x}")), adjacency.KNOWN)
    met = edges.join(side("a"), ["parent", "a"]).join(side("b"), ["parent", "b"]).select("ia", "ja", "ib", "jb", "w", (F.col("ia") != F.col("ib")).alias("apart"))
    turned = lambda x, y: F.struct(F.col(f"i{x}").alias("i"), F.col(f"j{y}").alias("to"), "w", F.when(F.col("apart"), F.col("w")).alias("apart"))
    near = met.select(F.explode(F.array(turned("a", "b"), turned("b", "a"))).alias("r")).select("r.*")
    near = cut(near.groupBy("i", "to").agg(F.sum("w").alias("all"), F.sum("apart").alias("w")))
    own = own.join(near.groupBy("i").agg(F.sum("all").alias("k")), "i")
    own = cut(own.join(own.groupBy("parent").agg(F.sum("k").alias("m2")), "parent"))
    tot = cut(own.groupBy(F.col("j").alias("to")).agg(F.sum("k").alias("tot")))
    stays, pull = F.col("to") == F.col("j"), resolution * F.col("k") / F.col("m2")
    near = near.where("w is not null").join(small(own.select("i", "j", "k", "m2"), adjacency.KNOWN), "i").join(small(tot, adjacency.KNOWN), "to")
    gain = F.round(F.col("w") - pull * (F.col("tot") - F.when(stays, F.col("k")).otherwise(0.0)), 9)
    best = near.groupBy("i").agg(F.max(F.when(stays, gain)).alias("stay"), F.max(F.when(~stays, gain)).alias("go")).where("go is not null")
    best = best.join(own, "i").join(tot.withColumnRenamed("to", "j"), "j")
    stay = F.coalesce("stay", F.round(-pull * (F.col("tot") - F.col("k")), 9))
    return best.select("parent", "v", "c", "m2", (F.col("go") - stay).alias("rise")).where(_wants()).drop("m2")


def _risen(edges: DataFrame, before: DataFrame, after: DataFrame, resolution: float) -> bool:
    links = _halves(edges)
    strength = _strengths(links)
    old, new = (_quality(links, x.join(strength, ["parent", "v"]), resolution) for x in (before, after))
    rise = new.withColumnRenamed("quality", "now").join(old.drop("m2"), "parent")
    return not rise.where(F.col("now") > F.col("quality") + LEAST_GAIN * F.greatest("m2", F.lit(1.0))).isEmpty()


def _hierarchy(edges: DataFrame, start: DataFrame, method: str, resolution: float, in_task: int, trace: list | None) -> DataFrame:
    """Moves and contractions from the communities start (parent, v, c), until a contraction changes nothing
    or leaves graphs that a task can hold."""
    member = start.select("parent", "v", F.col("v").alias("node"))  # vertex to node of the contracted graph
    graph, nodes = edges, start.withColumn("bound", F.lit(None).cast("string"))
    while True:
        state = _move(graph, nodes, resolution, False, trace)
        final = member.join(state.select("parent", F.col("v").alias("node"), "c"), ["parent", "node"]).select("parent", "v", "c")
        if method == "leiden":  # communities are rebuilt from single nodes by moves inside them
            fine = _move(graph, state.select("parent", "v", F.col("v").alias("c"), F.col("c").alias("bound")), resolution, True, trace)
        else:
            fine = state.select("parent", "v", "c", F.col("c").alias("bound"))
        if fine.where("v <> c").isEmpty():
            break
        graph = cut(_contract(graph, fine))
        member = cut(member.join(fine.select("parent", F.col("v").alias("node"), "c"), ["parent", "node"]).select("parent", "v", F.col("c").alias("node")))
        nodes = fine.groupBy("parent", F.col("c").alias("v")).agg(F.min("bound").alias("c"))
        # a community is called after its least node of the contracted graph
        least = nodes.groupBy("parent", "c").agg(F.min("v").alias("least"))
        nodes = cut(nodes.join(least, ["parent", "c"]).select("parent", "v", F.col("least").alias("c"), F.lit(None).cast("string").alias("bound")))
        if _heavy(graph, nodes, in_task).isEmpty():
            state = _in_tasks(graph, nodes, method, resolution)
            final = member.join(state.select("parent", F.col("v").alias("node"), "c"), ["parent", "node"]).select("parent", "v", "c")
            break
    least = final.groupBy("parent", "c").agg(F.min("v").alias("least"))
    return cut(final.join(least, ["parent", "c"]).select("parent", "v", F.col("least").alias("c")))


def split_decisions(proposed: DataFrame, min_size: int) -> DataFrame:
    """What becomes of each proposed split.  proposed: (parent, id, child).

    (parent, size, children, small, pooled, decision): small children are pooled into one; a split is
    rejected if the pool stays too small or fewer than two children would remain.
    """
    child = proposed.groupBy("parent", "child").agg(F.count("*").alias("n"))
    is_small = F.col("n") < min_size
    parent = child.groupBy("parent").agg(
        F.sum("n").alias("size"), F.count("*").alias("children"), F.sum(is_small.cast("long")).alias("small"), F.sum(F.when(is_small, F.col("n")).otherwise(0)).alias("pooled"),
    )
    decision = (
        F.when(F.col("size") < min_size, "ineligible")
        .when(F.col("children") < 2, "unsplit")
        .when(F.col("small") == 0, "split")
        .when(F.col("pooled") < min_size, "rejected")
        .when(F.col("children") - F.col("small") + 1 < 2, "rejected")
        .otherwise("split")
    )
    return parent.withColumn("decision", decision)


def child_labels(proposed: DataFrame, min_size: int) -> DataFrame:
    """(id, label): the parent's label, with the child's number where the split is accepted.  Children
    are numbered by their least member, the pooled one last."""
    decisions = split_decisions(proposed, min_size)
    child = proposed.groupBy("parent", "child").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    child = child.withColumn("residual", F.col("n") < min_size)
    rank = F.dense_rank().over(Window.partitionBy("parent").orderBy("residual", F.when(~F.col("residual"), F.col("first"))))
    named = child.withColumn("number", rank).join(decisions.select("parent", "decision"), "parent")
    label = F.when(F.col("decision") == "split", F.concat_ws(".", "parent", F.col("number").cast("string"))).otherwise(F.col("parent"))
    return proposed.join(named.select("parent", "child", label.alias("label")), ["parent", "child"]).select("id", "label")


def refine(edges: DataFrame, labels: DataFrame, method: str, resolution: float, min_size: int) -> tuple[DataFrame, DataFrame]:
    """One level: (id, label) of the next, and a row of counters.  Parents that are too small, have
    no edges inside or don't split keep their label."""
    counts = labels.groupBy("label").agg(F.count("*").alias("size")).where(F.col("size") >= min_size).select("label")
    eligible = labels.join(counts, "label")
    inside = cut(induced(edges, eligible).select(F.col("label").alias("parent"), F.col("src").alias("a"), F.col("dst").alias("b"), F.col("weight").alias("w")))
    active = eligible.join(inside.select(F.col("parent").alias("label")).distinct(), "label", "left_semi")
    found = communities(inside, active.select(F.col("label").alias("parent"), F.col("id").alias("v")), method, resolution)
    proposed = cut(found.select("parent", F.col("v").alias("id"), F.col("c").alias("child")))
    new = child_labels(proposed, min_size).withColumnRenamed("label", "new")
    out = cut(labels.join(new, "id", "left").select("id", F.coalesce("new", "label").alias("label")))
    d = split_decisions(proposed, min_size)
    split = F.col("decision") == "split"
    counters = d.agg(F.sum(split.cast("long")).alias("split"), F.sum((F.col("decision") == "rejected").cast("long")).alias("rejected"), F.sum(F.when(split, F.col("small")).otherwise(0)).alias("merged"))
    groups = labels.agg(F.countDistinct("label").alias("groups")).join(counts.agg(F.count("*").alias("eligible")))
    counters = groups.join(counters).select(F.col("eligible"), F.coalesce("split", F.lit(0)).alias("split"), (F.col("groups") - F.coalesce("split", F.lit(0))).alias("carried"), F.coalesce("merged", F.lit(0)).alias("merged"), F.coalesce("rejected", F.lit(0)).alias("rejected"))
    return out, counters


def recursive(edges: DataFrame, samples: DataFrame, method: str = "leiden", depth: int = 3, resolution: float = 1.0, min_size: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Levels 0 to depth: members (id, level, label), diagnostics by level, and sizes."""
    labels = samples.select("id", F.lit("C1").alias("label"))
    members, rows = labels.withColumn("level", F.lit(0)), []
    n = samples.count()
    zero = {"eligible": int(n >= min_size), "split": 0, "carried": 0, "merged": 0, "rejected": 0}
    before = None
    for level in range(depth + 1):
        counted = zero
        if level:
            labels, counters = refine(edges, labels, method, resolution, min_size)
            counted = counters.first().asDict()
            members = members.unionByName(labels.withColumn("level", F.lit(level)))
        q = modularity(edges, labels).first()["modularity"]
        clusters = labels.select("label").distinct().count()
        rows.append((level, method, clusters, q, None if before is None else q - before, *(int(counted[k]) for k in zero), "fixed_depth_completed" if level == depth else ""))
        before = q
    names = "level int, method string, number_of_clusters long, modularity double, modularity_gain double, eligible long, split long, carried_forward long, small_children_merged long, rejected long, stopping_reason string"
    return members.select("id", "level", "label"), edges.sparkSession.createDataFrame(rows, names), sizes(members, depth, min_size)


def wide(members: DataFrame, depth: int) -> DataFrame:
    """ID and level_0 ... level_depth."""
    out = members.groupBy(F.col("id").alias("ID")).pivot("level", list(range(depth + 1))).agg(F.first("label"))
    return out.select("ID", *(F.col(str(i)).alias(f"level_{i}") for i in range(depth + 1)))
