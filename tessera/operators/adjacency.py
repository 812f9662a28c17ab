"""Communities of parents too large for a task, over packed rows.

Vertices of a parent are numbered in order.  A block, a row of a table, holds the links of every so many-th vertex as arrays;
a parent's state is one row, too: an array of each vertex's community and, by community, of its summed strengths, which is
small against the links.  A round sends the state to all blocks, twice.  First, tasks find of each vertex how much its best move would raise the
quality.  Those that want to move most, or are nearest to it, are chosen, as many as a task can hold with the links among them (HELD).  Then
tasks collect their weights to communities and these links, and one task for each bound moves them, one after the other, while all others stay: each
move's rise is exact, so quality only rises.  Rounds end when, of all vertices, none would move.

Communities are begun in groups of vertices by hash, a task each, and contracted by a pass over the blocks.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.shared import cut, numbered, passing, small

LEAST_GAIN = 1e-9
#: Links of a block (12 bytes each), and vertices of a parent whose state goes to every task (8 bytes each).
LINKS, KNOWN = 500_000, 1_000_000
#: Links of vertices to each other, and weights of vertices to communities, that one task may hold while it moves them (16 bytes each).
HELD = 8_000_000
#: Vertices times communities of which a task keeps all weights (8 bytes each): in a block, and while it moves vertices.
WEIGHTS, DENSE = 4_000_000, 16_000_000
TYPES = {
    "n": pa.int32(), "m2": pa.float64(), "k": pa.binary(), "c": pa.binary(), "bound": pa.binary(), "tot": pa.binary(), "chosen": pa.binary(),
    "quality": pa.float64(), "wants": pa.int64(), "moves": pa.int64(), "done": pa.bool_(),
}
SQL_NAMES = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.binary(): "binary", pa.bool_(): "boolean"}
STATE = ", ".join(f"{name} {SQL_NAMES[kind]}" for name, kind in TYPES.items())


def _ints(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.int32)


def _floats(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.float64)


def _bytes(x: np.ndarray, kind: type = np.int32) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _hash(v: np.ndarray) -> np.ndarray:
    """Numbers from 0 to 2**32 - 1 that mix a vertex's number."""
    x = v.astype(np.uint64) + np.uint64(1)
    for _ in range(2):
        x = ((x ^ (x >> np.uint64(16))) * np.uint64(2_246_822_519)) & np.uint64(0xFFFFFFFF)
    return x ^ (x >> np.uint64(15))


def settled(c: np.ndarray, dense: np.ndarray, tot: np.ndarray, k: np.ndarray, at: np.ndarray, to: np.ndarray, w: np.ndarray, total: float, resolution: float, least: float) -> np.ndarray:
    """Communities after gainful moves one after the other, until there are none.  dense: weights of each vertex to each community, kept
    up to date.  Sweeps find those that gain, of all vertices at once; each of them is looked at again when its turn comes, so
    vertices that stay cost no step of their own."""
    n, many = dense.shape
    pull, rows = resolution * k / total, max(1, 1_000_000 // many)
    while True:
        gainers = []
        for i in range(0, n, rows):
            part, own = slice(i, i + rows), c[i : i + rows]
            each = np.arange(len(own))
            gain = np.where(dense[part] > 1e-12, np.round(dense[part] - pull[part, None] * tot, 9), -np.inf)
            stay = np.round(dense[part][each, own] - pull[part] * (tot[own] - k[part]), 9)
            gain[each, own] = stay
            gainers.extend((i + np.flatnonzero(gain.max(1) > stay + least)).tolist())
        moves = 0
        for v in gainers:
            own, sums = c[v], dense[v]
            tot[own] -= k[v]
            gain = np.where(sums > 1e-12, np.round(sums - pull[v] * tot, 9), -np.inf)
            stay = round(sums[own] - pull[v] * tot[own], 9)
            gain[own] = stay
            best = int(gain.argmax())
            if gain[best] > stay + least:
                near, weight = to[at[v] : at[v + 1]], w[at[v] : at[v + 1]]
                c[v] = best
                np.subtract.at(dense, (near, own), weight)
                np.add.at(dense, (near, best), weight)
                moves += 1
            tot[c[v]] += k[v]
        if not moves:
            return c


def together(c: np.ndarray, tot: np.ndarray, k: np.ndarray, row: np.ndarray, code: np.ndarray, weight: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray, total: float, resolution: float) -> np.ndarray:
    """Communities c of vertices after gainful moves of them one after the other, until there are none; all others stay.  tot: strengths of communities; row, code,
    weight: weights of vertices to communities; x, y, w: links of these vertices to each other, in order."""
    n, many = len(c), len(tot)
    # weights to those of each community that stay: all but those of the vertices that are moved here
    cells, which = np.unique(np.concatenate((row, x)).astype(np.int64) * many + np.concatenate((code, c[y])), return_inverse=True)
    fixed = np.bincount(which, np.concatenate((weight, -w)), len(cells))
    at = np.searchsorted(x, np.arange(n + 1))
    least = LEAST_GAIN * max(total, 1.0) / 2
    if n * many <= DENSE:  # few communities: weights to all of them are kept up to date
        dense = np.bincount(cells, fixed, n * many)
        dense += np.bincount(x.astype(np.int64) * many + c[y], w, n * many)
        return settled(c, dense.reshape(n, many), tot, k, at, y, w, total, resolution, least)
    queue, waits = deque(range(n)), np.ones(n, bool)
    cell_at, to = np.searchsorted(cells, np.arange(n + 1) * many), cells % many
    while queue:
        v = queue.popleft()
        waits[v] = False
        near, weight = y[at[v] : at[v + 1]], w[at[v] : at[v + 1]]
        own, pull = c[v], resolution * k[v] / total
        tot[own] -= k[v]
        there, which = np.unique(np.concatenate((to[cell_at[v] : cell_at[v + 1]], c[near])), return_inverse=True)
        sums = np.bincount(which, np.concatenate((fixed[cell_at[v] : cell_at[v + 1]], weight)))
        gain = np.where(sums > 1e-12, np.round(sums - pull * tot[there], 9), -np.inf)
        stay = round(sums[there == own].sum() - pull * tot[own], 9)
        best = int(gain.argmax()) if len(gain) else -1
        if best >= 0 and there[best] != own and gain[best] > stay + least:
            c[v] = there[best]
            again = near[(c[near] != c[v]) & ~waits[near]]
            waits[again] = True
            queue.extend(again.tolist())
        tot[c[v]] += k[v]
    return c


def _each(rows: DataFrame, kind: str, schema: str, change: Callable[[dict], Iterator[dict]], types: dict) -> DataFrame:
    """Rows with arrays, changed one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for out in change(batch.slice(i, 1).to_pylist()[0]):
                    yield pa.RecordBatch.from_arrays([pa.array([out["parent"]], batch.schema.field("parent").type), *(pa.array([out[x]], t) for x, t in types.items())], names=["parent", *types])

    return rows.mapInArrow(run, f"parent {kind}, {schema}")


def _table(parent: pa.ChunkedArray, row: dict) -> pa.Table:
    return pa.table({"parent": parent.slice(0, 1), **{x: pa.array([row[x]], t) for x, t in TYPES.items()}})


def _fresh(row: dict, c: np.ndarray, bound: np.ndarray | None) -> dict:
    """A state to begin rounds with.  c: numbers below n."""
    c = np.unique(c, return_inverse=True)[1]
    return {**row, "c": _bytes(c), "bound": None if bound is None else _bytes(bound), "tot": _bytes(np.bincount(c, _floats(row["k"])), np.float64), "chosen": b"",
            "quality": -math.inf, "wants": 0, "moves": 0, "done": row["m2"] <= 0}


class Packed:
    """Graphs as blocks: edges (parent, a, b, w) between numbers below n, loops allowed; sizes (parent, n); counts (parent, m) of edges."""

    def __init__(self, edges: DataFrame, sizes: DataFrame, counts: DataFrame):
        self.kind = kind = dict(edges.dtypes)["parent"]
        sizes = cut(sizes.join(counts, "parent", "left").select("parent", "n", F.coalesce("m", F.lit(0)).alias("m"), F.greatest(F.ceil(2 * F.col("m") / LINKS), F.lit(1)).cast("int").alias("of")))
        self.many = sizes.agg(F.sum("of")).first()[0]

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0
            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows >= 2 * LINKS:
                    yield from dealt(pa.Table.from_batches(held))
                    held, rows = [], 0
            if rows:
                yield from dealt(pa.Table.from_batches(held))

        def dealt(table: pa.Table) -> Iterator[pa.RecordBatch]:
            parents = table["parent"].combine_chunks().dictionary_encode()
            which, (a, b, of) = np.asarray(parents.indices), (table[x].to_numpy() for x in ("a", "b", "of"))
            w = table["w"].to_numpy().astype(np.float64)
            for i, parent in enumerate(parents.dictionary):
                mine = slice(None) if len(parents.dictionary) == 1 else which == i
                x, y, z, many = np.concatenate((a[mine], b[mine])), np.concatenate((b[mine], a[mine])), np.tile(w[mine], 2), int(of[mine][0])
                block = x % many
                order = np.argsort(block.astype(np.uint16) if many < 65_536 else block, kind="stable")
                ends = np.searchsorted(block[order], np.arange(many + 1))
                some = np.flatnonzero(np.diff(ends))
                cells = lambda v: pa.array([v[order[ends[j] : ends[j + 1]]].tobytes() for j in some], pa.binary())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array([parent.as_py()] * len(some), parents.dictionary.type), pa.array(some, pa.int32()), pa.array([many] * len(some), pa.int32()), cells(x), cells(y), cells(z)],
                                                 names=["parent", "block", "of", "x", "y", "w"])

        def block(table: pa.Table) -> pa.Table:
            x, y, w = (np.frombuffer(b"".join(table[name].to_pylist()), kind) for name, kind in (("x", np.int32), ("y", np.int32), ("w", np.float64)))
            number, of, n = (table[name][0].as_py() for name in ("block", "of", "n"))
            own, mine = -(-(n - number) // of), x // of
            order = np.lexsort((y, mine))
            x, y, w, mine = x[order], y[order], w[order], mine[order]
            k, apart = np.bincount(mine, w, own), x != y
            cells = {"at": np.searchsorted(mine[apart], np.arange(own + 1)).astype(np.int32), "to": y[apart], "w": w[apart], "k": k}
            return pa.table({"parent": table["parent"].slice(0, 1), "block": table["block"].slice(0, 1), "of": table["of"].slice(0, 1), **{name: pa.array([v.tobytes()], pa.binary()) for name, v in cells.items()}})

        rows = edges.select("parent", F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), "w").join(F.broadcast(sizes.select("parent", "of")), "parent")
        rows = rows.mapInArrow(pieces, f"parent {kind}, block int, of int, x binary, y binary, w binary")
        # few blocks to a file, as a reader holds several rows at once
        parts = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), self.many // 8)
        rows = rows.join(F.broadcast(sizes.select("parent", "n")), "parent").repartition(parts, "parent", "block")
        self.blocks = cut(rows.groupBy("parent", "block").applyInArrow(block, f"parent {kind}, block int, of int, at binary, to binary, w binary, k binary"))
        self.sizes = sizes

    def state(self) -> DataFrame:
        """Every vertex alone."""
        def whole(size: pa.Table, blocks: pa.Table) -> pa.Table:
            if not len(size):
                return pa.table({"parent": size["parent"], **{x: pa.array([], t) for x, t in TYPES.items()}})
            n = size["n"][0].as_py()
            k = np.zeros(n)
            for row in blocks.to_pylist():
                k[row["block"] :: row["of"]] = _floats(row["k"])
            return _table(size["parent"], _fresh({"n": n, "m2": float(k.sum()), "k": _bytes(k, np.float64)}, np.arange(n), None))

        parts = self.blocks.select("parent", "block", "of", "k").groupBy("parent")
        return cut(self.sizes.select("parent", "n").groupBy("parent").cogroup(parts).applyInArrow(whole, f"parent {self.kind}, {STATE}"))

    def began(self, state: DataFrame, resolution: float, in_task: int) -> DataFrame:
        """The state, that of parents with more links than a task holds with communities found inside of groups: by hash, so many that a task holds one's links, and by bound; those of all
        groups of a bound are joined if a task can hold what is between them."""
        def spread(row: dict) -> Iterator[dict]:
            at, to, _ = _links(row)
            bound = _ints(row["bound"])
            vertex = np.repeat(np.arange(len(at) - 1), np.diff(at))
            own = bound[row["block"] :: row["of"]][vertex]
            yield {"parent": row["parent"], "links": _bytes(np.bincount(own[own == bound[to]], minlength=int(bound.max()) + 1), np.int64)}

        def grouped(row: dict) -> Iterator[dict]:
            at, to, w = _links(row)
            bound, parts, k = _ints(row["bound"]), _ints(row["parts"]), _floats(row["k"])
            v = np.arange(row["block"], row["n"], row["of"])
            group = lambda x: parts[1][bound[x]] + _hash(x) % parts[0][bound[x]]
            parts = (parts.astype(np.uint64), np.concatenate(([0], np.cumsum(parts)[:-1])).astype(np.uint64))
            mine = group(v).astype(np.int64)
            x, g = np.repeat(v, np.diff(at)), np.repeat(mine, np.diff(at))
            some = x < to
            x, y, w, g = x[some], to[some], w[some], g[some]
            some = bound[x] == bound[y]
            x, y, w, g = x[some], y[some], w[some], g[some]
            some = g == group(y).astype(np.int64)
            x, y, w, g = x[some], y[some], w[some], g[some]
            order, vs = np.argsort(g, kind="stable"), np.argsort(mine, kind="stable")
            names = np.unique(mine)
            ends, v_ends = (np.append(np.searchsorted(keys, names), len(keys)) for keys in (g[order], mine[vs]))
            for i, name in enumerate(names.tolist()):
                e, f = order[ends[i] : ends[i + 1]], vs[v_ends[i] : v_ends[i + 1]]
                yield {"parent": row["parent"], "g": name, "m2": row["m2"], "v": _bytes(v[f]), "k": _bytes(k[f], np.float64), "x": _bytes(x[e]), "y": _bytes(y[e]), "w": _bytes(w[e], np.float64)}

        def solve(table: pa.Table) -> pa.Table:
            from tessera.operators.communities import _Local

            column = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
            v, k, x, y, w = (column(name, np.int32 if name in "vxy" else np.float64) for name in "vkxyw")
            order = np.argsort(v)
            v, k = v[order], k[order]
            a, b = np.searchsorted(v, x), np.searchsorted(v, y)
            order = np.lexsort((b, a))
            found = _Local(a[order], b[order], w[order], len(v), k, table["m2"][0].as_py()).solved(np.arange(len(v)), resolution, False)
            return pa.table({"parent": table["parent"].slice(0, 1), "v": pa.array([_bytes(v)], pa.binary()), "c": pa.array([_bytes(v[found])], pa.binary())})

        def joined(state: pa.Table, groups: pa.Table) -> pa.Table:
            row = state.to_pylist()[0]
            c = np.arange(row["n"])
            for v, found in zip(groups["v"].to_pylist(), groups["c"].to_pylist(), strict=True):
                c[_ints(v)] = _ints(found)
            return _table(state["parent"], _fresh(row, c, _ints(row["bound"])))

        def counted(state: pa.Table, blocks: pa.Table) -> pa.Table:
            bound = state["bound"].to_pylist()[0]
            links = np.zeros(int(_ints(bound).max()) + 1, np.int64)
            for x in blocks["links"].to_pylist():
                links += np.frombuffer(x, np.int64)
            parts = np.maximum(np.ceil(np.sqrt(links / in_task)), 1)
            return pa.table({"parent": state["parent"], "bound": state["bound"], "n": state["n"], "m2": state["m2"], "parts": pa.array([_bytes(parts)], pa.binary())})

        kind, large = self.kind, cut(self.sizes.where(2 * F.col("m") > in_task).select("parent"))
        if large.isEmpty():
            return state
        state, rest = (cut(state.join(large, "parent", how)) for how in ("left_semi", "left_anti"))
        sent = state.where("m2 > 0").select("parent", "n", "m2", "bound")
        links = _each(self._met(sent.select("parent", "bound")), kind, "links binary", spread, {"links": pa.binary()})
        sent = cut(sent.groupBy("parent").cogroup(links.groupBy("parent")).applyInArrow(counted, f"parent {kind}, bound binary, n int, m2 double, parts binary"))
        types = {"g": pa.int64(), "m2": pa.float64(), **dict.fromkeys(("v", "k", "x", "y", "w"), pa.binary())}
        groups = _each(self._met(sent), kind, "g long, m2 double, v binary, k binary, x binary, y binary, w binary", grouped, types)
        parts = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        groups = groups.repartition(max(parts, 4 * self.many // 10), "parent", "g").groupBy("parent", "g").applyInArrow(solve, f"parent {kind}, v binary, c binary")
        state = cut(state.groupBy("parent").cogroup(cut(groups).groupBy("parent")).applyInArrow(joined, f"parent {kind}, {STATE}"))
        return rest.unionByName(self.finished(state, self.contracted(state, True), "louvain", resolution, in_task))

    def _met(self, sent: DataFrame) -> DataFrame:
        return self.blocks.join(F.broadcast(sent), "parent")

    def rounds(self, state: DataFrame, resolution: float, most: int, trace: list | None) -> DataFrame:
        """The state after moves of single vertices, inside of bounds if there are any, until there are none."""
        def look(row: dict) -> Iterator[dict]:
            yield _looked(row, resolution)

        def choose(state: pa.Table, blocks: pa.Table) -> pa.Table:
            return _table(state["parent"], _chosen(state.to_pylist()[0], blocks.sort_by("block").to_pylist(), resolution)) if len(blocks) else state.select(["parent", *TYPES])

        def collect(row: dict) -> Iterator[dict]:
            yield from _collected(row)

        def move(table: pa.Table) -> pa.Table:
            return _moved(table.sort_by("block"), resolution)

        def put(state: pa.Table, moved: pa.Table) -> pa.Table:
            if not len(moved):
                return state.select(["parent", *TYPES])
            row = state.to_pylist()[0]
            c = _ints(row["c"]).copy()
            for v, to in zip(moved["v"].to_pylist(), moved["c"].to_pylist(), strict=True):
                c[_ints(v)] = _ints(to)
            now = _fresh(row, c, None if row["bound"] is None else _ints(row["bound"]))
            return _table(state["parent"], now | {x: row[x] for x in ("quality", "wants")} | {"moves": sum(moved["moves"].to_pylist())})

        seen = {"block": pa.int32(), "inside": pa.float64(), "of": pa.int32(), "rise": pa.binary(), "cells": pa.binary(), "links": pa.binary()}
        met = {"block": pa.int32(), "u": pa.int32(), "m2": pa.float64(), **dict.fromkeys(("v", "c", "k", "own_tot", "row", "to", "weight", "tot", "x", "y", "w"), pa.binary())}
        schema = lambda types: ", ".join(f"{x} {SQL_NAMES[t]}" for x, t in types.items())
        kind, parts = self.kind, int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        with passing(state.sparkSession) as keep:
            for turn in range(most):
                with passing(state.sparkSession) as keep_state:
                    found = _each(self._met(state.where("not done").select("parent", "m2", "c", "bound", "tot")), kind, schema(seen), look, seen)
                    state = keep_state(cut(state.groupBy("parent").cogroup(found.groupBy("parent")).applyInArrow(choose, f"parent {kind}, {STATE}")))
                    if state.where("not done").isEmpty():
                        break
                    found = _each(self._met(state.where("not done").select("parent", "m2", "c", "bound", "tot", "chosen")), kind, schema(met), collect, met)
                    moved = cut(found.repartition(parts, "parent", "u").groupBy("parent", "u").applyInArrow(move, f"parent {kind}, v binary, c binary, moves long"))
                    state = keep_state(cut(state.groupBy("parent").cogroup(moved.groupBy("parent")).applyInArrow(put, f"parent {kind}, {STATE}")))
                if trace is not None:
                    trace.append((turn, *state.where("not done").agg(F.sum("wants"), F.sum("moves")).first()))
            return keep(state)

    def contracted(self, state: DataFrame, within: bool = False) -> DataFrame:
        """Edges between communities (parent, a, b, w), their numbers as in the state; what is inside of them becomes loops.  within: only those of the same bound."""
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {}
            for batch in batches:
                kind = batch.schema.field("parent").type
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    at, to, w = _links(row)
                    c = _ints(row["c"])
                    many = int(c.max()) + 1
                    mine, vertex = c[row["block"] :: row["of"]], np.repeat(np.arange(len(at) - 1), np.diff(at))
                    own, ends, loops = mine[vertex], c[to], _floats(row["k"]) - np.bincount(vertex, w, len(mine))
                    some = own <= ends
                    if within:
                        bound = _ints(row["bound"])
                        some &= bound[row["block"] :: row["of"]][vertex] == bound[to]
                    looped = np.flatnonzero(loops > 1e-9 * _floats(row["k"]))
                    pair = np.concatenate((own[some].astype(np.int64) * many + ends[some], mine[looped].astype(np.int64) * (many + 1)))
                    pair, which = np.unique(pair, return_inverse=True)
                    sums = np.bincount(which, np.concatenate((w[some], loops[looped])), len(pair))
                    if row["parent"] in held:
                        pair, which = np.unique(np.concatenate((held[row["parent"]][0], pair)), return_inverse=True)
                        sums = np.bincount(which, np.concatenate((held[row["parent"]][1], sums)), len(pair))
                    held[row["parent"]] = pair, sums, many
                    if len(pair) > WEIGHTS:
                        yield from out(kind, row["parent"], *held.pop(row["parent"]))
            for parent, rows in held.items():
                yield from out(kind, parent, *rows)

        def out(kind: pa.DataType, parent: object, pair: np.ndarray, sums: np.ndarray, many: int) -> Iterator[pa.RecordBatch]:
            a, b = (pair // many).astype(np.int32), (pair % many).astype(np.int32)
            sums = np.where(a == b, sums / 2, sums)  # links inside were met from both of their ends
            for i in range(0, len(pair), 100_000):
                part = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array([parent] * len(a[part]), kind), pa.array(a[part]), pa.array(b[part]), pa.array(sums[part])], names=["parent", "a", "b", "w"])

        rows = self._met(state.where("m2 > 0").select("parent", "c", "bound")).mapInArrow(summed, f"parent {self.kind}, a int, b int, w double")
        return cut(rows.groupBy("parent", "a", "b").agg(F.sum("w").alias("w")))

    def finished(self, state: DataFrame, edges: DataFrame, method: str, resolution: float, in_task: int) -> DataFrame:
        """The state with its communities, between which these are the edges, put together in one task for each parent that a task can hold; for Leiden beginning from the bounds."""
        def solve(state: pa.Table, edges: pa.Table) -> pa.Table:
            from tessera.operators.communities import _Local

            if not len(edges):
                return state.select(["parent", *TYPES])
            row = state.to_pylist()[0]
            c, tot = _ints(row["c"]), _floats(row["tot"])
            a, b = edges["a"].to_numpy(), edges["b"].to_numpy()
            order = np.lexsort((b, a))
            start = np.arange(len(tot)) if method == "louvain" else _first(c, _ints(row["bound"]))
            found = _Local(a[order].astype(np.int64), b[order].astype(np.int64), edges["w"].to_numpy()[order], len(tot), tot, row["m2"]).solved(start, resolution, method == "leiden")
            return _table(state["parent"], _fresh(row, found[c], None if row["bound"] is None else _ints(row["bound"])))

        few = edges.groupBy("parent").count().where(F.col("count") <= in_task).select("parent")
        edges = edges.join(F.broadcast(few), "parent", "left_semi")
        return cut(state.groupBy("parent").cogroup(edges.groupBy("parent")).applyInArrow(solve, f"parent {self.kind}, {STATE}"))


def _links(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _ints(row["at"]), _ints(row["to"]), _floats(row["w"])


def _first(c: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """For each community the least one of the same bound."""
    of = np.zeros(int(c.max()) + 1, np.int64)
    of[c] = bound
    _, first, which = np.unique(of, return_index=True, return_inverse=True)
    return first[which]


def _near(row: dict, some: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Links (vertex of the block, to, weight) of some vertices inside of their bounds, and weights by (vertex, community) in order."""
    (at, to, w), c, many = _links(row), _ints(row["c"]), len(row["tot"]) // 8
    vertex = np.repeat(np.arange(len(at) - 1), np.diff(at))
    if some is not None:
        of = some[vertex]
        vertex, to, w = vertex[of], to[of], w[of]
    if row["bound"] is not None:
        bound = _ints(row["bound"])
        same = bound[row["block"] :: row["of"]][vertex] == bound[to]
        vertex, to, w = vertex[same], to[same], w[same]
    if (len(at) - 1) * many <= WEIGHTS:
        sums = np.bincount(vertex * many + c[to], w, (len(at) - 1) * many)
        pair = np.flatnonzero(sums > 1e-12)
        sums = sums[pair]
    else:
        pair, which = np.unique(vertex * many + c[to], return_inverse=True)
        sums = np.bincount(which, w, len(pair))
        pair, sums = pair[sums > 1e-12], sums[sums > 1e-12]
    return vertex, to, w, pair // many, pair % many, sums


def _looked(row: dict, resolution: float) -> dict:
    """How much the best move of each vertex of a block would raise the quality (below 0: lower; -inf: there is none), what its weights and links are, and the weight inside of communities."""
    vertex, to, w, v, there, sums = _near(row)
    c, k, tot = _ints(row["c"]), _floats(row["k"]), _floats(row["tot"])
    own, pull = c[row["block"] :: row["of"]], resolution * k / row["m2"]
    stays = there == own[v]
    gain = np.round(sums - pull[v] * (tot[there] - np.where(stays, k[v], 0.0)), 9)
    stay, go = np.round(-pull * (tot[own] - k), 9), np.full(len(k), -np.inf)
    stay[v[stays]] = gain[stays]
    some, first = np.unique(v[~stays], return_index=True)
    if len(some):
        go[some] = np.maximum.reduceat(gain[~stays], first)
    return {"parent": row["parent"], "block": row["block"], "of": row["of"], "inside": float(sums[stays].sum()), "rise": _bytes(go - stay, np.float64),
            "cells": _bytes(np.bincount(v, minlength=len(k))), "links": _bytes(np.bincount(vertex, minlength=len(k)))}


def _chosen(row: dict, blocks: list[dict], resolution: float) -> dict:
    """The state with its quality and those vertices that are to be moved together: of each bound as many as a task can hold, by their rise."""
    n, tot = row["n"], _floats(row["tot"])
    rise, cells, links = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for x in blocks:
        part = slice(x["block"], None, x["of"])
        rise[part], cells[part], links[part] = _floats(x["rise"]), _ints(x["cells"]), _ints(x["links"])
    quality = sum(x["inside"] for x in blocks) / 2 - resolution * float((tot * tot).sum()) / (2 * row["m2"])
    wants = int((rise > LEAST_GAIN * max(row["m2"], 1.0)).sum())
    bound = np.zeros(n, np.int32) if row["bound"] is None else _ints(row["bound"])
    gains = np.bincount(bound, rise > LEAST_GAIN * max(row["m2"], 1.0)) > 0  # bounds in which none would move are settled
    of = np.flatnonzero((rise > -np.inf) & gains[bound])
    of = of[np.lexsort((of, -rise[of], bound[of]))]
    if len(of):
        first = np.searchsorted(bound[of], bound[of])  # where each one's bound begins
        run = lambda x: np.cumsum(x[of]) - np.cumsum(x[of])[first] + x[of][first]
        among = run(links).astype(float) ** 2 / np.maximum(np.bincount(bound, links)[bound[of]], 1)
        of = of[(np.arange(len(of)) == first) | ((among <= HELD) & (run(cells) <= HELD))]
    chosen = np.zeros(n, np.uint8)
    chosen[of] = 1
    return row | {"quality": quality, "wants": wants, "moves": 0, "chosen": chosen.tobytes(), "done": not wants}


def _collected(row: dict) -> Iterator[dict]:
    """By bound: a block's chosen vertices (v, c, k, own_tot), their weights to communities (row: whose, to, weight, tot) and links among all chosen ones (x, y, w)."""
    block, of, chosen = row["block"], row["of"], np.frombuffer(row["chosen"], np.uint8).astype(bool)
    mine = chosen[block::of]
    if not mine.any():
        return
    vertex, to, w, v, there, sums = _near(row, mine)
    c, k, tot = _ints(row["c"]), _floats(row["k"]), _floats(row["tot"])
    bound = np.zeros(len(chosen), np.int32) if row["bound"] is None else _ints(row["bound"])
    own, some = bound[block::of], np.flatnonzero(mine)
    here = chosen[to]
    vertex, to, w = vertex[here], to[here], w[here]
    name = lambda x: x * of + block
    for u in np.unique(own[some]).tolist():
        i, e, f = some[own[some] == u], own[v] == u, own[vertex] == u
        yield {"parent": row["parent"], "block": block, "u": u, "m2": row["m2"], "v": _bytes(name(i)), "c": _bytes(c[name(i)]), "k": _bytes(k[i], np.float64), "own_tot": _bytes(tot[c[name(i)]], np.float64),
               "row": _bytes(name(v[e])), "to": _bytes(there[e]), "weight": _bytes(sums[e], np.float64), "tot": _bytes(tot[there[e]], np.float64), "x": _bytes(name(vertex[f])), "y": _bytes(to[f]), "w": _bytes(w[f], np.float64)}


def _moved(table: pa.Table, resolution: float) -> pa.Table:
    """Communities of the chosen vertices of a bound after gainful moves one after the other, until there are none."""
    column = lambda name, kind=np.int32: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    v, own, there = column("v"), column("c"), column("to")
    labels, codes = np.unique(np.concatenate((own, there)), return_inverse=True)
    tot = np.zeros(len(labels))
    tot[codes] = np.concatenate((column("own_tot", np.float64), column("tot", np.float64)))
    order, n = np.argsort(v), len(v)
    v, c, k = v[order], codes[:n][order], column("k", np.float64)[order]
    x, y, row = (np.searchsorted(v, column(name)).astype(np.int32) for name in ("x", "y", "row"))
    w, by = column("w", np.float64), np.lexsort((y, x))
    start = c.copy()
    c = together(c, tot, k, row, codes[n:], column("weight", np.float64), x[by], y[by], w[by], table["m2"][0].as_py(), resolution)
    return pa.table({"parent": table["parent"].slice(0, 1), "v": pa.array([_bytes(v)], pa.binary()), "c": pa.array([_bytes(labels[c])], pa.binary()), "moves": pa.array([int((c != start).sum())], pa.int64())})


def _compact(state: DataFrame, kind: str, change: Callable[[dict], dict]) -> DataFrame:
    def run(row: dict) -> Iterator[dict]:
        yield {"parent": row["parent"], **change(row)}

    return cut(_each(state, kind, STATE, run, TYPES))


def _hierarchy(graph: Packed, state: DataFrame, method: str, resolution: float, in_task: int, groups: int, most: int, trace: list | None) -> DataFrame:
    """Moves and contractions, until a contraction changes nothing or leaves graphs that a task can hold; Leiden again from what it found, until that raises the quality no more."""
    kind, final, before = graph.kind, [], None
    while True:
        state = graph.rounds(state, resolution, most, trace)
        if method == "leiden":  # parents whose quality rose go on
            now = state.select("parent", "quality", "m2")
            if before is not None:
                rose = now.join(before.withColumnRenamed("quality", "old").drop("m2"), "parent").where(F.col("quality") > F.col("old") + LEAST_GAIN * F.greatest("m2", F.lit(1.0))).select("parent")
                rose = cut(rose)
                final.append(cut(state.join(rose, "parent", "left_anti")))
                state = cut(state.join(rose, "parent", "left_semi"))
                if state.isEmpty():
                    break
            before = now
        fine = state
        if method == "leiden":  # communities are rebuilt from single nodes by moves inside them
            fine = _compact(state, kind, lambda row: _fresh(row, np.arange(row["n"]), np.unique(_ints(row["c"]), return_inverse=True)[1]))
            fine = graph.rounds(graph.began(fine, resolution, groups), resolution, most, trace)
        fine = _compact(fine, kind, lambda row: _fresh(row, _ints(row["c"]), None if row["bound"] is None else _ints(row["bound"])))
        alone = F.length("tot") / 8 == F.col("n")
        if fine.where(~alone).isEmpty():
            final.append(state)
            break
        edges = graph.contracted(fine)
        few = cut(fine.select("parent", (F.length("tot") / 8).alias("nodes")).join(edges.groupBy("parent").count(), "parent", "left").where(F.col("nodes") + F.coalesce("count", F.lit(0)) <= in_task).select("parent"))
        found = graph.finished(fine.join(few, "parent", "left_semi"), edges, method, resolution, in_task)
        large = fine.join(few, "parent", "left_anti")
        if not large.isEmpty():
            rest = edges.join(few, "parent", "left_anti")
            nodes = Packed(rest, large.select("parent", (F.length("tot") / 8).cast("int").alias("n")), rest.groupBy("parent").agg(F.count("*").alias("m")))
            start = nodes.state()
            if method == "leiden":
                begun = large.select("parent", F.col("c").alias("member"), F.col("bound").alias("of"))
                start = _compact(start.join(begun, "parent"), kind, lambda row: _fresh({x: row[x] for x in TYPES}, _first(_ints(row["member"]), _ints(row["of"])), None))
            upper = _hierarchy(nodes, start, method, resolution, in_task, groups, most, trace).select("parent", F.col("c").alias("upper"))
            found = found.unionByName(_compact(large.join(upper, "parent"), kind, lambda row: _fresh({x: row[x] for x in TYPES}, _ints(row["upper"])[_ints(row["c"])], None)))
        state = _compact(found, kind, lambda row: _fresh(row, _ints(row["c"]), None))
        if method == "louvain":
            final.append(state)
            break
    out = final[0]
    for x in final[1:]:
        out = out.unionByName(x)
    return out


def solved(edges: DataFrame, vertices: DataFrame, method: str, resolution: float, in_task: int, groups: int, most: int, trace: list | None) -> DataFrame:
    """(parent, v, c): communities of parents with at most KNOWN vertices; c is the least vertex of the community."""
    kind = dict(edges.dtypes)["parent"]
    with passing(edges.sparkSession) as keep:
        names = cut(numbered(vertices.select("parent", "v"), [F.col("v")], "parent", "i").withColumn("i", F.col("i").cast("int")))
        side = lambda x: small(names.select("parent", F.col("v").alias(x), F.col("i").alias(f"i_{x}")), KNOWN)
        rows = edges.join(side("a"), ["parent", "a"]).join(side("b"), ["parent", "b"]).select("parent", F.col("i_a").alias("a"), F.col("i_b").alias("b"), "w")
        graph = Packed(rows, names.groupBy("parent").agg(F.count("*").cast("int").alias("n")), edges.groupBy("parent").agg(F.count("*").alias("m")))
        state = graph.state()
        whole = _compact(state, kind, lambda row: _fresh(row, np.arange(row["n"]), np.zeros(row["n"])))
        state = _compact(graph.began(whole, resolution, groups), kind, lambda row: _fresh(row, _ints(row["c"]), None))
        state = _hierarchy(graph, state, method, resolution, in_task, groups, most, trace)

        def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for parent, c in zip(batch["parent"], batch["c"].to_pylist(), strict=True):
                    c = _ints(c)
                    _, first, which = np.unique(c, return_index=True, return_inverse=True)
                    for i in range(0, len(c), 100_000):
                        own = np.arange(i, min(i + 100_000, len(c)), dtype=np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array([parent.as_py()] * len(own), batch.schema.field("parent").type), pa.array(own), pa.array(first[which[own]].astype(np.int32))], names=["parent", "i", "least"])

        found = state.select("parent", "c").mapInArrow(rows_of, f"parent {kind}, i int, least int")
        found = found.join(names, ["parent", "i"]).join(names.select("parent", F.col("i").alias("least"), F.col("v").alias("c")), ["parent", "least"])
        return keep(cut(found.select("parent", "v", "c")))
