"""Near-duplicate embeddings: a cosine join in epsilon grid order.

Unit vectors are turned to their principal axes; on the leading ones they fall into grid cells whose
side is the distance that the cosine threshold allows.  Sorted by cell, vectors form a sequence that
is cut into blocks.  Intervals of the sequence are joined top down: two intervals whose boxes on the
leading axes lie further apart than the threshold hold no pair and are skipped, others are split.
The upper levels run as joins of a table of boxes, the lowest inside the task that got two blocks.
Turning keeps lengths, and leaving out axes only shortens distances, so nothing is lost.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing.  Vectors
of different lengths never link.  Rows that repeat an id are one vector: of different ones, the first
by a hash of its components counts.  An empty table gives an empty result.

How much is skipped depends on the data: vectors in groups leave most pairs of blocks out, while for
vectors that are spread alike over all axes every box reaches every other one, and all pairs of
blocks are multiplied out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, saved, shuffles, table
from .links import LINKS, link_rows

#: Leading principal axes of the grid; vectors of a block; smaller intervals are multiplied out.
AXES, BLOCK, LEAF, FANOUT = 8, 4096, 512, 16


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, double precision."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _second_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: np.ndarray | float = 0.0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("v"))
            total = total + np.vstack((x.T @ x, x.sum(axis=0)[None, :]))
    if isinstance(total, np.ndarray):
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "value"])


def _axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Leading principal axes, from sums over all vectors; the driver gets (size + 1) * size numbers."""
    sums = vectors.select("v").mapInArrow(_second_moments, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    moments = np.zeros((size + 1) * size)
    moments[sums["cell"].to_numpy()] = sums["value"].to_numpy()
    moments = moments.reshape(size + 1, size)
    n = max(np.trace(moments[:size]), 1.0)
    mean = moments[size] / n
    return np.linalg.eigh(moments[:size] / n - np.outer(mean, mean))[1][:, ::-1][:, : min(AXES, size)]


def _cells(axes: np.ndarray, side: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(_matrix(batch.column("v")) @ axes / side).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("vec", "copies", "v")), *(pa.array(c) for c in cells.T)], names=["vec", "copies", "v", *(f"c{i}" for i in range(cells.shape[1]))])

    return run


def _blocks(axes: np.ndarray):
    """Cut a sorted partition into blocks: their vectors packed, and their boxes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, rest = TaskContext.get().partitionId(), 0, None

        def block(rows: pa.Table) -> pa.RecordBatch:
            v = rows.column("v").combine_chunks()
            p = _matrix(v) @ axes
            raw = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) | chunk]), pa.array([part]), *(pa.array([x.tobytes()], pa.binary()) for x in (rows.column("vec").to_numpy(), rows.column("copies").to_numpy(), raw.astype(np.float32) if (raw.astype(np.float32) == raw).all() else raw)), pa.array([p.min(axis=0).tolist()]), pa.array([p.max(axis=0).tolist()]), pa.array([rows.num_rows])],
                names=["node", "parent", "vecs", "copies", "values", "low", "high", "n"],
            )

        for batch in batches:
            own = pa.Table.from_batches([batch])
            rest = own if rest is None else pa.concat_tables([rest, own])
            while rest.num_rows >= BLOCK:
                yield block(rest.slice(0, BLOCK))
                rest, chunk = rest.slice(BLOCK), chunk + 1
        if rest is not None and rest.num_rows:
            yield block(rest)

    return run


def _join(axes: np.ndarray, threshold: float, reach: float):
    def load(batch: pa.RecordBatch, i: int, side: str):
        vecs, copies, values = (batch.column(f"{side}_{x}")[i].as_py() for x in ("vecs", "copies", "values"))
        vecs, copies = np.frombuffer(vecs, np.int64), np.frombuffer(copies, np.int64)
        x = np.frombuffer(values, np.float32 if len(values) // len(vecs) == 4 * len(axes) else np.float64).astype(np.float64).reshape(len(vecs), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        return vecs, copies, x, x @ axes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a = load(batch, i, "a")
                same = batch.column("a")[i].as_py() == batch.column("b")[i].as_py()
                b = a if same else load(batch, i, "b")
                link = np.zeros((len(a[0]), len(b[0])), dtype=bool)
                todo = [(0, len(a[0]), 0, len(b[0]))]
                while todo:
                    a0, a1, b0, b1 = todo.pop()
                    gap = np.maximum(a[3][a0:a1].min(axis=0) - b[3][b0:b1].max(axis=0), b[3][b0:b1].min(axis=0) - a[3][a0:a1].max(axis=0))
                    if (np.maximum(gap, 0) ** 2).sum() > reach * reach or same and b1 <= a0:
                        continue
                    if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
                        link[a0:a1, b0:b1] = a[2][a0:a1] @ b[2][b0:b1].T >= threshold
                        if same and a0 != b0:
                            link[b0:b1, a0:a1] = link[a0:a1, b0:b1].T
                    elif a1 - a0 >= b1 - b0 and (not same or a0 != b0 or a1 != b1):
                        m = (a0 + a1) // 2
                        todo += [(a0, m, b0, b1), (m, a1, b0, b1)]
                    elif same and a0 == b0 and a1 == b1:
                        m = (a0 + a1) // 2
                        todo += [(a0, m, a0, m), (a0, m, m, a1), (m, a1, m, a1)]
                    else:
                        m = (b0 + b1) // 2
                        todo += [(a0, a1, b0, m), (a0, a1, m, b1)]
                if same:
                    np.fill_diagonal(link, False)
                yield link_rows(link, a[0], a[1], b[0], b[1], same)

    return run


def _near_blocks(boxes: DataFrame, reach: float) -> DataFrame:
    """Pairs (a <= b) of blocks whose boxes are within reach, from the whole sequence downwards."""
    levels = [boxes.select("node", "parent", "low", "high")]
    width = len(boxes.select("low").first()[0])
    merged = lambda f, c: F.array(*(f(F.col(c)[i]) for i in range(width)))
    parts = shuffles(boxes.sparkSession)
    while True:
        below = levels[-1]
        up = below.groupBy("parent").agg(merged(F.min, "low").alias("low"), merged(F.max, "high").alias("high")).select(F.col("parent").alias("node"), F.floor(F.col("parent") / FANOUT).cast("long").alias("parent"), "low", "high")
        levels.append(saved(up, "boxes"))
        if parts <= 1:
            break
        parts = math.ceil(parts / FANOUT)
    pairs = levels.pop().select(F.col("node").alias("a"), F.col("node").alias("b"))  # one interval: the whole sequence
    for level in reversed(levels):
        x = level.select(F.col("parent").alias("a"), F.col("node").alias("x"), F.col("low").alias("xl"), F.col("high").alias("xh"))
        y = level.select(F.col("parent").alias("b"), F.col("node").alias("y"), F.col("low").alias("yl"), F.col("high").alias("yh"))
        gaps = F.transform(F.arrays_zip("xl", "xh", "yl", "yh"), lambda d: F.greatest(d["xl"] - d["yh"], d["yl"] - d["xh"], F.lit(0.0)))
        near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= reach * reach
        pairs = saved(pairs.join(x, "a").join(y, "b").where((F.col("x") <= F.col("y")) & near).select(F.col("x").alias("a"), F.col("y").alias("b")), "pairs")
    return pairs


def vector_join(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Vectors with a cosine of at least `threshold`, whatever else their rows hold.

    Returns one row per vector: (vec_id, n_links, component_id, kept); n_links counts the other
    vectors linked directly, component_id is the least id that links reach.
    """
    given = F.col(vector_col).cast("array<double>")
    stand_in = F.xxhash64(F.col(vector_col)).bitwiseAND(F.lit((1 << 61) - 1)) - F.lit((1 << 63) - 1)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(F.col(id_col).cast("long"), stand_in).alias("vec"), given.alias("v"))
    rows = rows.groupBy("vec").agg(F.first("vec_id").alias("vec_id"), F.min_by("v", F.xxhash64("v")).alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = rows.where(F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    good = good.select("vec", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.reverse("v")).alias("h2"), F.size("v").alias("size"))
    classes = good.groupBy("h1", "h2").agg(F.min("vec").alias("rep"), F.count("*").alias("copies"))
    member = saved(good.select("vec", "h1", "h2", "size").join(classes, ["h1", "h2"]).select("vec", "rep", "copies", "size"), "members")
    # only one vector of each class moves, to where its id is dealt: copies of a common one don't meet
    first = saved(good.select("vec", "v").join(member.where("vec = rep").select("vec", "copies", "size"), "vec"), "vectors")
    reach = math.sqrt(max(2 - 2 * threshold, 0.0)) + 1e-9
    found = None
    for size in sorted(r.size for r in member.select("size").distinct().collect()):
        reps = first.where(F.col("size") == size).select("vec", "copies", "v")
        axes = _axes(reps, size)
        names = [f"c{i}" for i in range(axes.shape[1])]
        placed = reps.mapInArrow(_cells(axes, reach), "vec long, copies long, v array<double>, " + ", ".join(f"{n} int" for n in names))
        order = [*names, F.xxhash64("vec")]
        placed = placed.repartitionByRange(shuffles(member.sparkSession), *order).sortWithinPartitions(*order)
        blocks = saved(placed.select("vec", "copies", "v").mapInArrow(_blocks(axes), "node long, parent long, vecs binary, copies binary, values binary, low array<double>, high array<double>, n long"), "blocks")
        pairs = _near_blocks(blocks, reach)
        side = lambda s: blocks.select(F.col("node").alias(s), *(F.col(x).alias(f"{s}_{x}") for x in ("vecs", "copies", "values")))  # noqa: B023, E731
        joined = pairs.join(side("a"), "a").join(side("b"), "b").repartition(shuffles(member.sparkSession), "a", "b")
        links = joined.mapInArrow(_join(axes, threshold, reach), LINKS)
        found = links if found is None else found.unionByName(links)
    out = rows.select("vec_id", "vec").join(member.select("vec", "rep", "copies"), "vec", "left")
    if found is None:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"), F.lit(True).alias("kept"))
    found = saved(found, "links")
    links = found.groupBy("doc").agg(F.sum("links").alias("links")).withColumnRenamed("doc", "rep")
    parts = components(found.select(F.col("doc").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "rep")
    out = out.join(links, "rep", "left").join(parts, "rep", "left")
    component = F.coalesce("component", "rep", "vec")
    return out.select("vec_id", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), component.alias("component_id"), (component == F.col("vec")).alias("kept"))


def op1_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_inner_product(a.e, a.e) > 0 AND list_inner_product(b.e, b.e) > 0
        AND list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.95),
r AS (SELECT vec_id AS node, vec_id AS reached FROM v UNION SELECT node, b FROM r JOIN e ON reached = a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node),
l AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id = vec_id AS kept FROM v JOIN c ON node = vec_id LEFT JOIN l ON a = vec_id
"""
