"""Ranked lexical search by dense blocked matrix products.

Items are dealt into tiles, each with the compact vocabulary of its own terms.  In one pass over the
documents a task keeps, of each text, its length and the counts of the tile's terms; lengths and
counts of all documents are then summed up.  In a second pass over these, documents are laid out as
dense blocks of impacts (documents by terms), multiplied with the items' weights (terms by items) by
BLAS in double precision.  Weights and impacts are whole numbers, and a block of terms is only as wide
as keeps every partial sum below 2**53, so each product is exact in any order of summation; blocks are
added up in 64-bit integers.  Each task keeps the best documents of each item, all that equal the last of
them included until the order of ids has decided; the best of all tasks are ranked in the end.

Terms are compared by 128 bits of hash.  A null text has no terms.  Rows that repeat an id are documents of
their own; those of a null id come after others of equal score.  Rows that repeat an item's id (a null one
too) are one item with the terms of all of them; an item without terms has no rows.  Empty tables give an
empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, saved, shuffles, table
from .tokens import Words, flat, separators, steps

SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
PATTERN = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Items of a tile, and terms of all its items, about; what a tile has is held in the driver and sent to every task.
ITEMS, PAIRS = 256, 1 << 16
#: Documents and terms of a block.
DOCS, WIDTH = 512, 2048
#: Impacts are below this, as 1000000000 tf div (1000 tf + 8 m) is.
MOST_IMPACT = 1_000_000
EXACT = 1 << 53

COUNTS = "doc long, n long, terms array<int>, counts array<long>"
FOUND = "item int, doc long, score long"


def _words(column: pa.Array) -> Words:
    data, offsets = flat(column)
    upper = (data >= 0x41) & (data <= 0x5A)
    return Words(data + (upper * 32).astype(np.uint8), offsets, separators(SEPARATORS))


def _keys(terms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of the terms, a second hash of each, and where each term is among them."""
    words = Words(*flat(pa.array(terms)), separators(b""))
    first, second = words.hashes(0), words.hashes(1)
    order = np.argsort(first)
    place = np.empty(len(terms), np.int64)
    place[order] = np.arange(len(terms))
    return first[order], second[order], place


def _counted(first: np.ndarray, second: np.ndarray):
    """Of each text (doc, text) its number of terms, and the places and counts of those among the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            words = _words(batch.column("text"))
            hashes = words.hashes(0)
            at = np.minimum(np.searchsorted(first, hashes), len(first) - 1)
            hit = np.flatnonzero(first[at] == hashes)
            hit = hit[words.bytes.hashes(words.starts[hit], words.ends[hit], 1) == second[at[hit]]]
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.off))[hit]
            pair, counts = np.unique(row * len(first) + at[hit], return_counts=True)
            cuts = pa.array(np.searchsorted(pair // len(first), np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in ((pair % len(first)).astype(np.int32), counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(np.diff(words.off).astype(np.int64)), *lists], names=["doc", "n", "terms", "counts"])

    return run


class Best:
    """The best k documents of each item so far, by score, then ascending id; a null id (of its own flag) last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 4  # item, score, whether the id is null, id

    def add(self, scores: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        """scores: documents by items.  Whatever equals the k-th of an item in this block, or the k-th known, may still be among its best."""
        least = self.least
        if len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        row, item = np.nonzero(scores >= least[None, :])
        self.rows = [np.concatenate(x) for x in zip(self.rows, (item, scores[row, item], null[row], doc[row]), strict=True)]
        if len(self.rows[0]) > 4 * self.k * len(self.least):
            self.cut()

    def cut(self) -> None:
        item, score, null, doc = self.rows
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        self.rows = [x[order[rank < self.k]] for x in self.rows]
        full = np.flatnonzero(rank == self.k - 1)
        self.least[item[full]] = score[order[full]]


def _scored(weights: np.ndarray, items: list[np.ndarray], n_docs: int, n_terms: int, k: int):
    """Rows of COUNTS to the best k documents of each item.  items: places of each item's terms among the weights."""
    most = max(1, int(weights.max()))
    width = max(1, min(WIDTH, (EXACT - 1) // (most * MOST_IMPACT)))
    item = np.repeat(np.arange(len(items)), [len(x) for x in items])
    term = np.concatenate(items)

    def tile(lo: int) -> np.ndarray:
        own = np.flatnonzero((term >= lo) & (term < lo + width))
        out = np.zeros((min(width, len(weights) - lo), len(items)))
        out[term[own] - lo, item[own]] = weights[term[own]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, tiles = Best(len(items), k), {}
        for whole in batches:
            for start in range(0, whole.num_rows, DOCS):
                batch = whole.slice(start, DOCS)
                lists = batch.column("terms")
                cuts = lists.offsets.to_numpy()
                terms, counts = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
                row = np.repeat(np.arange(batch.num_rows), np.diff(cuts))
                m = 10 + 90 * batch.column("n").to_numpy() * n_docs // n_terms
                impact = (1_000_000_000 * counts) // (1000 * counts + 8 * m[row])
                scores = np.zeros((batch.num_rows, len(items)), np.int64)
                for lo in range(0, len(weights), width):
                    own = np.flatnonzero((terms >= lo) & (terms < lo + width))
                    if not len(own):
                        continue
                    if lo not in tiles:
                        if len(tiles) * width * len(items) >= 1 << 22:
                            tiles.clear()
                        tiles[lo] = tile(lo)
                    dense = np.zeros((batch.num_rows, len(tiles[lo])))
                    dense[row[own], terms[own] - lo] = impact[own]
                    scores += (dense @ tiles[lo]).astype(np.int64)
                doc = batch.column("doc")
                best.add(scores, doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64), doc.fill_null(0).to_numpy())
        best.cut()
        item, score, null, doc = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(doc, mask=null > 0), pa.array(score)], names=["item", "doc", "score"])

    return run


def _tile(documents: DataFrame, rows: list, k: int) -> DataFrame:
    """The best documents of each task for the items of one tile (rows: item_id, terms): FOUND, item being the place in rows."""
    terms = sorted({t for r in rows for t in r["terms"]})
    at = dict(zip(terms, range(len(terms)), strict=True))
    first, second, place = _keys(terms)
    counted = saved(documents.mapInArrow(_counted(first, second), COUNTS), "counts")
    n_docs, n_terms = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(terms), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    items = [place[[at[t] for t in r["terms"]]] for r in rows]
    found = counted.where("size(terms) > 0").select("doc", "n", "terms", "counts").mapInArrow(_scored(weights, items, n_docs, max(1, n_terms), k), FOUND)
    out = saved(found, "found")
    discard(counted)
    return out


def ranked_search(documents: DataFrame, items: DataFrame, k: int = 10, item_col: str = "item_id", item_text_col: str = "text", id_col: str = "doc_id", text_col: str = "text", most_items: int = ITEMS, most_pairs: int = PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, in the order of score, then id."""
    spark, parts = documents.sparkSession, shuffles(documents.sparkSession)
    docs = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    lower = F.translate(F.col(item_text_col).cast("string"), UPPER, LOWER)
    pairs = saved(items.select(F.col(item_col).alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(PATTERN), 1)).alias("term")).distinct(), "items")
    n_items, n_pairs = pairs.agg(F.countDistinct(F.struct("item_id")), F.count("*")).first()
    tiles = max(-(-n_items // most_items), -(-n_pairs // most_pairs))
    own = pairs.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).withColumn("tile", F.pmod(F.xxhash64("item_id"), F.lit(max(1, tiles))))
    names = items.select(F.col(item_col).alias("item_id")).schema
    found = None
    for i in range(tiles):
        rows = own.where(F.col("tile") == i).orderBy("item_id").collect()
        if rows:
            ids = spark.createDataFrame([(j, r["item_id"]) for j, r in enumerate(rows)], f"item int, item_id {names[0].dataType.simpleString()}")
            one = _tile(docs, rows, k).join(F.broadcast(ids), "item").drop("item")
            found = one if found is None else found.unionByName(one)
    if found is None:
        return pairs.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    # an item's documents meet in several tasks first, as there are k of each task that scored
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    some = found.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(parts)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", F.col("doc").alias("doc_id"), "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents of all."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d),
t AS (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n, unnest(ws) AS term FROM d),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM b) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, n_docs),
x AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS part FROM f JOIN w USING (term), s),
y AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM b JOIN x USING (term) GROUP BY ALL),
z AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS k FROM y WHERE score > 0)
SELECT item_id, CAST(k AS INT) AS rank, doc_id, score FROM z WHERE k <= 10
"""
