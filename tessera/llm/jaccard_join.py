"""Near-duplicate documents: a Jaccard join on word n-grams by MinHash banding.

1. Each document's distinct 5-word shingles give MinHash values, cut into bands of rows; numbers of
   bands and rows are chosen for a target recall at the threshold.  Documents with equal shingle
   sets are put together first and counted as one from then on.
2. Band hashes are shuffled; documents that share one are candidates, linked in stars to the least
   of them, and candidates' connected components are found.
3. Within a component, pairs whose set sizes allow the threshold are verified on the full sets, in
   blocks: a task gets two blocks of sets and counts common shingles of all their pairs by matrix
   products.  It returns the number of links of each document and a forest of them, never pairs.
4. Components of the forest are the classes.

A text of fewer words than a shingle has one shingle of all its words; a text without words (null,
empty) links with nothing.  Rows that repeat id and text are one document; other texts of an id are
documents of their own.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, discard, identified, one_key, saved, table
from .links import LINKS, link_rows
from .tokens import Grams, Words, flat, mix, separators, steps

SPACES = b" \t\n\v\f\r"
#: Shingles of a block: bounds what a verifying task holds (two blocks).
BLOCK_SHINGLES = 300_000
#: Columns of one matrix product.
COLUMNS = 2048


def bands_for(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, with which this many hash
    functions reach the recall for a pair just at the threshold."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most_hashes:
            return bands, rows
    raise ValueError("the recall can't be reached with so few hashes")


def shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, laid end to end, and their offsets."""
    words = Words(*flat(column), separators(SPACES))
    grams = Grams(words.hashes(0), words.off)
    starts = np.flatnonzero(grams.whole(n))
    rows, hashes = grams.row[starts], grams.span(starts, starts + n)
    count = np.diff(words.off)
    short = np.flatnonzero((count > 0) & (count < n))
    rows = np.concatenate((rows, short))
    hashes = np.concatenate((hashes, grams.span(words.off[short], words.off[short + 1])))
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    if len(rows):
        keep = np.concatenate(([True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])))
        rows, hashes = rows[keep], hashes[keep]
    return hashes, np.searchsorted(rows, np.arange(len(column) + 1))


def _signatures(n: int, bands: int, rows: int):
    salts = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64))
    factors, terms = salts[::2] | np.uint64(1), salts[1::2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            hashes, off = shingles(batch.column("text"), n)
            full = np.flatnonzero(np.diff(off))
            at = off[:-1][full]
            if not len(full):
                continue
            keys = np.empty((len(full), bands), dtype=np.uint64)
            for band in range(bands):
                value = np.full(len(full), band, dtype=np.uint64)
                for i in range(band * rows, (band + 1) * rows):
                    value = mix(value + np.minimum.reduceat(hashes * factors[i] + terms[i], at))
                keys[:, band] = value
            one, two = np.add.reduceat(mix(hashes), at), np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), at)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands).astype(np.int32)), pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("doc").to_numpy()[full]), pa.array(np.diff(off)[full]), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), lists],
                names=["doc", "n", "s1", "s2", "bands"],
            )

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            hashes, off = shingles(batch.column("text"), n)
            values = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in ("doc", "component", "bucket", "copies")] + [values], names=["doc", "component", "bucket", "copies", "items"])

    return run


def _common(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Numbers of common items of all pairs of a set on the left and one on the right."""
    both = np.intersect1d(left[0], right[0])
    out = np.zeros((len(left[1]) - 1, len(right[1]) - 1), dtype=np.float32)
    cells = []
    for items, off in (left, right):
        at = np.searchsorted(both, items)
        at[at == len(both)] = 0
        ok = both[at] == items if len(both) else np.zeros(len(items), bool)
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))[ok]
        order = np.argsort(at[ok], kind="stable")
        cells.append((row[order], at[ok][order]))
    for a in range(0, len(both), COLUMNS):
        sides = []
        for (row, column), height in zip(cells, out.shape, strict=True):
            x, y = np.searchsorted(column, (a, a + COLUMNS))
            side = np.zeros((height, min(COLUMNS, len(both) - a)), dtype=np.float32)
            side[row[x:y], column[x:y] - a] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _verify(threshold: float):
    def side(batch: pa.RecordBatch, name: str, i: int):
        members = batch.column(name)[i].values
        items = members.field("items")
        off = items.offsets.to_numpy()
        return members.field("doc").to_numpy(), members.field("copies").to_numpy(), (items.flatten().to_numpy(), off - off[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_a, copies_a, a = side(batch, "a", i)
                same = batch.column("same")[i].as_py()
                doc_b, copies_b, b = (doc_a, copies_a, a) if same else side(batch, "b", i)
                common = _common(a, b).astype(np.float64)
                union = np.diff(a[1])[:, None] + np.diff(b[1])[None, :] - common
                link = common + 1e-9 >= threshold * union
                if same:
                    np.fill_diagonal(link, False)
                yield link_rows(link, doc_a, copies_a, doc_b, copies_b, same)

    return run


def jaccard_join(documents: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with at least `threshold` of their n-word shingles in common.

    Returns one row per document: (doc_id, doc, class_id, n_links, kept).  doc is the key (common.key,
    common.one_key), the id as a rule.  n_links counts the other documents linked directly, class_id is
    the least key that links reach, kept is true for that one.
    """
    bands, rows = bands_for(threshold, recall)
    docs = one_key(identified(documents, id_col, text_col)).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = docs.select("doc", "text").mapInArrow(_signatures(n, bands, rows), "doc long, n long, s1 long, s2 long, bands array<long>")
    signed = saved(signed, "signatures").dropDuplicates(["doc"])
    sets = signed.groupBy("s1", "s2").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"))
    member = saved(signed.select("doc", "s1", "s2").join(sets, ["s1", "s2"]).select("doc", "rep", "copies"), "members")
    reps = member.where("doc = rep").select("doc", "copies")

    banded = signed.join(reps, "doc").select("doc", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("doc").alias("least"), F.count("*").alias("size")).where("size > 1")
    stars = banded.join(least, "band").where("doc <> least").select(F.col("doc").alias("a"), F.col("least").alias("b"))
    candidates = components(stars).withColumnRenamed("node", "doc")

    bucket = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9).cast("long")
    candidates = signed.join(reps, "doc").join(candidates, "doc").select("doc", "component", "copies", "n", bucket.alias("bucket"))
    candidates = saved(candidates, "candidates")
    # the candidates grow with the corpus: texts are shuffled to them at every size, never broadcast
    texts = docs.select("doc", "text").join(candidates.select("doc", "component", "copies", "bucket").hint("merge"), "doc").dropDuplicates(["doc"])
    full = texts.mapInArrow(_sets(n), "doc long, component long, bucket long, copies long, items array<long>")
    # a pair's sizes differ by the threshold at most, so it lies in one size bucket or two neighbours
    sizes = candidates.groupBy("component", "bucket").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"), F.count("*").alias("docs"))
    upper = sizes.select("component", (F.col("bucket") - 1).alias("bucket"), F.lit(True).alias("upper"))
    lower = sizes.select("component", (F.col("bucket") + 1).alias("bucket"), F.col("blocks").alias("lower"))
    plan = saved(sizes.join(upper, ["component", "bucket"], "left").join(lower, ["component", "bucket"], "left").where("docs > 1 or upper or lower is not null"), "blocks")
    blocks = full.join(plan.select("component", "bucket", "blocks"), ["component", "bucket"])
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    blocks = blocks.groupBy("component", "bucket", "block").agg(F.collect_list(F.struct("doc", "copies", "items")).alias("members"))
    blocks = saved(blocks, "sets")
    inside = plan.select("component", "bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), "blocks").select("component", F.col("bucket").alias("bi"), "i", F.col("bucket").alias("bj"), F.explode(F.sequence("i", F.col("blocks") - 1)).alias("j"))
    across = plan.where("lower is not null").select("component", F.col("bucket").alias("bi"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), (F.col("bucket") - 1).alias("bj"), "lower").select("component", "bi", "i", "bj", F.explode(F.sequence(F.lit(0), F.col("lower") - 1)).alias("j"))
    work = inside.unionByName(across)
    left = blocks.select("component", F.col("bucket").alias("bi"), F.col("block").alias("i"), F.col("members").alias("a"))
    right = blocks.select("component", F.col("bucket").alias("bj"), F.col("block").alias("j"), F.col("members").alias("b"))
    same = (F.col("bi") == F.col("bj")) & (F.col("i") == F.col("j"))
    alone = work.where(same).join(left, ["component", "bi", "i"]).select("a", F.array().cast(dict(left.dtypes)["a"]).alias("b"), F.lit(True).alias("same"))
    pairs = work.where(~same).join(left, ["component", "bi", "i"]).join(right, ["component", "bj", "j"]).select("a", "b", F.lit(False).alias("same"))
    found = saved(alone.unionByName(pairs).mapInArrow(_verify(threshold), LINKS), "links")

    links = found.groupBy("doc").agg(F.sum("links").alias("links")).withColumnRenamed("doc", "rep")
    classes = components(found.select(F.col("doc").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "rep")
    out = docs.select("doc_id", "doc").dropDuplicates(["doc"]).join(member, "doc", "left").join(links, "rep", "left").join(classes, "rep", "left")
    class_id = F.coalesce("component", "rep", "doc")
    n_links = F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))
    return out.select("doc_id", "doc", class_id.alias("class_id"), n_links.alias("n_links"), (class_id == F.col("doc")).alias("kept"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("doc")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * common >= 4 * (x.n + y.n - common)),
r AS (SELECT doc_id AS node, doc_id AS reached FROM documents UNION SELECT node, b FROM r JOIN e ON reached = a),
c AS (SELECT node, min(reached) AS class_id FROM r GROUP BY node),
l AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, class_id = doc_id AS kept FROM documents JOIN c ON node = doc_id LEFT JOIN l ON a = doc_id
"""
