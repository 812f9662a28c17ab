"""Substring deduplication with a log-structured fingerprint index.

A *window* is `size` consecutive words of one document.  A word is removed if a window that covers
it also starts at another place of the corpus.  Not every window is indexed: of the half-window
grams in each window the one with the least hash is its *anchor*, and equal windows have equal
anchors at equal offsets, so windows can only repeat where anchors repeat.  Anchors (about a tenth
of all positions) are kept in a log-structured index:

* every batch of documents becomes an immutable run, bucketed and sorted by anchor hash;
* a batch is merge-joined with the runs before it, bucket by bucket without a shuffle;
* a match is verified by a second, independent hash of all words that any window with that anchor
  can cover; where that wider context differs, the windows themselves are compared;
* runs are merged into one when there are more than `fanout` of them, and the old ones dropped;
* a manifest in the index's folder names its runs, so that a later job opens it and adds to it.

Null and empty texts have no words.  Equal windows are told from others by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete, discard, identified, saved, scratch, shuffles, shuffles_end, table
from .tokens import STEP_BYTES, Grams, Words, flat, separators, steps, winnow

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\v\f\r"
RUN = "h long, c long, n int, doc long, twin long, at int"


def _streams(batch: pa.RecordBatch) -> tuple[Words, Grams, Grams]:
    words = Words(*flat(batch.column("text")), separators(SPACES))
    return words, Grams(words.hashes(0), words.off), Grams(words.hashes(1), words.off)


def anchors(docs: DataFrame, size: int) -> DataFrame:
    """Anchors of documents (doc, twin, text), equal ones of a step of text put together.

    (h, c, n, doc, twin, at): gram hash, context hash, how often in this step, and the first place.  What
    repeats within the step is marked at once: rows with n = 0 are spans of words from `at` to `c`.
    """
    k = size - size // 2
    w = size - k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            _, first, second = _streams(batch)
            grams = first.windows(k)
            at = winnow(grams, first.whole(size), w)
            at = np.unique(at[at >= 0])
            h, c = grams[at], second.context(at, w - 1, k + w - 1)
            row, at = first.row[at], at - first.begin[at]
            order = np.lexsort((at, row, c, h))
            h, c, row, at = h[order], c[order], row[order], at[order]
            new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(new, len(h)))
            again = np.repeat(n > 1, n)
            by = np.lexsort((at[again], row[again]))
            r, lo = row[again][by], np.maximum(at[again][by] - (w - 1), 0)
            hi = at[again][by] + size
            cut = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (lo[1:] > hi[:-1])))) if len(r) else np.zeros(0, np.int64)
            last = np.append(cut[1:], len(r))[: len(cut)] - 1
            r, lo, hi = r[cut], lo[cut], hi[last]
            rows = np.concatenate((row[new], r))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((h[new].view(np.int64), batch.column("doc").to_numpy()[r]))),
                    pa.array(np.concatenate((c[new].view(np.int64), hi))),
                    pa.array(np.concatenate((n, np.zeros(len(r), np.int64))).astype(np.int32)),
                    pa.array(batch.column("doc").to_numpy()[rows]),
                    pa.array(batch.column("twin").to_numpy()[rows]),
                    pa.array(np.concatenate((at[new], lo)).astype(np.int32)),
                ],
                names=["h", "c", "n", "doc", "twin", "at"],
            )

    return docs.select("doc", "twin", "text").mapInArrow(run, RUN)


class FingerprintIndex:
    """Immutable runs of anchors in a shared folder, bucketed and sorted by key (h, c).

    `folder`: of an index to open or to begin.  Its manifest is a new version for each change, the
    last one counts, and runs are deleted only after a version without them is there."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 2, buckets: int | None = None):
        self.spark, self.folder, self.fanout, self.buckets = spark, folder, fanout, buckets or shuffles(spark)
        self.runs: list[tuple[str, str]] = []
        self.version = 0
        manifest = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
        if manifest.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(manifest):
            lines = spark.read.schema("place long, path string, buckets int, version long").json(f"{folder}/manifest").orderBy("place").collect()
            self.version = max(r.version for r in lines)
            for r in lines:
                if r.version == self.version:
                    self.buckets = r.buckets
                    self.runs.append((self._opened(r.path), r.path))

    def _opened(self, path: str) -> str:
        name = f"run_{uuid.uuid4().hex}"
        columns = RUN.replace(" long", " BIGINT").replace(" int", " INT")
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (h, c) SORTED BY (h, c) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    def _publish(self) -> None:
        self.version += 1
        lines = [(i, path, self.buckets) for i, (_, path) in enumerate(self.runs)]
        self.spark.createDataFrame(lines, "place long, path string, buckets int").coalesce(1).write.json(f"{self.folder}/manifest/version={self.version}")

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name, path = f"run_{uuid.uuid4().hex}", f"{self.folder}/run-{uuid.uuid4().hex}"
        with shuffles_end(self.spark):
            rows.write.bucketBy(self.buckets, "h", "c").sortBy("h", "c").option("compression", "zstd").option("path", path).saveAsTable(name)
        return name, path

    def _drop(self, run: tuple[str, str]) -> None:
        name, path = run
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(self.spark, path)

    def destroy(self) -> None:
        """Delete the index and all its runs."""
        for run in self.runs:
            self._drop(run)
        self.runs = []
        delete(self.spark, self.folder)

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for name, _ in self.runs]

    def rows(self) -> DataFrame:
        first, *others = self.tables()
        for other in others:
            first = first.unionByName(other)
        return first

    def ingest(self, fingerprints: DataFrame) -> DataFrame:
        """Add a batch as a run and merge-join it with the runs before it, bucket by bucket.
        Returns the keys (h, c) of the batch that occur more than once in it or before it."""
        older = self.tables()
        self.runs.append(self._write(fingerprints.repartition(self.buckets, "h", "c")))
        self._publish()
        found = self.tables()[-1].where("n > 0").groupBy("h", "c").agg(F.sum("n").alias("n"))
        for i, run in enumerate(older):
            known = run.where("n > 0").select("h", "c").distinct().withColumn(f"in_{i}", F.lit(1))
            found = found.join(known, ["h", "c"], "left")
        return found.where(" or ".join(["n > 1", *(f"in_{i} = 1" for i in range(len(older)))])).select("h", "c")

    def compact(self) -> None:
        """Merge the runs into one if they are more than the fan-out."""
        if len(self.runs) > self.fanout:
            before, self.runs = self.runs, [self._write(self.rows().repartition(self.buckets, "h", "c"))]
            self._publish()
            for run in before:
                self._drop(run)

    def occurrences(self, keys: DataFrame) -> DataFrame:
        """(doc, twin, at) of the index rows with these keys, joined run by run without moving the runs."""
        keys = keys.repartition(self.buckets, "h", "c").dropDuplicates(["h", "c"])
        found = [run.where("n = 1").join(keys, ["h", "c"], "left_semi").select("doc", "twin", "at") for run in self.tables()]
        out = found[0]
        for other in found[1:]:
            out = out.unionByName(other)
        return out

    def mixed(self) -> DataFrame:
        """(doc, twin, at, once) of the first place of each key whose anchor has other contexts as well, saved.
        Keys are dealt out by anchor and a salt of the context, so a frequent anchor isn't one task's."""
        salt = F.pmod(F.xxhash64("c"), F.lit(shuffles(self.spark)))
        rows = self.rows().where("n > 0").withColumn("salt", salt)
        parts = rows.groupBy("h", "salt").agg(F.min("c").alias("least"), F.max("c").alias("most"))
        several = parts.groupBy("h").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least <> most").select("h")
        wanted = saved(parts.select("h", "salt").join(several, "h"), "several")
        keys = rows.join(wanted, ["h", "salt"], "left_semi").groupBy("h", "salt", "c").agg(F.sum("n").alias("n"), F.min(F.struct("doc", "twin", "at")).alias("first"))
        edges = saved(keys.select("first.doc", "first.twin", "first.at", (F.col("n") == 1).cast("int").alias("once")), "edges")
        discard(wanted)
        return edges


def _window_marks(docs: DataFrame, edges: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Windows of the given anchors (doc, twin, at, once) that repeat: (doc, twin, lo, hi).  once: 1 if the
    anchor's context occurs once, so that its own windows are still undecided.  The first of the two
    tables is saved and what the other reads."""
    k = size - size // 2
    w = size - k + 1
    wanted = edges.groupBy("doc", "twin").agg(F.sort_array(F.collect_list(F.col("at") * 2 + F.col("once"))).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            _, first, second = _streams(batch)
            chosen = winnow(first.windows(k), first.whole(size), w)
            lists = batch.column("wanted")
            values = lists.flatten().to_numpy()
            at = values // 2 + np.repeat(first.off[:-1], np.diff(lists.offsets.to_numpy()))
            once = np.full(first.n + 1, -1, dtype=np.int64)
            once[at] = values % 2
            starts = np.flatnonzero((chosen >= 0) & (once[chosen] >= 0))
            doc, twin = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (first.span(starts, starts + size).view(np.int64), second.span(starts, starts + size).view(np.int64), doc[first.row[starts]], twin[first.row[starts]], (starts - first.begin[starts]).astype(np.int32), once[chosen[starts]].astype(np.int32))],
                names=["x", "y", "doc", "twin", "at", "once"],
            )

    windows = docs.join(wanted, ["doc", "twin"])
    windows = saved(windows.select("doc", "twin", "text", "wanted").mapInArrow(run, "x long, y long, doc long, twin long, at int, once int"), "windows")
    # counted with partial sums first: the windows of a passage that many documents share don't meet in one task
    several = windows.groupBy("x", "y").count().where("count > 1").select("x", "y")
    repeated = windows.where("once = 1").join(several, ["x", "y"], "left_semi")
    return windows, repeated.select("doc", "twin", F.col("at").alias("lo"), (F.col("at") + size).alias("hi"))


def substring_dedup(documents: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text", batches: int = 4, index: FingerprintIndex | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """Remove each word that a repeated window of `size` words covers.

    Returns (doc_id, text, n_words, n_removed, kept_sha256): `text` is the kept words joined by one
    space.  Windows are judged on the input.  Documents enter the index in `batches` batches; the
    result doesn't depend on their number.  Repeated rows of a document count as separate texts, and
    so do other texts of its id.  An empty table gives an empty result.

    With an `index` of `earlier` documents (same columns), windows that occur in those are repeated as
    well, and the index is left with both; without, one is made for this call and deleted.
    """
    spark = documents.sparkSession
    docs = identified(documents, id_col, text_col)
    own = index is None
    index = FingerprintIndex(spark, scratch(spark, "index")) if own else index
    found = None
    for i in range(batches):
        part = docs.where(F.pmod(F.xxhash64("doc"), F.lit(batches)) == i)
        keys = saved(index.ingest(anchors(part, size)), "keys")
        found = [keys] if found is None else [*found, keys]
        index.compact()
    every = found[0]
    for keys in found[1:]:
        every = every.unionByName(keys)
    reach = size // 2
    inside = index.occurrences(every).select("doc", "twin", (F.col("at") - reach).alias("lo"), (F.col("at") + size).alias("hi"))
    local = index.rows().where("n = 0").select("doc", "twin", F.col("at").alias("lo"), F.col("c").cast("int").alias("hi"))
    texts = docs if earlier is None else docs.unionByName(identified(earlier, id_col, text_col))
    mixed = index.mixed()
    windows, edges = _window_marks(texts, mixed, size)
    discard(mixed)
    marks = inside.unionByName(local).unionByName(edges)
    marks = marks.groupBy("doc", "twin").agg(F.collect_list(F.shiftleft(F.greatest("lo", F.lit(0)).cast("long"), 32) + F.col("hi")).alias("marks"))
    marks = saved(marks, "marks")
    discard(windows, *found)
    if own:
        index.destroy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP_BYTES):
            words = Words(*flat(batch.column("text")), separators(SPACES))
            lists = batch.column("marks")
            spans = lists.flatten().to_numpy()
            rows = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            delta = np.zeros(len(words.starts) + 1, dtype=np.int64)
            np.add.at(delta, words.off[rows] + (spans >> 32), 1)
            np.add.at(delta, np.minimum(words.off[rows] + (spans & 0xFFFFFFFF), words.off[rows + 1]), -1)
            keep = np.cumsum(delta)[:-1] <= 0
            at = np.flatnonzero(keep)
            bounds = np.searchsorted(at, words.off)
            raw, starts, ends = words.data.tobytes(), words.starts[at].tolist(), words.ends[at].tolist()
            texts = [b" ".join([raw[s:e] for s, e in zip(starts[a:b], ends[a:b], strict=True)]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            n = np.diff(words.off)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x.decode() for x in texts], pa.string()), pa.array(n), pa.array(n - np.diff(bounds)), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())],
                names=["doc_id", "text", "n_words", "n_removed", "kept_sha256"],
            )

    joined = docs.join(marks, ["doc", "twin"], "left").select("doc_id", "text", F.coalesce("marks", F.array().cast("array<long>")).alias("marks"))
    kind = dict(docs.dtypes)["doc_id"]
    return joined.mapInArrow(run, f"doc_id {kind}, text string, n_words long, n_removed long, kept_sha256 string")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("text")


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
s AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 34 <= len(ws) THEN array_to_string(ws[i:i + 34], ' ') END AS win FROM p),
c AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS again FROM s),
m AS (SELECT *, max(CASE WHEN again THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS 34 PRECEDING) IS NOT NULL AS gone FROM c),
g AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id)
"""
