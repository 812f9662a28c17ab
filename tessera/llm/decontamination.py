"""Benchmark decontamination by winnowed fingerprints.

Of the word k-grams in each sliding window the one with the least hash is kept as a fingerprint.
With k = 5 and 9 grams to a window, any 13 words that a document shares with a benchmark item have
a fingerprint in common, so joining fingerprints finds every shared span of 13 words or more.  A
hit is then extended: of the windows of 13 words around it, those with equal hashes (of a second,
independent kind) are shared.  Items of fewer words have one window, looked up by its own hash.

Words are maximal runs of digits, letters and bytes beyond ASCII after lower-casing A-Z.  Null and
empty texts have no words; items without words are never found.  Rows that repeat an id with another
text are judged apart; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identified, saved, table
from .tokens import Grams, Words, flat, mix, separators, steps, winnow


SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Benchmark keys up to this number are sent to every task to drop other fingerprints at once;
#: beyond it, all fingerprints of the documents are shuffled and joined.
MOST_KEYS = 200_000

ROWS = "h long, doc long, twin long, at int, n int, wins array<long>"


def _streams(column: pa.Array) -> tuple[Words, Grams, Grams]:
    data, offsets = flat(column)
    upper = (data >= 0x41) & (data <= 0x5A)
    words = Words(data + (upper * 32).astype(np.uint8), offsets, separators(SEPARATORS))
    return words, Grams(words.hashes(0), words.off), Grams(words.hashes(1), words.off)


def _around(second: Grams, at: np.ndarray, size: int, w: int) -> np.ndarray:
    """Hashes of the w windows of `size` tokens that contain the gram at each place; 0: none there."""
    start = at[:, None] - np.arange(w)[None, :]
    ok = (start >= second.begin[at][:, None]) & (start + size <= second.end[at][:, None])
    start = np.where(ok, start, 0)
    return np.where(ok, second.span(start.ravel(), np.minimum(start.ravel() + size, second.n)).reshape(start.shape), np.uint64(0)).view(np.int64)


def _rows(h: np.ndarray, doc: np.ndarray, twin: np.ndarray, at: np.ndarray, n: np.ndarray, wins: list[np.ndarray]) -> pa.RecordBatch:
    lengths = np.concatenate([np.full(len(x), x.shape[1] if x.ndim > 1 else 1) for x in wins]) if wins else np.zeros(0, np.int64)
    values = np.concatenate([x.ravel() for x in wins]) if wins else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(values.astype(np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc), pa.array(twin), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), lists], names=["h", "doc", "twin", "at", "n", "wins"])


def _fingerprints(size: int, k: int, short: list[int] | None, known: np.ndarray | None, items: bool):
    """Rows of texts (doc, text): a row with n = -1 for each text, whose `at` is its word count, and
    one for each fingerprint.  items: texts shorter than `size` give the hash of all their words."""
    w = size - k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            words, first, second = _streams(batch.column("text"))
            doc, twin = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
            count = np.diff(words.off)
            h, places, n, wins = [np.zeros(len(doc), np.uint64)], [np.zeros(len(doc), np.int64)], [np.full(len(doc), -1)], [np.zeros((len(doc), 1), np.int64)]
            out_row, out_at = [np.arange(len(doc))], [count]

            def put(hashes: np.ndarray, at: np.ndarray, length: int, around) -> None:
                if known is not None:
                    keep = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes if len(known) else np.zeros(len(hashes), bool)
                    hashes, at = hashes[keep], at[keep]
                h.append(hashes)
                out_row.append(first.row[at])
                out_at.append(at - first.begin[at])
                n.append(np.full(len(at), length))
                wins.append(around(at))

            at = winnow(first.windows(k), first.whole(size), w)
            at = np.unique(at[at >= 0])
            put(first.span(at, at + k), at, size, lambda at: _around(second, at, size, w))
            for length in range(1, size) if short is None else short:
                starts = words.off[:-1][count == length] if items else np.flatnonzero(first.whole(length))
                put(mix(first.span(starts, starts + length) + np.uint64(length)), starts, length, lambda at, length=length: second.span(at, at + length)[:, None].view(np.int64))
            row = np.concatenate(out_row)
            yield _rows(np.concatenate(h), doc[row], twin[row], np.concatenate(out_at), np.concatenate(n), wins)

    return run


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of joined fingerprints, the span of words that equal windows cover (one run, as all contain the hit)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n, at = batch.column("n").to_numpy(), batch.column("at").to_numpy()
        lists = batch.column("wins")
        size = np.diff(lists.offsets.to_numpy())
        equal = (lists.flatten().to_numpy() == batch.column("theirs").flatten().to_numpy()) & (lists.flatten().to_numpy() != 0)
        row = np.repeat(np.arange(len(n)), size)
        offset = np.arange(len(row)) - np.repeat(np.concatenate(([0], np.cumsum(size)[:-1])), size)
        row, offset = row[equal], offset[equal]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(batch.column(x).to_numpy()[row]) for x in ("doc", "twin")), pa.array((at[row] - offset).astype(np.int32)), pa.array((at[row] - offset + n[row]).astype(np.int32)), batch.column("item").take(pa.array(row))],
            names=["doc", "twin", "lo", "hi", "item"],
        )


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = 13, k: int = 5, share: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", most_keys: int = MOST_KEYS) -> DataFrame:
    """Words of documents that lie inside a window of a benchmark item, and which items.

    Returns (doc_id, doc, twin, n_words, n_hit, n_items, items_sha256, contaminated, items), a row for
    each of documents; (doc, twin) is its key (see common.identified).  A document is contaminated if it
    has hit words and these are at least one in `share` of its words.
    """
    spark = documents.sparkSession
    docs = identified(documents, id_col, text_col)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.xxhash64(item_col, item_text_col).alias("doc"), F.col(item_text_col).cast("string").alias("text"))
    theirs = saved(items.select("doc", F.lit(0).cast("long").alias("twin"), "text").mapInArrow(_fingerprints(size, k, None, None, True), ROWS).where("n > 0").distinct(), "benchmark")
    theirs = theirs.join(items.select("doc", "item").distinct(), "doc").select("h", F.col("n").alias("n2"), F.col("wins").alias("theirs"), "item")
    short = sorted(r.n2 for r in theirs.select("n2").where(f"n2 < {size}").distinct().collect())
    some = theirs.select("h").distinct().limit(most_keys + 1).toPandas()["h"].to_numpy(np.int64)
    known = np.sort(some.view(np.uint64)) if len(some) <= most_keys else None
    ours = docs.select("doc", "twin", "text").mapInArrow(_fingerprints(size, k, short, known, False), ROWS)
    ours = saved(ours, "fingerprints")
    pairs = ours.where("n > 0").join(theirs, "h").where("n = n2").select("doc", "twin", "at", "n", "wins", "theirs", "item")
    spans = pairs.mapInArrow(_extended, "doc long, twin long, lo int, hi int, item string")
    hits = spans.groupBy("doc", "twin").agg(F.sort_array(F.collect_set("item")).alias("items"), F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    covered = F.aggregate("spans", start, lambda a, s: F.struct(F.greatest(a["end"], s["hi"]).alias("end"), (a["total"] + F.greatest(s["hi"] - F.greatest(a["end"], s["lo"]), F.lit(0))).alias("total")))["total"]
    hits = hits.select("doc", "twin", "items", covered.cast("long").alias("n_hit"))
    counts = ours.where("n = -1").select("doc", "twin", F.col("at").cast("long").alias("n_words")).distinct()
    out = docs.select("doc_id", "doc", "twin").join(counts, ["doc", "twin"]).join(hits, ["doc", "twin"], "left")
    n_hit, found = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "doc", "twin", "n_words", n_hit.alias("n_hit"), F.size(found).cast("long").alias("n_items"), F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"), found.alias("items"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "doc", "twin")


SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
il AS (SELECT item_id, ws, least(13, len(ws)) AS l FROM iw WHERE len(ws) > 0),
ip AS (SELECT item_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM il),
iwin AS (SELECT DISTINCT item_id, l, array_to_string(ws[i:i + l - 1], ' ') AS win FROM ip),
dp AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM dw),
dwin AS (SELECT doc_id, i, l, array_to_string(ws[i:i + l - 1], ' ') AS win FROM dp, (SELECT DISTINCT l FROM iwin) WHERE i + l - 1 <= len(ws)),
m AS (SELECT doc_id, i, dwin.l, item_id FROM dwin JOIN iwin USING (l, win)),
hit AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS w FROM (SELECT DISTINCT doc_id, i, l FROM m)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT dw.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
