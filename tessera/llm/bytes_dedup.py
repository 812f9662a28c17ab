"""Exact substring deduplication over bytes with sharded suffix arrays.

A byte is removed if it is covered by a string of `size` bytes that also starts in a document with
a smaller id.  Equal strings have to meet in one suffix array, so the corpus is dealt to shards by
content: each string of `size` bytes has an anchor (the half-size gram with the least hash), equal
strings have equal anchors at equal offsets, and a shard holds all anchors of its hash range.

1. Every batch of texts sends its anchors, packed by shard, with a hash of the widest context that
   strings with this anchor can cover, and only the batch's smallest document of each such context.
   Packed rows are columns of numbers, each as wide as its largest needs: some 15 bytes an anchor.
2. A shard marks contexts that a smaller document has.  Anchors that repeat with other contexts ask
   for their context's bytes.
3. The bytes are fetched and dealt out by anchor; each shard builds suffix arrays by induced sorting
   and reads repeated strings off the permuted longest common prefixes.
4. All marks of a document meet its text and the bytes go.  The texts are shuffled once for both.

An anchor with very many different contexts (a passage that a large part of all documents share)
would make one shard large; its strings are dealt out one by one by their own hash instead, after
each batch has kept the smallest document of equal ones.  That is exact as well.
Null texts are empty.  Matches never cross documents; a document never matches itself.  Rows that
repeat an id are never smaller than each other, whatever their texts; a null id is smaller than others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identified, saved, shuffles, table
from .suffix_arrays import common_prefixes, suffix_array
from .tokens import ByteGrams, Bytes, flat, gather, steps, winnow

#: Contexts of one anchor that may share a suffix array; those of a more frequent one go by string.
MOST_CONTEXTS = 2000
#: Bytes of one suffix array.
ARRAY_BYTES = 1 << 19
#: Bytes of text that one step holds as arrays; anchors, and bytes of pieces, that a task packs at a time.
STEP, PACK, PACK_BYTES = 1 << 18, 400_000, 8 << 20

PACKED = "shard int, n int, data binary"
FOUND = "doc long, twin long, x long"
MARKS = "doc long, twin long, spans array<long>"
#: What a shard finds about an anchor: its context is a copy; its bytes are wanted; wanted string by string.
COPY, WANTED, BY_STRING = 0, 1, 2


def _narrow(x: np.ndarray) -> bytes:
    """64-bit numbers, all as wide as the largest needs; the width comes first."""
    x = np.ascontiguousarray(x).view(np.uint64)
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """The n numbers that start here, and where they end."""
    width = data[at]
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 1).reshape(n, width)
    return out.ravel().view(np.uint64), at + 1 + n * width


def _packed(columns: list[np.ndarray], doc: np.ndarray) -> bytes:
    """Columns and ascending document keys, which go as differences."""
    return b"".join([*map(_narrow, columns), doc[:1].tobytes(), _narrow(np.diff(doc.view(np.uint64)))])


def _unpacked(data: bytes, n: int, columns: int) -> tuple[list[np.ndarray], np.ndarray, int]:
    out, at = [], 0
    for _ in range(columns):
        x, at = _wide(data, at, n)
        out.append(x)
    start = np.frombuffer(data, np.uint64, 1, at)
    steps_, at = _wide(data, at + 8, n - 1)
    return out, np.cumsum(np.concatenate((start, steps_)), dtype=np.uint64).view(np.int64), at


def _least(groups: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by groups and document; group number of each ordered row, and its least document."""
    order = np.lexsort((doc, *groups[::-1]))
    differs = np.zeros(len(order), dtype=bool)
    differs[:1] = True
    for g in groups:
        g = g[order]
        differs[1:] |= g[1:] != g[:-1]
    number = np.cumsum(differs) - 1
    return order, number, doc[order][np.flatnonzero(differs)]


def _rows(shard: np.ndarray, columns: list[np.ndarray], doc: np.ndarray, pieces: np.ndarray | None = None, raw: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of PACKED, one for each shard; pieces (sizes) and raw: bytes that go with each entry."""
    order = np.lexsort((doc, shard))
    shard, columns, doc = shard[order], [c[order] for c in columns], doc[order]
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))).tolist()
    if pieces is not None:
        raw = raw[gather((np.cumsum(pieces) - pieces)[order], pieces[order])]
        ends = np.concatenate(([0], np.cumsum(pieces[order]))).tolist()
    stops = [*cuts[1:], len(shard)]
    data = [_packed([c[a:b] for c in columns], doc[a:b]) + (b"" if raw is None else raw[ends[a] : ends[b]].tobytes()) for a, b in zip(cuts, stops, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(shard[cuts].astype(np.int32)), pa.array(np.diff([*cuts, len(shard)]).astype(np.int32)), pa.array(data, pa.binary())], names=["shard", "n", "data"])


def _places(doc: np.ndarray, twin: np.ndarray, at: np.ndarray, kind: int) -> pa.RecordBatch:
    order = np.lexsort((at, doc))
    return pa.RecordBatch.from_arrays([pa.array(doc[order]), pa.array(twin[order]), pa.array(at[order].astype(np.int64) * 4 + kind)], names=["doc", "twin", "x"])


def _anchors(size: int, shards: int):
    """Columns of a packed row: 32 bits of the anchor's hash (others choose the shard), context, twin,
    place.  Copies of a context within the pack go as rows of shard -1 - s: they only pass through."""
    k = size - size // 2
    w = size - k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def pack() -> Iterator[pa.RecordBatch]:
            h, c, doc, twin, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            parts.clear()
            if not len(h):
                return
            order, number, least = _least((h, c), doc)
            first = doc[order] == least[number]
            own, gone = order[first], order[~first]
            yield _rows((h[own] >> np.uint64(32)) % np.uint64(shards), [h[own] & np.uint64(0xFFFFFFFF), c[own], twin[own].view(np.uint64), at[own].astype(np.uint64)], doc[own])
            if len(gone):
                yield _rows(np.full(len(gone), -1 - int(h[gone[0]] >> np.uint64(1)) % shards), [twin[gone].view(np.uint64), at[gone].astype(np.uint64)], doc[gone])

        for batch in steps(batches, "text", STEP):
            data, offsets = flat(batch.column("text"))
            grams = ByteGrams(data, offsets)
            h = grams.windows(k)
            at = winnow(h, grams.whole(size), w)
            at = np.unique(at[at >= 0])
            row = grams.row[at]
            parts.append((h[at], ByteGrams(data, offsets, 1).context(at, w - 1, k + w - 1), batch.column("doc").to_numpy()[row], batch.column("twin").to_numpy()[row], (at - grams.begin[at]).astype(np.int32)))
            if sum(len(x[0]) for x in parts) >= PACK:
                yield from pack()
        if parts:
            yield from pack()

    return run


def _shard(most_contexts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for shard, n, data in zip(*(batch.column(x) for x in ("shard", "n", "data")), strict=True):
                shard, n, data = shard.as_py(), n.as_py(), data.as_py()
                if shard < 0:
                    (twin, at), doc, _ = _unpacked(data, n, 2)
                    yield _places(doc, twin.view(np.int64), at, COPY)
                else:
                    (h, c, twin, at), doc, _ = _unpacked(data, n, 4)
                    parts.append((h | np.uint64(shard << 32), c, doc, twin.view(np.int64), at.astype(np.int32)))
        if not parts:
            return
        h, c, doc, twin, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order, number, least = _least((h, c), doc)
        h, doc, twin, at = h[order], doc[order], twin[order], at[order]
        first = doc == least[number]
        if not first.all():
            yield _places(doc[~first], twin[~first], at[~first], COPY)
        new = np.concatenate(([True], h[1:] != h[:-1]))
        group = np.cumsum(new) - 1
        contexts = np.bincount(group[np.concatenate(([True], number[1:] != number[:-1]))])
        low, high = np.minimum.reduceat(doc, np.flatnonzero(new)), np.maximum.reduceat(np.where(first, doc, np.iinfo(np.int64).min), np.flatnonzero(new))
        wanted = (contexts > 1) & (low < high)
        for kind, some in ((WANTED, wanted & (contexts <= most_contexts)), (BY_STRING, wanted & (contexts > most_contexts))):
            if (pick := first & some[group]).any():
                yield _places(doc[pick], twin[pick], at[pick], kind)

    return run


def _pieces(size: int, shards: int):
    """Wanted contexts as packed rows (anchor, twin, place, size and bytes), and strings of the most
    frequent anchors as rows of shard -1 - s (two hashes, twin, place, whether a smaller document of the pack has it)."""
    k = size - size // 2
    w = size - k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def pack() -> pa.RecordBatch:
            h, doc, twin, at, n, raw = (np.concatenate(x) for x in zip(*parts, strict=True))
            parts.clear()
            return _rows(h % np.uint64(shards), [h, twin.view(np.uint64), at.astype(np.uint64), n.astype(np.uint64)], doc, n, raw)

        for batch in steps(batches, "text", STEP):
            data, offsets = flat(batch.column("text"))
            found = batch.column("found")
            x = found.flatten().to_numpy()
            rows = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            kind = x & 3
            rows, at, kind = rows[kind > 0], offsets[rows[kind > 0]] + (x[kind > 0] >> 2), kind[kind > 0]
            docs, twins = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
            lo, hi = np.maximum(at - (w - 1), offsets[rows]), np.minimum(at + k + w - 1, offsets[rows + 1])
            a = kind == WANTED
            if a.any():
                h = Bytes(data).hashes(at[a], at[a] + k, 0)
                parts.append((h, docs[rows[a]], twins[rows[a]], (lo - offsets[rows])[a], (hi - lo)[a], data[gather(lo[a], (hi - lo)[a])]))
                if sum(len(p[5]) for p in parts) >= PACK_BYTES:
                    yield pack()
            b = np.flatnonzero(kind == BY_STRING)
            if len(b):
                count = hi[b] - size + 1 - lo[b]
                row, start = np.repeat(rows[b], count), gather(lo[b], count)
                x, y = (ByteGrams(data, offsets, lane).span(start, start + size) for lane in (0, 1))
                order, number, least = _least((x, y), docs[row])
                again = np.zeros(len(order), dtype=np.uint64)
                again[order] = docs[row][order] > least[number]  # a smaller document of this step has it
                yield _rows(-1 - (x >> np.uint64(1)).astype(np.int64) % shards, [x, y, twins[row].view(np.uint64), (start - offsets[row]).astype(np.uint64), again], docs[row])
        if parts:
            yield pack()

    return run


def _array_marks(raw: np.ndarray, lengths: np.ndarray, shard: np.ndarray, doc: np.ndarray, at: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number, start) of every string of these pieces that a smaller document has, by suffix arrays."""
    order = np.argsort(shard, kind="stable")
    begins, lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
    ends = np.cumsum(lengths + 1)
    new = np.concatenate(([True], shard[order][1:] != shard[order][:-1]))
    starts = np.flatnonzero(new)
    block = (ends[starts] - 1) // ARRAY_BYTES
    cuts = [*starts[np.concatenate(([True], block[1:] != block[:-1]))].tolist(), len(order)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = order[a:b]
        joined = raw[gather(begins[a:b], lengths[a:b])]
        n, stops = lengths[a:b], np.cumsum(lengths[a:b] + 1) - 1
        s = np.ones(len(joined) + len(own) + 1, dtype=np.int32)
        s[-1] = 0
        inside = np.ones(len(s), dtype=bool)
        inside[stops] = inside[-1] = False
        s[inside] = joined.astype(np.int32) + 2
        stop = np.append(np.repeat(stops, n + 1), len(s) - 1)
        number = np.append(np.repeat(np.arange(len(own)), n + 1), 0)
        sa = suffix_array(s)
        prefix = common_prefixes(s, sa, stop)[sa]
        run = np.cumsum(prefix < size)
        owner = doc[own][number[sa]]
        first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        whole = np.where(stop[sa] - sa >= size, owner, np.iinfo(np.int64).max)
        least = np.minimum.reduceat(whole, first)
        hit = np.flatnonzero((np.repeat(least, np.diff(np.append(first, len(run)))) < owner) & (stop[sa] - sa >= size))
        i = number[sa[hit]]
        yield own[i], at[own][i] + sa[hit] - (stops - n)[i]


def _spans(doc: np.ndarray, twin: np.ndarray, start: np.ndarray, size: int) -> pa.RecordBatch:
    """Merge the strings at these places into spans, one row for each document."""
    order = np.lexsort((start, twin, doc))
    doc, twin, start = doc[order], twin[order], start[order].astype(np.int64)
    other = np.concatenate(([True], (doc[1:] != doc[:-1]) | (twin[1:] != twin[:-1]))) if len(doc) else np.zeros(0, bool)
    new = np.flatnonzero(other | np.concatenate(([True], start[1:] > start[:-1] + size))) if len(doc) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(doc))[: len(new)] - 1
    rows = np.flatnonzero(other[new])
    spans = pa.ListArray.from_arrays(pa.array(np.append(rows, len(new)).astype(np.int32)), pa.array((start[new] << 32) | (start[last] + size), pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(doc[new][rows]), pa.array(twin[new][rows]), spans], names=["doc", "twin", "spans"])


def _sorted_shard(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, strings = [], []
        for batch in batches:
            for shard, n, data in zip(*(batch.column(x) for x in ("shard", "n", "data")), strict=True):
                data, n = data.as_py(), n.as_py()
                if shard.as_py() >= 0:
                    (h, twin, at, lengths), doc, end = _unpacked(data, n, 4)
                    pieces.append((h, doc, twin.view(np.int64), at.astype(np.int64), lengths.astype(np.int64), np.frombuffer(data, np.uint8, offset=end)))
                else:
                    (x, y, twin, at, again), doc, _ = _unpacked(data, n, 5)
                    strings.append((x, y, doc, twin.view(np.int64), at.astype(np.int64), again > 0))
        docs, twins, starts = [], [], []
        if pieces:
            h, doc, twin, at, lengths, raw = (np.concatenate(x) for x in zip(*pieces, strict=True))
            pieces.clear()
            for i, s in _array_marks(raw, lengths, h, doc, at, size):
                docs.append(doc[i])
                twins.append(twin[i])
                starts.append(s)
        if strings:
            x, y, doc, twin, at, again = (np.concatenate(x) for x in zip(*strings, strict=True))
            strings.clear()
            order, number, least = _least((x, y), doc)
            again[order] |= doc[order] > least[number]
            docs.append(doc[again])
            twins.append(twin[again])
            starts.append(at[again])
        if docs:
            yield _spans(np.concatenate(docs), np.concatenate(twins), np.concatenate(starts), size)

    return run


def bytes_dedup(documents: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text", most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """Remove each byte that a string of `size` bytes covers which also starts in a document with
    a smaller id.  Returns (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): `kept` is the
    remaining bytes, not always valid UTF-8.  An empty table gives an empty result.
    """
    docs = identified(documents, id_col, text_col)
    shards = 4 * shuffles(documents.sparkSession)  # a shard is sorted in memory, so it is smaller than a shuffle partition
    packed = docs.select("doc", "twin", "text").mapInArrow(_anchors(size, shards), PACKED)
    found = saved(packed.repartition(shards, "shard").mapInArrow(_shard(most_contexts), FOUND), "found")
    found = found.groupBy("doc", "twin").agg(F.collect_list("x").alias("found"))
    # both uses of these rows read one shuffle of the texts, so both take all columns
    marked = docs.join(found.hint("merge"), ["doc", "twin"], "left")
    wanted = marked.where(F.exists("found", lambda x: x.bitwiseAND(F.lit(3)) > 0)).select("doc_id", "doc", "twin", "text", "found")
    strings = wanted.mapInArrow(_pieces(size, shards), PACKED).repartition(shards, "shard").mapInArrow(_sorted_shard(size), MARKS)
    strings = strings.groupBy("doc", "twin").agg(F.flatten(F.collect_list("spans")).alias("strings"))
    reach = size // 2
    none = F.array().cast("array<long>")
    copies = F.transform(F.filter("found", lambda x: x.bitwiseAND(F.lit(3)) == COPY), lambda x: F.shiftleft(F.greatest(F.shiftright(x, 2) - reach, F.lit(0).cast("long")), 32) + F.shiftright(x, 2) + size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            data, offsets = flat(batch.column("text"))
            lists = batch.column("marks")
            spans = lists.flatten().to_numpy()
            rows = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            delta = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(delta, offsets[rows] + (spans >> 32), 1)
            np.add.at(delta, np.minimum(offsets[rows] + (spans & 0xFFFFFFFF), offsets[rows + 1]), -1)
            gone = np.cumsum(delta)[:-1] > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = offsets[:-1][offsets[:-1] < len(data)]
            begins[inner] = gone[inner]
            total, count = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(begins)))
            kept, left = data[~gone].tobytes(), (offsets - total[offsets]).tolist()
            texts = [kept[a:b] for a, b in zip(left[:-1], left[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(total[offsets])), pa.array(np.diff(count[offsets])), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()), pa.array(texts, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    joined = marked.join(strings.hint("merge"), ["doc", "twin"], "left").select("doc_id", "text", F.concat(F.coalesce(copies, none), F.coalesce("strings", none)).alias("marks"))
    return joined.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytes_dedup(table(spark, sf_dir, "documents")).drop("kept")


SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (SELECT doc_id, x, n, unnest(range(1, n + 1)) AS i FROM b),
s AS (SELECT doc_id, i, substr(x, 2 * i - 1, 2) AS byte, CASE WHEN i + 49 <= n THEN md5(substr(x, 2 * i - 1, 100)) END AS str FROM p),
c AS (SELECT *, str IS NOT NULL AND min(doc_id) OVER (PARTITION BY str) < doc_id AS again FROM s),
m AS (SELECT *, max(CASE WHEN again THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS 49 PRECEDING) IS NOT NULL AS gone FROM c),
l AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM m),
g AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
             coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), '') AS kept FROM l GROUP BY doc_id)
SELECT b.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM b LEFT JOIN g USING (doc_id)
"""
