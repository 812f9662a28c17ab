"""Web archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: pages are grouped by payload digest to find repeats (digests and ids only move with their
page), then each task packs its pages into archives of about `archive_bytes` of payload in the
shared folder.  An archive counts only if the task that wrote it has ended: its path is a row of
the manifest, so leftovers of failed or repeated attempts are never read.
Reading: tasks take archives from the manifest, load the dictionary, decode frame by frame and
check headers, lengths and digests; a broken record raises an error.

Null payloads are empty.  A page without an id gets a stand-in made from its url and payload.  Pages
that repeat an id are written each; the one of them with the payload meant is a response, or all that
have it.  Other columns are left out, whatever their names.  No pages give no archives.  In the header
of a record, control characters, spaces, percent signs and non-ASCII characters of a URL are percent-
encoded, as no header can hold them all; reading undoes that.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, scratch, shuffles, table

#: Fixed values of the formats: the first bytes of a skippable frame with a dictionary and of a
#: frame, and the profile of a record that repeats an earlier payload.
SKIPPABLE, FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Characters of a URL that are written as they are.
PLAIN = "!#$&'()*+,/:;=?@[]~\"<>\\^`{|}"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def trained_dictionary(samples: list[bytes], size: int = 32 << 10) -> bytes:
    """A dictionary from sample payloads; empty if they are too few or too small to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def head(dictionary: bytes) -> bytes:
    """The leading skippable frame, its dictionary compressed by itself."""
    body = zstandard.ZstdCompressor().compress(dictionary) if dictionary else b""
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def record(page_id: int, url: str, payload: bytes, sha: str, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url, safe=PLAIN)}",
        f"WARC-Payload-Digest: sha1:{sha}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def frame_end(data: memoryview, start: int) -> int:
    """Where the frame that starts here ends, by the lengths of its blocks."""
    parameters = zstandard.get_frame_parameters(data[start : start + 18])
    at = start + zstandard.frame_header_size(data[start : start + 18])
    while True:
        block = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if at > len(data):
            raise ValueError("a frame is cut off")
        if block & 1:
            return at + 4 * parameters.has_checksum


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded records of an archive."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("an archive has no leading dictionary frame")
    body = data[8 : 8 + size]
    if body.startswith(FRAME):
        body = zstandard.ZstdDecompressor().decompress(body)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body)) if body else zstandard.ZstdDecompressor()
    view, at = memoryview(data), 8 + size
    while at < len(data):
        end = frame_end(view, at)
        yield reader.decompress(view[at:end])
        at = end


def fields(text: bytes) -> dict[str, str]:
    out = {}
    for line in text.decode().split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"not a header: {line!r}")
        out[name.lower()] = value.strip()
    return out


def parsed(raw: bytes) -> tuple:
    """A record's row of RECORD; raises ValueError if headers, lengths or the digest don't fit."""
    headers, blank, rest = raw.partition(b"\r\n\r\n")
    version, _, headers = headers.partition(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1") or not blank:
        raise ValueError("not a record")
    headers = fields(headers)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - headers.keys()
    if missing:
        raise ValueError(f"a record lacks {sorted(missing)}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"a record of {length} bytes has {len(rest) - 4}")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    full = int(fields(http.partition(b"\r\n")[2])["content-length"])
    number = lambda name: int(headers[name].removeprefix("<urn:page:").removesuffix(">"))
    kind, sha = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != full or digest(payload) != sha):
        raise ValueError(f"the payload of page {number('warc-record-id')} is not the one announced")
    if kind == "revisit" and payload:
        raise ValueError("a revisit has a payload")
    return number("warc-record-id"), unquote(headers.get("warc-target-uri", "")), kind, number("warc-refers-to") if kind == "revisit" else None, full, sha, payload if kind == "response" else None


def _writer(folder: str, dictionary: bytes, archive_bytes: int, date: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, where = fs.FileSystem.from_uri(folder)
        store.create_dir(where, recursive=True)
        extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        packer = zstandard.ZstdCompressor(level=level, write_checksum=True, **extra)
        context = TaskContext.get()
        state = {"out": None, "path": "", "bytes": 0, "records": 0, "number": 0}

        def close() -> pa.RecordBatch:
            state["out"].close()
            row = pa.RecordBatch.from_arrays([pa.array([state["path"]]), pa.array([state["records"]])], names=["path", "records"])
            state.update(out=None, bytes=0, records=0)
            return row

        for batch in batches:
            for page_id, url, html, response in zip(*(batch.column(x) for x in ("page_id", "url", "html", "response")), strict=True):
                if state["out"] is None:
                    state["number"] += 1
                    state["path"] = f"{where}/{context.partitionId():06d}-{context.taskAttemptId()}-{state['number']:05d}.warc.zst"
                    state["out"] = store.open_output_stream(state["path"])
                    state["out"].write(head(dictionary))
                page_id, payload = page_id.as_py(), (html.as_py() or "").encode()
                refers_to = None if response.as_py() in (None, page_id) else response.as_py()
                state["out"].write(packer.compress(record(page_id, url.as_py() or "", payload, digest(payload), refers_to, date)))
                state["bytes"] += len(payload)
                state["records"] += 1
                if state["bytes"] >= archive_bytes:
                    yield close()
        if state["out"] is not None:
            yield close()

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = 16 << 20, date: str = "1970-01-01T00:00:00Z", level: int = 3, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = 300, sample_bytes: int = 1 << 16) -> DataFrame:
    """Write a record per page; returns the manifest (path, records).

    Of pages with equal payloads of at least `min_bytes` bytes, the one with the largest id is a
    response and the others revisit it.  The dictionary is trained on at most `sample` pages of at most
    `sample_bytes` bytes, the first by a hash; it decides about sizes only.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    stand_in = F.xxhash64(url_col, html).bitwiseAND(F.lit((1 << 61) - 1)) - F.lit((1 << 63) - 1)
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), stand_in).alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("sha"), F.octet_length(html).alias("size"))
    drawn = rows.where(F.col("size").between(1, sample_bytes)).orderBy(F.xxhash64("page_id", "sha"), "page_id", "sha").limit(sample)
    samples = [r.html.encode() for r in drawn.select("html").collect()]
    latest = rows.where(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.max("page_id").alias("response"))
    # digests meet without the pages: those of one common payload don't gather in one task
    response = rows.select("page_id", "sha", "size").distinct().join(latest, ["sha", "size"]).select("page_id", "sha", "response")
    rows = rows.join(response, ["page_id", "sha"], "left").select("page_id", "url", "html", "response")
    return saved(rows.mapInArrow(_writer(folder, trained_dictionary(samples), archive_bytes, date, level), "path string, records long"), "manifest")


def _reader(folder: str, payloads: bool):
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                with store.open_input_stream(path) as f:
                    data = f.read()
                rows, size, seen = [], 0, 0
                for raw in frames(data):
                    row = parsed(raw)
                    rows.append(row if payloads else row[:-1])
                    size, seen = size + len(raw), seen + 1
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=[x.split()[0] for x in RECORD.split(", ")][: len(rows[0])])
                        rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{path} has {seen} records, not {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=[x.split()[0] for x in RECORD.split(", ")][: len(rows[0])])

    return run


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in a manifest; without payloads these are checked but not returned."""
    spread = manifest.repartition(shuffles(manifest.sparkSession), "path")
    return spread.mapInArrow(_reader(folder, payloads), RECORD if payloads else RECORD.rpartition(", ")[0])


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS sha, max(page_id) OVER (PARTITION BY h) AS response FROM p),
b AS (SELECT *, list_aggregate(list_transform(string_split(sha, ''), lambda x: CASE x
        WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011' WHEN '4' THEN '0100' WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111'
        WHEN '8' THEN '1000' WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011' WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110' ELSE '1111' END), 'string_agg', '') AS bits FROM d)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + 16 * CAST(substr(bits, 5 * k + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * k + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * k + 3, 1) AS INT)
         + 2 * CAST(substr(bits, 5 * k + 4, 1) AS INT) + CAST(substr(bits, 5 * k + 5, 1) AS INT) AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM b
"""
