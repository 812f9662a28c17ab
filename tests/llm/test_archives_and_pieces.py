import base64
import hashlib

import pytest

from tessera.llm import pieces, warc
from tessera.llm.common import scratch


@pytest.mark.parametrize("min_bytes", [0, 8])
def test_round_trip(spark, min_bytes):
    pages = [(i, f"http://a/{i}", f"<html>page {i % 7} ü</html>" * (i % 7 + 1)) for i in range(40)] + [(50, None, None), (51, "u", ""), (52, "u", "tiny"), (53, "u", "tiny"), (54, "u", "x" * 300_000)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    folder = scratch(spark, "warc")
    manifest = warc.write_archives(table, folder, min_bytes=min_bytes, archive_bytes=500)
    assert manifest.count() > 3
    latest = {}
    for i, _, h in pages:
        latest[h or ""] = max(latest.get(h or "", i), i)
    want = {}
    for i, u, h in pages:
        raw, to = (h or "").encode(), latest[h or ""]
        first = to == i or len(raw) < min_bytes
        want[i] = (u or "", "response" if first else "revisit", None if first else to, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), raw if first else None)
    got = {r["page_id"]: (r["url"] or "", r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], None if r["payload"] is None else bytes(r["payload"])) for r in warc.read_archives(manifest, folder).collect()}
    assert got == want


def test_odd_pages(spark):
    """URLs with line breaks, headers, blanks and percent signs, repeated ids, clashing columns, long pages."""
    urls = ["http://a/\r\nWARC-Type: revisit", "x y\tz", "http://ü/%0D%0A", "", None, "\x00\x7f\u2028", "a?b=c&d=%41"]
    rows = [(i, u, f"page {i}", 5) for i, u in enumerate(urls)] + [(3, "again", "page 3", 5), (4, "other", "page four", 5), (90, "long", "y" * 3_000_000, 5)]
    folder = scratch(spark, "warc")
    got = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string, response int"), folder), folder)
    assert sorted((r["page_id"], r["url"] or "", bytes(r["payload"]).decode()) for r in got.collect()) == sorted((i, u or "", h) for i, u, h, _ in rows)
    assert {r["record_type"] for r in got.collect()} == {"response"}


def test_faults_are_found():
    sha = warc.digest(b"abc")
    good = warc.record(1, "u", b"abc", sha, None, "1970-01-01T00:00:00Z")
    assert warc.parsed(good)[0] == 1
    for bad in (good.replace(b"abc\r", b"abd\r"), good[:-1], good.replace(b"WARC-Date", b"X-Date"), good.replace(b"WARC/1.1", b"WARC/9"), good + b"x"):
        with pytest.raises(ValueError):
            warc.parsed(bad)
    with pytest.raises(ValueError):
        list(warc.frames(b"\x00" * 16))
    import zstandard

    archive = warc.head(b"") + zstandard.ZstdCompressor().compress(good) + zstandard.ZstdCompressor().compress(good)
    assert list(warc.frames(archive)) == [good, good]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.frames(archive[:-5]))


def test_no_pages(spark):
    folder = scratch(spark, "warc")
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder), folder).count() == 0


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def reference_model():
    """The library's lattice over the same pieces and scores, as a unigram model."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(open(pieces.MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def test_library_ids(model, texts):
    """Ids of whole texts are the library's, on the given documents, odd texts and random strings of short pieces."""
    import random

    import pyarrow.parquet as pq
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(2)
    odd = ["".join(rng.choice(["a", "th", "e", "in", "▁", " ", "é", "日", "\n", "\t", "0", "1", "ing", "x", "🎉", "."]) for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    odd += ["x" * 700, "a" * 333, "aaab" * 50, "in" * 100, " ", "  a  b  ", "the " * 300]
    own = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist() + [t for _, t in texts] + [t for t in odd if "▁" not in t]
    ids, off = pieces.encode(model, own)
    want = library.encode([t or "" for t in own], num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == want


def test_memory_of_units(model, texts, monkeypatch):
    """Batches that share a memory, also one that is emptied, give what single batches give."""
    monkeypatch.setattr(pieces, "MOST_UNITS", 40)
    memory, own = pieces.Memory(), [t for _, t in texts]
    for k in range(0, len(own), 7):
        ids, off = pieces.encode(model, own[k : k + 7], memory)
        alone, alone_off = pieces.encode(model, own[k : k + 7])
        assert ids.tolist() == alone.tolist() and off.tolist() == alone_off.tolist()


def test_best_segmentation(reference_model, texts):
    """Of a unigram model."""
    model = pieces.load(merges=False)
    words = sorted({w for _, t in texts if t for w in t.split() if len(w) < 40})
    ids, off = pieces.encode(model, words)
    for i, w in enumerate(words):
        best = reference_model.nbest_encode(w, 1)[0]
        own = ids[off[i] : off[i + 1]].tolist()
        score = lambda x: sum(reference_model.get_score(k) for k in x)
        assert own == best or score(own) == pytest.approx(score(best)), w


def test_decoding(model):
    texts = ["", None, "a", "Hello  world", " a b ", "日本\n語 x\t", "ﬁne 🎉", "   ", "\x00\x01", "é" * 50, "word " * 500, "x" * 3000]
    ids, off = pieces.encode(model, texts)
    assert pieces.decode(model, ids, off) == [t or "" for t in texts]
    assert (off[1:] - off[:-1])[[0, 1]].tolist() == [0, 0]


def test_batches_agree(model):
    texts = ["one two three", "two", "three one"]
    ids, off = pieces.encode(model, texts)
    for i, t in enumerate(texts):
        assert pieces.encode(model, [t])[0].tolist() == ids[off[i] : off[i + 1]].tolist()


def test_no_documents_to_encode(spark):
    assert pieces.with_tokens(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tokens_of_documents(documents):
    out = pieces.with_tokens(documents.withColumnRenamed("removed", "tokens"))
    assert set(documents.columns) - {"removed"} <= set(out.columns)
    assert out.where("not round_trip or n_tokens <> size(tokens)").count() == 0 and out.count() == documents.count()
