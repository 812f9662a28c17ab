import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm.fingerprints import edited_fingerprints, fingerprints, likeness, op11_fingerprints, packed, with_next

BINS, BITS = 256, 8


def chained(parts):
    seed = 42
    for x in parts:
        seed = xxhash.xxh64(x if isinstance(x, bytes) else x[1].to_bytes(x[0], "little"), seed).intdigest()
    return seed


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def expected(text):
    """The printed fingerprint, bin by bin."""
    own = {}
    for s in shingles(text):
        h = chained([(8, chained([w.encode()])) for w in s]) & ((1 << 63) - 1)
        own[h >> 55] = min(own.get(h >> 55, h), h)
    if not own:
        return ""
    full = []
    for i in range(BINS):
        tries = [signed(chained([(4, i), (4, j)])) % BINS for j in range(12)]
        found = next((b for b in [i, *tries] if b in own), None)
        full.append(own[min(own, key=lambda b: signed(chained([(4, i), (4, b), b"order"]))) if found is None else found] & 255)
    return "".join("".join(f"{x:02x}" for x in reversed(full[k : k + 8])) for k in range(0, BINS, 8))


def like(a, b):
    if not a or not b:
        return float(a == b)
    agree = sum(a[i : i + 2] == b[i : i + 2] for i in range(0, 2 * BINS, 2)) / BINS
    return max(0.0, (agree - 1 / 256) / (1 - 1 / 256))


def edited_rows(texts):
    """Brute force over rows (doc_id, text): in the order of ids, null ones first, texts of an id by Spark's hash."""
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64(r[1].encode(), 42).intdigest())))
    prints = {t: expected(t) for _, t in texts}
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other = prints[text], expected(edited)
        yield (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, round(like(own, other), 9), round(like(own, prints[after]), 9))


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "round(near_edited, 9)", "round(near_next, 9)"]


def test_every_document(documents, texts):
    """Nulls, empties, copies, rows of one id, long texts and clashing columns, bin by bin."""
    got = edited_fingerprints(documents).selectExpr(*COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(r) for r in edited_rows([(i, t or "") for i, t in texts]))


def test_given_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()]
    got = op11_fingerprints(spark, "/root/testdata/sf0.001").selectExpr(*COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(r) for r in edited_rows(docs))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    rows = [(5, "one two three four five six"), (2, "seven 中 eight")][:n]
    got = edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr(*COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(r) for r in edited_rows(rows))


def test_order_over_ranges(spark):
    """The row that follows, over more ranges than rows and over one id of many rows."""
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(-5, 30)]), f"t{i}") for i in range(60)] + [(7, f"u{i}") for i in range(40)]
    got = with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), []).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64(r[1].encode(), 42).intdigest())))
    assert sorted(str(tuple(r)) for r in got) == sorted(str((*a, b[1])) for a, b in zip(order, order[1:] + order[:1], strict=True))


def test_estimates(spark):
    """Estimates against true Jaccard likeness: no bias, and errors of the size that so many bins allow; short texts too."""
    rng, rows = random.Random(11), []
    for i in range(300):
        n = rng.choice([6, 15, 40, 200, 900])
        a = [f"w{rng.randrange(5000)}" for _ in range(n)]
        cut = rng.randrange(n)
        rows.append((i, " ".join(a), " ".join(a[:cut] + [f"v{rng.randrange(5000)}" for _ in range(n - cut)])))
    got = spark.createDataFrame(rows, "i long, a string, b string").select("a", "b", likeness(packed(F.col("a")), packed(F.col("b"))).alias("like")).collect()
    errors = [r["like"] - len(shingles(r["a"]) & shingles(r["b"])) / len(shingles(r["a"]) | shingles(r["b"])) for r in got]
    assert abs(sum(errors)) / len(errors) < 0.01 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.035


def test_equal_words(spark):
    rows = fingerprints(spark.createDataFrame([(1, "a  b c"), (2, "a b\nc "), (3, "a b d"), (4, None), (5, " ")], "doc_id long, text string")).collect()
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert prints[1] == prints[2] != prints[3] and prints[4] == prints[5] == ""


def test_no_python_workers(documents):
    plan = edited_fingerprints(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
