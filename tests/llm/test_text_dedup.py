import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tessera.llm import line_dedup as module
from tessera.llm.bytes_dedup import bytes_dedup
from tessera.llm.common import scratch
from tessera.llm.line_dedup import line_dedup
from tessera.llm.substring_dedup import FingerprintIndex, anchors, substring_dedup


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected_words(texts, size):
    lists = [words_of(t) for _, t in texts]
    seen = Counter(tuple(ws[i : i + size]) for ws in lists for i in range(len(ws) - size + 1))
    out = []
    for (doc, _), ws in zip(texts, lists, strict=True):
        gone = set()
        for i in range(len(ws) - size + 1):
            if seen[tuple(ws[i : i + size])] > 1:
                gone |= set(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((doc, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "batches"), [(35, 2), (8, 1), (7, 3)])
def test_repeated_windows(documents, texts, size, batches):
    got = substring_dedup(documents, size, batches=batches).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == expected_words(texts, size)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup(none).count() == 0
    assert bytes_dedup(none).count() == 0
    assert line_dedup(none).count() == 0


def test_index_of_batches(spark, documents):
    """A batch's repeats are found against runs before it, and merging runs changes nothing."""
    docs = documents.where("doc_id between 4 and 39").selectExpr("doc_id as doc", "0L as twin", "text")
    index = FingerprintIndex(spark, scratch(spark, "index"), fanout=1)
    first = index.ingest(anchors(docs.where("doc < 20"), 35)).count()
    second = {tuple(r) for r in index.ingest(anchors(docs.where("doc >= 20"), 35)).collect()}
    assert first > 0 and len(index.runs) == 2
    keys = {tuple(r) for r in index.rows().where("n > 0").groupBy("h", "c").sum("n").where("`sum(n)` > 1").select("h", "c").collect()}
    assert second <= keys
    before = sorted(map(tuple, index.mixed().collect()))
    index.compact()
    assert len(index.runs) == 1
    assert sorted(map(tuple, index.mixed().collect())) == before


def test_ids_of_several_texts(spark):
    """Rows of an id with other texts are texts of their own; an old id alone doesn't move marks to them."""
    passage, own = " ".join(f"p{i}" for i in range(50)), " ".join(f"o{i}" for i in range(45))
    rows = [(1, f"{own} {passage}"), (1, "short"), (2, passage), (None, passage), (2, own + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in substring_dedup(docs).collect())
    assert got == sorted([("1", 95, 95), ("1", 1, 0), ("2", 50, 50), ("None", 50, 50), ("2", 46, 45)])
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"] > 0) for r in bytes_dedup(docs).collect()) == sorted(
        [("1", len(rows[0][1]), True), ("1", 5, False), ("2", len(passage), True), ("None", len(passage), False), ("2", len(own) + 2, True)])
    lines = [(1, "first line of the text\nsecond line of it"), (1, "third line of the text"), (2, "third line of the text\nfirst line of the text"), (2, "a line that stays")]
    got = {(r["doc_id"], r["text"]) for r in line_dedup(spark.createDataFrame(lines, "doc_id long, text string")).collect()}
    assert got == {(1, lines[0][1]), (1, lines[1][1]), (2, ""), (2, lines[3][1])}


def test_second_job_adds_to_an_index(spark, documents):
    """Documents added to the opened index of a first job get what one job over all gives them."""
    docs = documents.where("doc_id between 4 and 40").select("doc_id", "text").dropDuplicates(["doc_id"]).cache()
    old, new = docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 > 0")
    folder = scratch(spark, "index")
    substring_dedup(old, index=FingerprintIndex(spark, folder), batches=3).count()
    opened = FingerprintIndex(spark, folder)
    assert 0 < len(opened.runs) <= 2
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    got = sorted(map(tuple, substring_dedup(new, index=opened, earlier=old, batches=2).select(columns).collect()))
    want = sorted(map(tuple, substring_dedup(docs).where("doc_id % 3 > 0").select(columns).collect()))
    assert got == want and sum(r[2] for r in got) > 0
    opened.destroy()


def expected_bytes(texts, size):
    first = {}
    for doc, t in texts:
        raw = (t or "").encode()
        for i in range(len(raw) - size + 1):
            s = raw[i : i + size]
            first[s] = min(first.get(s, doc), doc)
    out = []
    for doc, t in texts:
        raw, gone = (t or "").encode(), set()
        for i in range(len(raw) - size + 1):
            if first[raw[i : i + size]] < doc:
                gone |= set(range(i, i + size))
        spans = sum(1 for i in gone if i - 1 not in gone)
        kept = bytes(b for i, b in enumerate(raw) if i not in gone)
        out.append((doc, len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "most_contexts"), [(50, 2000), (50, 2), (9, 3)])
def test_repeated_bytes(documents, texts, size, most_contexts):
    some = [(d, t) for d, t in texts if d is not None]
    got = bytes_dedup(documents.where("doc_id is not null"), size, most_contexts=most_contexts).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == expected_bytes(some, size)


def distance(a, b, most):
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_near_lines(spark, most):
    import random

    rng = random.Random(most)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(10, 40))) for _ in range(12)]
    rows = []
    for doc in range(40):
        lines = []
        for _ in range(4):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.randrange(2)] = rng.choice(["", "x", "y"])
            lines.append("".join(line))
        rows.append((doc, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "short\n\n"), (103, "short\n\n")]
    firsts = {}
    for doc, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            if line.strip() and line not in firsts:
                firsts[line] = (doc, i)
    groups = defaultdict(list)
    for line in firsts:
        if len(line) >= 12:
            groups[len(line)].append(line)
    near = {line for line, place in firsts.items() if len(line) >= 12 for n in range(len(line) - most, len(line) + most + 1) for other in groups[n] if firsts[other] < place and distance(line, other, most) <= most}
    want = []
    for doc, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for i, x in enumerate(lines) if not x.strip() or (x not in near and firsts[x] == (doc, i))]
        want.append((doc, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup(docs, most).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_lines_keep_other_columns(documents):
    out = line_dedup(documents)
    assert out.columns == [*documents.columns, "n_lines", "n_removed"]
    assert out.count() == documents.count()


def test_anchors_depend_on_the_window_alone():
    """Equal windows choose equal offsets, alone or inside any stream, also if grams agree in all but their lowest bits."""
    import numpy as np

    from tessera.llm.tokens import winnow

    rng = np.random.default_rng(3)
    for w in range(1, 12):
        own = (np.uint64(1 << 40) + rng.integers(0, 4, w).astype(np.uint64))
        alone = winnow(own, np.ones(w, bool), w)[0]
        assert alone == max(i for i in range(w) if own[i] == own.min())
        for n in (w, 3 * w + 1, 5000):
            at = int(rng.integers(0, n - w + 1))
            stream = np.uint64(1 << 40) + rng.integers(0, 4, n).astype(np.uint64)
            stream[at : at + w] = own
            assert winnow(stream, np.arange(n) + w <= n, w)[at] - at == alone


def test_long_text_of_equal_lines(spark):
    """The time for one document of equal lines grows with their number."""
    import time

    took = []
    for n in (40_000, 320_000):
        docs = spark.createDataFrame([(1, "\n".join(["a repeated line of some length"] * n))], "doc_id long, text string")
        began = time.perf_counter()
        row = line_dedup(docs).collect()[0]
        took.append(time.perf_counter() - began)
        assert (row["n_lines"], row["n_removed"], row["text"]) == (n, n - 1, "a repeated line of some length")
    assert took[1] < 12 * took[0] + 10


def test_line_dedup_plan_is_the_same_at_every_size(spark):
    """Documents meet the lines they lose by a sorted join, also where these are few enough to broadcast."""
    out = line_dedup(spark.createDataFrame([(1, "one line of text\nother"), (2, "one line of text")], "doc_id long, text string"))
    assert sorted(r["n_removed"] for r in out.collect()) == [0, 1]
    assert re.search(r"SortMergeJoin[^\n]*LeftOuter", out._jdf.queryExecution().executedPlan().toString())


def test_keys_meet_their_lines_by_the_same_plan_at_every_size(spark, monkeypatch):
    """A table of keys that is just small enough to broadcast saved a shuffle of all lines, which a larger one doesn't."""
    plans, saved = {}, module.saved
    monkeypatch.setattr(module, "saved", lambda df, what: (plans.update({what: df._jdf.queryExecution().executedPlan().toString()}), saved(df, what))[1])
    docs = spark.createDataFrame([(1, "one line of some text\nother"), (2, "one line of sume text")], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in line_dedup(docs).collect()) == [0, 1]
    joins = re.findall(r"(\w+Join) \[h1#\d+L\], \[h1#\d+L\], Inner", plans["rule"])
    assert joins and set(joins) == {"SortMergeJoin"}
