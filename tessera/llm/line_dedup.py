"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

A line that isn't blank is dropped if an earlier line (by document id, then line number) equals it,
or if both have at least `min_chars` characters and are within `max_edits` edits.  Cut into
max_edits + 1 segments, a line within max_edits edits of another contains one of its segments
unchanged, and only at a few shifts, given both lengths.  So each distinct line is indexed by its
segments (with number and length), and probes the substrings that could be segments of a line of its
length or up to max_edits shorter.  Keys that only one line has are dropped; lines that share a key
are compared by the banded edit distance that is built in, those of a frequent key in blocks that go
to different tasks.

Blank lines (of white space) always stay.  A null text has no lines and stays null, an empty one has
one blank line.  Equal lines are found by 128 bits of hash; near ones are compared as text.  Rows that
repeat an id with another text are documents of their own, after each other by a hash of the text;
rows that repeat id and text are one document, and all lose the same lines.  An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, identified, saved, table

#: Lines of a frequent key that one task compares with as many others.
BLOCK = 4000


def _entries(lines: DataFrame, max_edits: int) -> DataFrame:
    """(h1, k, role): hashed keys of lines (h1, line, size): their segments, by which they are found as well as find lines of
    their length (role 3), and the other substrings by which they find lines (role 2).  Which segment of how much
    shorter a line, at which shift, is exploded first, so that the key is one short expression."""
    parts = max_edits + 1
    places = [(i, shorter, shift) for shorter in range(max_edits + 1) for i in range(parts) for shift in range(max(-i, shorter - (max_edits - i)), min(i, shorter + (max_edits - i)) + 1)]
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(shorter).alias("shorter"), F.lit(shift).alias("shift")) for i, shorter, shift in places)))
    rows = lines.select("h1", "line", "size", each.alias("e")).select("h1", "line", "size", "e.i", "e.shift", "e.shorter", (F.col("size") - F.col("e.shorter")).alias("other"))
    edge = lambda i: F.floor(F.col("other") * i / parts).cast("int")
    rows = rows.withColumn("at", edge(F.col("i")) + F.col("shift")).withColumn("n", edge(F.col("i") + 1) - edge(F.col("i"))).where("at >= 0 and at + n <= size")
    # of a line of one byte a character, a substring is found without counting characters; its hash is the same
    part = F.when(F.octet_length("line") == F.col("size"), F.substring(F.col("line").cast("binary"), F.col("at") + 1, F.col("n"))).otherwise(F.substring("line", F.col("at") + 1, F.col("n")).cast("binary"))
    return rows.select("h1", F.xxhash64("i", "other", part).alias("k"), F.when((F.col("shorter") == 0) & (F.col("shift") == 0), 3).otherwise(2).alias("role"))


def line_dedup(documents: DataFrame, max_edits: int = 2, min_chars: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the lines that repeat or nearly repeat an earlier line.

    Returns the columns of documents, `text` being the kept lines joined by line feeds, and n_lines
    and n_removed (which replace columns with these names).
    """
    others = [c for c in documents.columns if c not in (text_col, "n_lines", "n_removed")]
    docs = documents.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(others)), F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    docs = identified(docs, "_id", "_text", [f"c{i}" for i in range(len(others))])
    lines = docs.select("doc", "twin", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).where(F.col("line").rlike(r"\S"))
    lines = lines.select(F.struct("doc", "twin", "pos").alias("place"), "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.reverse("line")).alias("h2"))
    # only lines that can be near another travel as text
    whole = F.when(F.char_length("line") >= min_chars, F.col("line"))
    distinct = lines.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.count("*").alias("n"), F.first(whole).alias("line"))
    distinct = saved(distinct.withColumn("size", F.char_length("line")), "lines")
    long = distinct.where("line is not null")

    entries = _entries(long, max_edits)
    by_key = W.partitionBy("k")
    shared = entries.withColumn("low", F.min("h1").over(by_key)).withColumn("high", F.max("h1").over(by_key))
    shared = shared.withColumn("mine", F.sum((F.col("role") == 3).cast("long")).over(by_key)).withColumn("theirs", F.count("*").over(by_key))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    shared = shared.where("low <> high and mine > 0").select("k", "h1", "role", blocks("mine").alias("m"), blocks("theirs").alias("t")).distinct()
    shared = saved(shared, "keys")

    # a frequent key's own lines and probes are cut into blocks, and each block meets every other one; keys are not broadcast
    # while they are few: the plan, and so the disk it takes for its input, is the same at every size
    sides = shared.hint("merge").join(long.select("h1", "h2", "place", "line", "size"), "h1")
    block = lambda n: F.pmod(F.xxhash64("h1"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = sides.where("role = 3").select("*", block("m").alias("i"), each("t").alias("j")).alias("a")
    b = sides.select("*", block("t").alias("j"), each("m").alias("i")).alias("b")
    near = (F.col("a.h1") != F.col("b.h1")) & (F.abs(F.col("a.size") - F.col("b.size")) <= max_edits)
    near &= F.levenshtein("a.line", "b.line", max_edits) >= 0
    same = (F.col("a.k") == F.col("b.k")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
    links = a.join(b, same & near).select(F.when(F.col("a.place") < F.col("b.place"), F.struct("b.h1", "b.h2")).otherwise(F.struct("a.h1", "a.h2")).alias("later"))
    gone = links.select("later.h1", "later.h2").distinct().withColumn("near", F.lit(True))

    rule = saved(distinct.select("h1", "h2", "place", "n").join(gone, ["h1", "h2"], "left").where("n > 1 or near").select("h1", "h2", F.col("place").alias("first"), "near"), "rule")
    discard(shared, distinct)
    removed = lines.select("h1", "h2", "place").join(rule, ["h1", "h2"]).where("near or place <> first")
    removed = removed.groupBy("place.doc", "place.twin").agg(F.collect_set("place.pos").alias("removed"))
    # not broadcast while it is small, as above
    joined = docs.join(removed.hint("merge"), ["doc", "twin"], "left").withColumn("lines", F.split("text", "\n", -1))
    # positions left are a difference of sets, so a text of many lines takes time in proportion to them
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    some = F.get(F.transform(F.array("lines"), lambda lines: F.transform(left, lambda i: F.get(lines, i))), F.lit(0))
    kept = F.when(F.col("removed").isNull(), F.col("lines")).otherwise(some)
    names = {c: F.col(f"c{i}") for i, c in enumerate(others)} | {text_col: F.array_join(kept, "\n")}
    return joined.select(
        *(names[c].alias(c) for c in documents.columns if c in names),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many of them go, and a digest of the kept text."""
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
o AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d),
l AS (SELECT doc_id, i, ls[i] AS line, regexp_matches(ls[i], '[^\x20\x09-\x0D]') AS counts FROM o),
f AS (SELECT line, length(line) AS n, min({'d': doc_id, 'i': i}) AS place FROM l WHERE counts GROUP BY line),
near AS (SELECT DISTINCT b.line FROM f a JOIN f b ON a.n >= 12 AND b.n >= 12 AND a.n BETWEEN b.n - 2 AND b.n + 2 AND a.place < b.place WHERE levenshtein(a.line, b.line) <= 2),
m AS (SELECT l.*, counts AND (near.line IS NOT NULL OR f.place <> {'d': doc_id, 'i': i}) AS gone FROM l LEFT JOIN f USING (line) LEFT JOIN near USING (line)),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept FROM m GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN g USING (doc_id)
"""
