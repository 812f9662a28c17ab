"""Document fingerprints by one-permutation MinHash with optimal densification, in DataFrame functions only.

Shingles of five words are hashed once; the upper bits of a hash choose one of BINS bins, and each bin keeps
its least hash.  Bins without a shingle take that of another bin: bin i asks bins in a random order of its own
(the same for every document) until one isn't empty.  Of each bin the low BITS bits are kept, packed into long
integers, and printed as hexadecimal digits.  Two fingerprints agree in a bin by chance once in 2**BITS bins,
for which their likeness is corrected; it estimates the Jaccard likeness of the sets of shingles.

Everything of a text happens inside one row, so no shingle is shuffled: hashes are sorted, and the first
of each bin is its least.  A task takes about a hundred bytes for each word of the text at hand.

A text of one to four words is one shingle, a text without words (null too) has an empty fingerprint; two
empty fingerprints are alike (1), an empty one is unlike any other (0).  Fingerprints depend on words and their
order only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, saved, shuffles, table

WORDS = 5
#: Bins of a fingerprint, bits kept of each; a power of two each, and at least 64 bits together.
BINS, BITS = 256, 8
#: Bins that an empty one asks by calculation; after that, the first in its whole order.
TRIES = 12
#: Bytes of text in a range of documents.
RANGE_BYTES = 32 << 20
SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value calculated once however often it is read."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _shingles(text: Column) -> Column:
    """Hashes of the shingles of a text, non-negative."""
    words = F.array_remove(F.split(text, SPACE), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        last = F.size(h) - WORDS
        each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(WORDS))).bitwiseAND(F.lit((1 << 63) - 1)))
        return F.when(F.size(h) > 0, each).otherwise(F.array().cast("array<bigint>"))

    return _let(hashes, grams)


def _bin(h: Column, bins: int) -> Column:
    return F.shiftright(h, 63 - (bins.bit_length() - 1)).cast("int")


def _least(hashes: Column, bins: int) -> Column:
    """(bin, hash) of the least hash of each bin that has any."""
    def first(s: Column) -> Column:
        return F.transform(F.filter(s, lambda h, i: (i == 0) | (_bin(h, bins) != _bin(F.get(s, i - 1), bins))), lambda h: F.struct(_bin(h, bins).alias("bin"), h.alias("hash")))

    return _let(F.sort_array(hashes), first)


def _dense(least: Column, bins: int) -> Column:
    """A hash for each bin: its own, or that of the first bin in its order which has one."""
    asked = lambda i, j: F.pmod(F.xxhash64(i, F.lit(j)), F.lit(bins)).cast("int")

    def fill(own: Column) -> Column:
        def of(i: Column) -> Column:
            order = F.transform(F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.get(own, b).isNotNull()), lambda b: F.struct(F.xxhash64(i, b, F.lit("order")), F.get(own, b).alias("hash")))
            return F.coalesce(F.get(own, i), *(F.get(own, asked(i, j)) for j in range(TRIES)), F.array_min(order)["hash"])

        return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), of)

    def spread(some: Column) -> Column:
        at = F.transform(some, lambda x: x["bin"])
        return _let(at, lambda a: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.get(some, F.array_position(a, i).cast("int") - 1)["hash"]))

    return _let(least, lambda some: F.when(F.size(some) == bins, F.transform(some, lambda x: x["hash"])).when(F.size(some) > 0, _let(spread(some), fill)))


def packed(text: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The fingerprint of a text as long integers, 64 // bits bins in each; without words an empty array."""
    each = 64 // bits

    def pack(full: Column) -> Column:
        low = lambda i, j: F.shiftleft(F.get(full, i * each + j).bitwiseAND(F.lit((1 << bits) - 1)), bits * j)
        return F.when(full.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(bins // each - 1)), lambda i: reduce(Column.bitwiseOR, (low(i, j) for j in range(each)))))

    full = _dense(_least(_shingles(F.coalesce(text, F.lit(""))), bins), bins)
    return F.coalesce(_let(full, pack), F.array().cast("array<bigint>"))


def printed(fingerprint: Column) -> Column:
    """Sixteen hexadecimal digits for each long integer."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The estimated Jaccard likeness, 0 to 1, of the texts of two packed fingerprints."""
    ones = F.lit(sum(1 << (bits * j) for j in range(64 // bits)))

    def other(p: Column, q: Column) -> Column:
        """Of two long integers, the number of fields that differ: all bits of a field are gathered in its lowest."""
        x, shift = p.bitwiseXOR(q), bits // 2
        while shift:
            x, shift = x.bitwiseOR(F.shiftrightunsigned(x, shift)), shift // 2
        return F.bit_count(x.bitwiseAND(ones))

    differ = F.aggregate(F.zip_with(a, b, other), F.lit(0), lambda n, x: n + x)
    chance = 1.0 / (1 << bits)
    agree = (F.lit(bins) - differ) / F.lit(float(bins))
    found = F.greatest(F.lit(0.0), (agree - chance) / (1.0 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(found)


def with_next(documents: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents (id_col, text_col, columns) with next_<column> of the row that follows: by ascending id, null ids
    first, rows of equal id by a hash of the text; after the last row comes the first.

    Rows are dealt into ranges of that order by bytes of text, each range gets the first row of the next one
    besides, and rows meet those that follow inside their range.
    """
    spark = documents.sparkSession
    order = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    keys = saved(documents.select(order.alias("o"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes")), "order")
    parts = max(shuffles(spark), -(-(keys.agg(F.sum("bytes")).first()[0] or 0) // RANGE_BYTES))
    # a row for each range: its first key
    firsts = sorted(r["o"] for r in keys.repartitionByRange(parts, "o").groupBy(F.spark_partition_id()).agg(F.min("o").alias("o")).select(
        F.struct(F.col("o.id").isNotNull().alias("some"), F.coalesce("o.id", F.lit(0)).cast("long").alias("id"), F.col("o.h").alias("h")).alias("o")).collect())
    discard(keys)
    if not firsts:
        firsts = [(False, 0, 0)]
    own = F.struct(F.col(id_col).isNotNull().alias("some"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(text_col).alias("h"))
    bounds = spark.createDataFrame([([tuple(x) for x in firsts],)], "bounds array<struct<some:boolean,id:long,h:long>>")
    rows = documents.withColumn("_own", own).join(F.broadcast(bounds))  # one row
    # by halving: how many ranges begin at or before this row, less one
    steps, at = len(firsts).bit_length(), F.lit(0)
    for j in reversed(range(steps)):
        there = F.get("bounds", at + (1 << j))
        at = at + F.when(there <= F.col("_own"), 1 << j).otherwise(0)
        rows = rows.withColumn("_range", at)
        at = F.col("_range")
    rows = rows if steps else rows.withColumn("_range", F.lit(0))
    leads = F.get("bounds", F.col("_range")) == F.col("_own")
    before = F.pmod(F.col("_range") - 1, F.lit(len(firsts)))
    rows = rows.withColumn("_to", F.explode(F.when(leads, F.array(F.struct(F.col("_range").alias("range"), F.lit(0).alias("edge")), F.struct(before.alias("range"), F.lit(1).alias("edge")))).otherwise(F.array(F.struct(F.col("_range").alias("range"), F.lit(0).alias("edge"))))))
    rows = rows.select(id_col, text_col, *columns, "_own", F.col("_to.range").alias("_range"), F.col("_to.edge").alias("_edge"))
    following = Window.partitionBy("_range").orderBy("_edge", "_own")
    rows = rows.repartitionById(len(firsts), F.col("_range"))
    return rows.select(id_col, text_col, *columns, "_edge", *(F.lead(c).over(following).alias(f"next_{c}") for c in dict.fromkeys([text_col, *columns]))).where("_edge = 0").drop("_edge")


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, fingerprint, packed): of each document."""
    out = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("packed", packed(F.col("text")))
    return out.withColumn("fingerprint", printed(F.col("packed")))


def edited_fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against itself with its second half replaced by the start of the next document, and against that one.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).  Rows that
    repeat an id are documents of their own, ordered by a hash of the text; a single document follows itself.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = with_next(docs.withColumn("packed", packed(F.col("text"))), ["packed"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    docs = docs.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    docs = docs.withColumn("edited_packed", packed(F.col("edited")))
    return docs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("packed")).alias("fingerprint"), printed(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"), likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how like they are."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
