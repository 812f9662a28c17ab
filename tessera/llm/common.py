"""Small helpers that the operators of this subpackage share: keys, shared storage, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting by which the shuffle files of a query are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.  Only a session
    on one machine may lack it, as in tests: it gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the cluster shares")
        found = f"file://{tempfile.gettempdir()}/checkpoints-{spark.sparkContext.applicationId}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write in here are deleted when it ends, not when the driver collects garbage.
    What was written is read instead of them; while the write runs, lost files are made again as ever."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def saved(df: DataFrame, what: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, what)
    with shuffles_end(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete what `saved` wrote, once nothing reads it any more."""
    for df in tables:
        delete(df.sparkSession, df._saved_at)


def small(rows: DataFrame, most: int = 200_000) -> DataFrame:
    """Rows marked to be sent to every task if they are counted to be at most so many, else as they are."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key(id_col: str, text_col: str) -> Column:
    """A document's key: its id, or for a null id a value (below -2**62) made from the text."""
    stand_in = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1)) - F.lit((1 << 63) - 1)
    return F.coalesce(F.col(id_col).cast("long"), stand_in)


def identified(documents: DataFrame, id_col: str, text_col: str, others: Sequence[str] = ()) -> DataFrame:
    """(doc_id, doc, twin, text) and the columns in others, a row for each of documents; (doc, twin) stands for the pair of id and text.

    doc is the key; twin is 0, but for ids of several rows a hash of the text, so that rows which
    repeat an id with another text are told apart.  Rows that repeat id and text share both.
    """
    docs = documents.select(*others, F.col(id_col).alias("doc_id"), key(id_col, text_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    again = saved(documents.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc")).count().where("count > 1").select("doc"), "ids")
    if again.isEmpty():
        discard(again)
        # a 0 that isn't a literal: joins and groups by (doc, twin) are then partitioned alike
        out = docs.select(*others, "doc_id", "doc", F.coalesce(F.pmod("doc", F.lit(1)), F.lit(0)).cast("long").alias("twin"), "text")
        out._ids_are_unique = True
        return out
    docs = docs.join(small(again.withColumn("again", F.lit(True))), "doc", "left")
    return docs.select(*others, "doc_id", "doc", F.when(F.col("again"), F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())).otherwise(F.lit(0).cast("long")).alias("twin"), "text")


def one_key(docs: DataFrame) -> DataFrame:
    """Identified rows without twin, told apart by doc alone.  doc is the id for the text with the least twin, and
    for other texts of this id a value over 2**62 made from both."""
    if getattr(docs, "_ids_are_unique", False):
        return docs.drop("twin")
    twins = saved(docs.where("twin <> 0").select("doc", "twin").distinct(), "twins")
    least = twins.groupBy("doc").agg(F.min("twin").alias("least"))
    other = F.xxhash64("doc", "twin").bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    doc = F.when(F.col("twin") != F.coalesce("least", "twin"), other).otherwise(F.col("doc"))
    return docs.join(small(least), "doc", "left").withColumn("doc", doc).drop("twin", "least")


def _with_least(pairs: DataFrame, salts: int) -> DataFrame:
    """(u, v, m): m is the least v of u.  A node's rows are dealt out by salts of v, so hubs don't meet in one task."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)))
    parts = pairs.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"))
    return pairs.join(parts.select("u", "salt").join(least, "u"), ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph by alternating large and small stars.

    edges: two long columns.  Returns (node, component): component is the least node that links
    reach, for every node of an edge that joins two different nodes.  Every round hooks neighbours
    to the least neighbour, so the number of rounds is logarithmic in practice; the edge list is
    written each round and the one before deleted, and no node's neighbours are ever gathered in one
    row or task.
    """
    salts = shuffles(edges.sparkSession)
    pairs = saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        # large star: the larger neighbours of u, and u itself, hook to the least of u and its neighbours
        both = _with_least(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), salts)
        large = both.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # small star: u and its smaller neighbours hook to the least of them
        small = _with_least(large, salts).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, pairs = pairs, saved(small.where("u <> v").distinct(), "edges")
        discard(before)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
