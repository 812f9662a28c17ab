"""Shared storage, and size checks before a broadcast."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Spark's setting by which the shuffle files of a query are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir, which driver and executors share.  Only a session on one
    machine may lack it, as in tests: it gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the cluster shares")
        found = f"file://{tempfile.gettempdir()}/checkpoints-{spark.sparkContext.applicationId}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


#: What `cut` wrote in each `passing` that is open, the innermost last.
_WRITTEN: list[list[str]] = []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable]:
    """Tables cut in here are deleted at the end, all but those that the tables given to the function it
    yields still read; these belong to the block around this one, if there is any."""
    kept, written = [], []

    def keep(*tables: DataFrame):
        kept.extend(tables)
        return tables[0] if len(tables) == 1 else tables

    _WRITTEN.append(written)
    try:
        yield keep
    finally:
        _WRITTEN.remove(written)
        read = {part for t in kept for file in t.inputFiles() for part in file.split("/") if part.startswith("cut-")}
        for path in written:
            name = path.rpartition("/")[2]
            if name not in read:
                spark.sql(f"DROP TABLE IF EXISTS {name.replace('-', '_')}")
                delete(spark, path)
            elif _WRITTEN:
                _WRITTEN[-1].append(path)


def cut(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows written to the shared folder and read back: iterations don't pile up their plans, lost
    executors lose nothing, and nothing is computed twice.  The write's shuffle files go when it ends,
    the table with the innermost `passing` around it.  by: kept in buckets of these columns, as many as shuffles have
    partitions, so that joins by them don't shuffle the table again."""
    spark = rows.sparkSession
    name = f"cut-{uuid.uuid4().hex}"
    path, before = f"{shared_dir(spark)}/{name}", spark.conf.get(CLEANUP)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    spark.conf.set(CLEANUP, "true")
    try:
        if by:
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            rows.repartition(parts, *by).write.bucketBy(parts, *by).sortBy(*by).option("path", path).saveAsTable(name.replace("-", "_"))
            return spark.table(name.replace("-", "_"))
        rows.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(path)


class Growing:
    """A table in the shared folder that rows are added to and that are never changed; it ends with the innermost `passing`."""

    def __init__(self, rows: DataFrame):
        self.spark, self.schema = rows.sparkSession, rows.schema
        self.path = f"{shared_dir(self.spark)}/cut-{uuid.uuid4().hex}"
        if _WRITTEN:
            _WRITTEN[-1].append(self.path)
        self.add(rows)

    def add(self, rows: DataFrame) -> None:
        rows.select(self.schema.names).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def small(rows: DataFrame, most: int = 200_000) -> DataFrame:
    """Rows marked to be sent to every task if they are counted to be at most so many, else as they are."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def numbered(rows: DataFrame, order: list[Column], group: str | None = None, name: str = "n") -> DataFrame:
    """Rows with their number from 0 in this order, within each group.  Rows are dealt out by ranges of
    (group, order), counted by range, and numbered within them: no group is put in order by one task."""
    keys = [] if group is None else [group]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(rows.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy(*keys, "_part").agg(F.count("*").alias("_count"))
    before = F.sum("_count").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*keys, "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    return dealt.join(F.broadcast(offsets), [*keys, "_part"]).withColumn(name, own - 1 + F.col("_before")).drop("_part", "_before")
