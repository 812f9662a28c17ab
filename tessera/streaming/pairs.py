"""Pair statistics kept up to date as segment batches arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import pairs


def append_statistics(path: str, threshold: float) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: statistics of a batch of canonical segments are written under the
    batch's number, so a repeated batch replaces itself; `current` merges them when read."""

    def write(batch: DataFrame, number: int) -> None:
        pairs.partial(batch, threshold).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def current(spark, path: str) -> DataFrame:
    """Merged statistics of all batches so far."""
    return pairs.merged(spark.read.parquet(path).drop("batch"))


def watch(segments: DataFrame, path: str, checkpoint: str, threshold: float):
    """Start the stream over canonical segments (ID1, ID2, len)."""
    rows = segments.where(F.col("len").isNotNull())
    return rows.writeStream.foreachBatch(append_statistics(path, threshold)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
