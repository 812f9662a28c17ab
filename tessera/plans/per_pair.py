"""Pair summaries from files: one scan reads, checks, counts and sums up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import pairs
from tessera.shared import cut, passing
from tessera.sources import text
from tessera.sources.observed import Watched


@dataclass
class PairSummary:
    """The published columns, and how many files, lines and pairs there were."""

    table: DataFrame
    counts: dict[str, int]


def _summed(watched: Watched, statistics: DataFrame, threshold: float, products: bool) -> PairSummary:
    with passing(statistics.sparkSession) as keep:
        parts = cut(statistics)
        counts = watched.checked()
        table = keep(parts)
    files = len(watched.rows.inputFiles())
    return PairSummary(pairs.summary(table, threshold, products=products), {"files": files, **counts, "pairs": table.count()})


def from_segments(spark: SparkSession, paths: list[str], threshold: float, products: bool = False) -> PairSummary:
    """The summary of segment files; raises for a faulty line with its file."""
    watched = text.watch_segments(spark, paths)
    segments = watched.rows.select("id1", "id2", "length_cm")
    return _summed(watched, pairs.partial(pairs.canonical(segments), threshold), threshold, products)


def from_summaries(spark: SparkSession, paths: list[str], threshold: float, products: bool = False) -> PairSummary:
    """The summary of published summaries, say of chromosomes; raises for a faulty row."""
    watched = text.watch_summaries(spark, paths, threshold)
    return _summed(watched, pairs.merged(pairs.statistics_of(watched.rows, threshold)), threshold, products)
