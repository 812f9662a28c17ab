"""Readers of the pipeline's text tables.  gzip is read by suffix; faults raise with their place."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shared import numbered
from tessera.functions.text import bare_chromosome, finite, parse_count, parse_float, threshold_names
from tessera.operators import pairs
from tessera.sources.observed import Watched


def per_chromosome(pattern: str, chromosomes: list[str]) -> dict[str, str]:
    """Paths of a pattern with {chr}, by chromosome."""
    if "{chr}" not in pattern:
        raise ValueError("the pattern has no {chr}")
    return {c: pattern.replace("{chr}", c) for c in chromosomes}


SEGMENT_FAULTS = ["field_count", "empty_id", "self_pair", "not_a_number", "not_finite", "negative"]
SUMMARY_FAULTS = ["empty_id", "self_pair", "not_a_number", "not_finite", "negative", "no_segments", "threshold_count", "min_above_max", "threshold_length"]


def _segment_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"), F.rtrim(F.regexp_replace("value", "\r$", "")).alias("value"))
    return lines.where("value <> ''").withColumn("f", F.split("value", "\t", -1))


def _segments(rows: DataFrame) -> DataFrame:
    get = lambda i: F.get("f", F.lit(i))
    return rows.select(
        get(0).alias("id1"), parse_count(get(1)).cast("int").alias("hap1"), get(2).alias("id2"), parse_count(get(3)).cast("int").alias("hap2"), get(4).alias("chrom"),
        parse_count(get(5)).alias("start"), parse_count(get(6)).alias("end"), parse_float(get(7)).alias("length_cm"), "file",
    )


def read_segments(spark: SparkSession, paths: list[str], check: bool = True) -> DataFrame:
    """Headerless segment files: (id1, hap1, id2, hap2, chrom, start, end, length_cm, file).

    Blank lines are skipped, fields split at tabs; ids and length are checked, the others are not.
    """
    rows = _segment_lines(spark, paths)
    if check:
        pairs.first_error(rows, pairs.segment_errors(F.col("f")), "file", "line")
    return _segments(rows)


def watch_segments(spark: SparkSession, paths: list[str]) -> Watched:
    """read_segments whose faults are found while its rows are used."""
    watched = Watched(_segment_lines(spark, paths), pairs.segment_errors(F.col("f")), SEGMENT_FAULTS, "file", "line", "value")
    watched.rows = _segments(watched.rows)
    return watched


def _table(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.csv(paths, sep="\t", header=True, escape='"', quote='"', enforceSchema=False)


def _need(table: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in table.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")


def _summaries(spark: SparkSession, paths: str | list[str], threshold: float) -> DataFrame:
    n_ge, total_ge = threshold_names(threshold)
    counts = ["number_of_IBD_segments", n_ge]
    floats = ["total_IBD_length_cM", "sum_squared_IBD_length_cM", "min_IBD_length_cM", "max_IBD_length_cM", total_ge]
    table = _table(spark, paths)
    _need(table, ["ID1", "ID2", *counts, *floats], "a pair summary")
    return table.select("ID1", "ID2", *(parse_count(F.col(c)).alias(c) for c in counts), *(parse_float(F.col(c)).alias(c) for c in floats))


def read_summaries(spark: SparkSession, paths: str | list[str], threshold: float) -> DataFrame:
    """Published pair summaries as numbers, checked."""
    rows = _summaries(spark, paths, threshold)
    pairs.first_error(rows, pairs.summary_errors(threshold), "ID1", "ID2")
    return rows


def watch_summaries(spark: SparkSession, paths: str | list[str], threshold: float) -> Watched:
    """read_summaries whose faults are found while its rows are used."""
    return Watched(_summaries(spark, paths, threshold), pairs.summary_errors(threshold), SUMMARY_FAULTS, "ID1", "ID2")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """(idx, id) in the file's order; ids are trimmed, blank lines skipped; none or a repeat is an error."""
    lines = spark.read.text(path, wholetext=False).select(F.monotonically_increasing_id().alias("idx"), F.trim("value").alias("id")).where("id <> ''")
    if lines.isEmpty():
        raise ValueError("there are no samples")
    if (row := lines.groupBy("id").count().where("count > 1").first()) is not None:
        raise ValueError(f"sample {row['id']} occurs {row['count']} times")
    return lines


def read_edges(spark: SparkSession, paths: str | list[str], weight: str) -> DataFrame:
    """(src, dst, weight) from a pair summary with the chosen column; weights are finite and not negative."""
    table = _table(spark, paths)
    _need(table, ["ID1", "ID2", weight], "a pair summary")
    rows = table.select(F.col("ID1").alias("src"), F.col("ID2").alias("dst"), parse_float(F.col(weight)).alias("weight"))
    error = F.when(F.col("src") == F.col("dst"), "self_loop").when(F.col("weight").isNull(), "not_a_number").when(~finite(F.col("weight")), "not_finite").when(F.col("weight") < 0, "negative")
    pairs.first_error(rows, error, "src", "dst")
    return rows


def read_membership(spark: SparkSession, path: str, cluster: str) -> DataFrame:
    """All columns of a membership table plus (id, cluster): the id column is ID, else the first."""
    table = _table(spark, path)
    _need(table, [cluster], "a membership table")
    rows = table.withColumns({"id": F.col("ID" if "ID" in table.columns else table.columns[0]), "cluster": F.col(cluster)})
    error = F.when(F.coalesce("id", F.lit("")) == "", "empty_id").when(F.coalesce("cluster", F.lit("")) == "", "empty_cluster")
    pairs.first_error(rows, error, "id")
    if (row := rows.groupBy("id").count().where("count > 1").first()) is not None:
        raise ValueError(f"id {row['id']} occurs {row['count']} times")
    return rows


def read_genotyped(spark: SparkSession, path: str) -> DataFrame:
    """(id) of a genotype sample table with IID or #IID."""
    table = _table(spark, path)
    name = next((c for c in ("#IID", "IID") if c in table.columns), None)
    if name is None:
        raise ValueError("a sample table has neither #IID nor IID")
    rows = table.select(F.col(name).alias("id"))
    if (row := rows.groupBy("id").count().where("count > 1").first()) is not None:
        raise ValueError(f"id {row['id']} occurs {row['count']} times")
    return rows


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, value): the lines of Zstandard files, unpacked in pieces, and whether they are the first of their file."""
    import zstandard

    for batch in batches:
        for content in batch.column("content").to_pylist():
            first, rest = True, b""
            stream = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True)
            while True:
                piece = stream.read(1 << 20)
                *lines, rest = (rest + piece).split(b"\n") if piece else [*filter(None, [rest]), b""]
                if lines:
                    yield pa.RecordBatch.from_arrays([pa.array([first and i == 0 for i in range(len(lines))]), pa.array([x.rstrip(b"\r").decode() for x in lines])], names=["first", "value"])
                    first = False
                if not piece:
                    break


def read_fst(spark: SparkSession, path: str) -> DataFrame:
    """(cluster_1, cluster_2, hudson_fst); what isn't a number is NaN.  Reads .zst, .gz and plain files."""
    if path.endswith(".zst"):
        raw = spark.read.format("binaryFile").load(path).select("content")
        lines = raw.mapInArrow(_unpacked, "first boolean, value string").where("value <> ''")
        names = lines.where("first").first()["value"].split("\t")
        f = F.split("value", "\t", -1)
        table = lines.where("not first").select(*(F.get(f, F.lit(i)).alias(n) for i, n in enumerate(names)))
    else:
        table = _table(spark, path)
    one = next((c for c in ("#POP1", "POP1") if c in table.columns), None)
    value = [c for c in table.columns if c.upper().endswith("FST")]
    if one is None or "POP2" not in table.columns or not value:
        raise ValueError("the columns of the pairs aren't found")
    return table.select(F.col(one).alias("cluster_1"), F.col("POP2").alias("cluster_2"), F.coalesce(parse_float(F.col(value[-1])), F.lit(float("nan"))).alias("hudson_fst"))


def read_regions(spark: SparkSession, path: str, chromosome: str | None = None) -> DataFrame:
    """(chrom, start, end, label) of a headerless interval file, of one chromosome if given."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where("trim(value) <> ''").select(F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(1)).cast("long").alias("start"), F.get(f, F.lit(2)).cast("long").alias("end"), F.get(f, F.lit(3)).alias("label"))
    return rows if chromosome is None else rows.where(bare_chromosome(F.col("chrom")) == chromosome.removeprefix("chr"))


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, marker, cm, pos) of a genetic map; blank lines and comments are skipped."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where("trim(value) <> '' and not startswith(trim(value), '#')")
    return rows.select(F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(1)).alias("marker"), F.get(f, F.lit(2)).cast("double").alias("cm"), F.get(f, F.lit(3)).cast("long").alias("pos"))


def same_chromosome(variants: DataFrame, maps: DataFrame) -> str:
    """The one chromosome that variants and map name alike; raises if either is empty or they differ."""
    a, b = (t.select("chrom").distinct().limit(2).collect() for t in (variants, maps))
    if len(a) != 1 or len(b) != 1 or not a[0][0] or a[0][0] != b[0][0]:
        raise ValueError(f"chromosomes differ: {[r[0] for r in a]} and {[r[0] for r in b]}")
    return a[0][0]


def map_path(folder: str, prefix: str, chromosome: str) -> str:
    """The genetic map of a chromosome in a folder of maps: prefix, name without chr, .map."""
    return f"{folder.rstrip('/')}/{prefix}{chromosome.removeprefix('chr')}.map"


def same_samples(first: DataFrame, other: DataFrame) -> None:
    """Raise at the first place where two ordered sample lists (idx, id) differ."""
    a, b = (numbered(t.select("idx", F.col("id").alias(name)), [F.col("idx")]).select("n", name) for t, name in ((first, "one"), (other, "two")))
    row = a.join(b, "n", "full").where("not (one <=> two)").agg(F.min(F.struct("n", "one", "two")).alias("m")).first()["m"]
    if row is not None:
        raise ValueError(f"sample {row['n'] + 1} is {row['one']} and {row['two']}")


def must_exist(spark: SparkSession, *paths: str) -> None:
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for p in paths:
        where = jvm(p if "://" in p else os.path.abspath(p))
        if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            raise FileNotFoundError(p)
