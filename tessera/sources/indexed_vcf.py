"""Blocked, indexed variant files as a data source: partitions planned from the index, for the chromosomes and positions
asked for, and a writer whose file and index appear only when all of it is written.

Partitions are ranges of virtual offsets, cut where the index has one, so a region reads only the blocks that
may hold its rows; rows of a block's edge that don't belong are left out.  Regions are given to the reader.  Filters put on its
table later don't reach the index: Spark 4.1 keeps filters pushed to a source written in Python for all later uses of the same
table, so a second query of it would lose rows (seen with a union of two chromosomes).  The writer's tasks write blocks of their own
range; on commit these follow each other in one file and their indices are shifted and joined.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from tessera.functions.text import bare_chromosome
from tessera.sources.blocks import LAST_BLOCK, TEXT, Sequence, Writer, block, index_bytes, lines, opened, read_index
from tessera.sources.vcf import parsed

NAME = "indexed_vcf"
SCHEMA = "chrom string, pos long, value string"
#: Compressed bytes of a partition, about.
SPLIT = 8 << 20
ROWS = 1000
FAR = 1 << 29


@dataclass
class Range(InputPartition):
    path: str
    chrom: str
    low: int
    high: int
    begin: int
    end: int


@dataclass
class Part(WriterCommitMessage):
    number: int
    path: str
    size: int
    index: dict[str, Sequence]


def planned(path: str, index: str, chroms: set[str] | None = None, low: int = 1, high: int = FAR, split: int = SPLIT) -> list[Range]:
    """Ranges of a file that hold all rows of these chromosomes (None: all) from position low to high."""
    out = []
    for chrom, s in read_index(index).items():
        if (chroms is not None and chrom not in chroms) or not s.bins or low > high:
            continue
        reach = s.reach(low - 1, high)
        if reach is None:
            continue
        begin, end = reach
        for cut in sorted({x for x in s.windows.values() if begin < x < end}):
            if (cut >> 16) - (begin >> 16) >= split:
                out.append(Range(path, chrom, low, high, begin, cut))
                begin = cut
        out.append(Range(path, chrom, low, high, begin, end))
    return out


def planned_bytes(ranges: list[Range]) -> int:
    """Compressed bytes that these ranges span, but for the last block of each."""
    return sum((r.end >> 16) - (r.begin >> 16) for r in ranges)


def index_counts(index: str) -> dict[str, int | None]:
    """Rows of each sequence, from the index alone."""
    return {chrom: s.rows for chrom, s in read_index(index).items()}


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.index = options.get("index", self.path + ".tbi")
        self.split = int(options.get("split", SPLIT))
        self.chroms = set(json.loads(options["chroms"])) if "chroms" in options else None
        self.low, self.high = int(options.get("low", 1)), int(options.get("high", FAR))

    def partitions(self) -> list[Range]:
        return planned(self.path, self.index, self.chroms, self.low, self.high, self.split)

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no range at all
            return
        names, rows = ["chrom", "pos", "value"], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))], names=names)

        for line in lines(part.path, part.begin, part.end):
            chrom, pos, _ = line.split(b"\t", 2)
            if chrom.decode() == part.chrom and part.low <= int(pos) <= part.high:
                rows.append((part.chrom, int(pos), line.decode()))
            if len(rows) == ROWS:
                yield batch()
                rows = []
        if rows:
            yield batch()


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.header, self.overwrite = options["path"], json.loads(options["header"]), overwrite
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Part:
        context = TaskContext.get()
        path = f"{self.parts}/{context.partitionId()}-{context.taskAttemptId()}"
        where, name = opened(path)
        where.create_dir(name.rpartition("/")[0])
        with where.open_output_stream(name, compression=None) as stream:
            out = Writer(stream)
            for chrom, pos, reach, value in rows:
                out.add(chrom, pos - 1, pos - 1 + reach, value.encode() + b"\n")
            size = out.close()
        return Part(context.partitionId(), path, size, out.index)

    def commit(self, messages: list[Part | None]) -> None:
        """The parts' blocks after each other, read in pieces; then the index; both get their name at the end."""
        where, name = opened(self.path)
        temporary, index, at = f"{opened(self.parts)[1]}/whole", {}, 0
        where.create_dir(opened(self.parts)[1])
        with where.open_output_stream(temporary, compression=None) as stream:
            text = self.header.encode()
            for i in range(0, len(text), TEXT):
                data = block(text[i : i + TEXT])
                stream.write(data)
                at += len(data)
            for part in sorted((m for m in messages if m is not None), key=lambda m: m.number):
                with where.open_input_stream(opened(part.path)[1], compression=None) as own:
                    while piece := own.read(1 << 20):
                        stream.write(piece)
                for chrom, s in part.index.items():
                    index.setdefault(chrom, Sequence()).join(s, at)
                at += part.size
            stream.write(LAST_BLOCK)
        with where.open_output_stream(f"{temporary}.tbi", compression=None) as stream:
            stream.write(index_bytes(index))
        where.move(f"{temporary}.tbi", f"{name}.tbi")
        where.move(temporary, name)
        where.delete_dir(opened(self.parts)[1])

    def abort(self, messages: list[Part | None]) -> None:
        where, name = opened(self.parts)
        if where.get_file_info(name).type.name != "NotFound":
            where.delete_dir(name)


class IndexedVcf(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), overwrite)


def read_indexed_vcf(spark: SparkSession, path: str, chroms: list[str] | None = None, low: int = 1, high: int = FAR, index: str | None = None, split: int = SPLIT) -> DataFrame:
    """The columns of read_vcf, of these chromosomes (None: all) and of positions low to high; only blocks that may hold such rows are read."""
    spark.dataSource.register(IndexedVcf)
    source = spark.read.format(NAME).option("path", path).option("index", index or path + ".tbi").option("split", split).option("low", low).option("high", high)
    return parsed((source if chroms is None else source.option("chroms", json.dumps(chroms))).load())


def write_indexed_vcf(variants: DataFrame, samples: list[str], path: str) -> None:
    """Variants (chrom, pos, id, ref, alts, gts) in the order of chromosomes and positions, as a blocked file with its index.

    Tasks write ranges of that order.  An earlier file is replaced once the new one is whole; after a failure
    there is nothing new.  A null id is a dot, as is an empty list of alternatives; an allele that is null too.
    """
    spark = variants.sparkSession
    spark.dataSource.register(IndexedVcf)
    allele = lambda a: F.coalesce(a.cast("string"), F.lit("."))
    gt = lambda g: F.concat(allele(g["a1"]), F.when(g["phased"], "|").otherwise("/"), allele(g["a2"]))
    alts = F.when(F.size("alts") > 0, F.array_join("alts", ",")).otherwise(".")
    dot = F.lit(".")
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.coalesce("id", dot), "ref", alts, dot, dot, dot, F.lit("GT"), F.array_join(F.transform("gts", gt), "\t"))
    number = F.coalesce(bare_chromosome(F.col("chrom")).try_cast("int"), F.lit(1 << 30))
    rows = variants.select("chrom", "pos", F.length("ref").cast("long").alias("reach"), line.alias("value"), number.alias("number"), "ref")
    order = ["number", "chrom", "pos", "ref"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("chrom", "pos", "reach", "value")
    contigs = [r["chrom"] for r in variants.select("chrom", number.alias("number")).distinct().orderBy("number", "chrom").collect()]
    header = "##fileformat=VCFv4.2\n" + "".join(f"##contig=<ID={c}>\n" for c in contigs) + '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">\n'
    header += "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples]) + "\n"
    rows.write.format(NAME).option("path", path).option("header", json.dumps(header)).mode("overwrite").save()
