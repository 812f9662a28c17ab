"""Overlap of genomic intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import bare_chromosome, start_from_zero

#: Merged regions up to this number are searched in every task; more are met in bins of BIN base pairs.
MOST_REGIONS, BIN = 100_000, 1_000_000
#: Positions are below 2**POSITION_BITS; a chromosome's number stands above them.
POSITION_BITS = 40


def merged(regions: DataFrame) -> DataFrame:
    """Regions (r_chrom, r_start, r_end) that overlap or touch put together: disjoint ones, by chromosome."""
    order = Window.partitionBy("r_chrom").orderBy("r_start", "r_end")
    reach = F.max("r_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = regions.where("r_start <= r_end").withColumn("new", F.coalesce((F.col("r_start") > reach).cast("int"), F.lit(1)))
    rows = rows.withColumn("g", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("r_chrom", "g").agg(F.min("r_start").alias("r_start"), F.max("r_end").alias("r_end")).drop("g")


def _hit(rows: list) -> Column:
    """Whether a segment (_chrom, _start, end) overlaps one of these disjoint regions: by halving, the last region that begins
    before its end; that one ends last of all that do."""
    names = sorted({r["r_chrom"] for r in rows if r["r_chrom"] is not None})
    number = {c: i for i, c in enumerate(names, 1)}
    most = (1 << POSITION_BITS) - 1
    place = lambda chrom, pos: number[chrom] * (most + 1) + min(max(pos, 0), most)
    pairs = sorted((place(r["r_chrom"], r["r_start"]), place(r["r_chrom"], r["r_end"])) for r in rows if r["r_chrom"] is not None)
    if not pairs:
        return F.lit(False)
    constant = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # noqa: E731  folded into one constant
    starts, ends = (constant(x) for x in zip(*pairs, strict=True))
    chrom = F.array_position(F.split(F.lit("\t".join(names)), "\t"), F.col("_chrom"))
    key = lambda pos: chrom * F.lit(most + 1) + F.least(F.greatest(pos, F.lit(0)), F.lit(most))
    steps = F.sequence(F.lit(len(pairs).bit_length() - 1), F.lit(0), F.lit(-1))

    def halved(end: Column) -> Column:
        further = lambda at, j: at + F.call_function("shiftleft", F.lit(1), j)
        return F.aggregate(steps, F.lit(-1), lambda at, j: F.when(F.get(starts, further(at, j)) < end, further(at, j)).otherwise(at))

    last = F.get(F.transform(F.array(key(F.col("end"))), halved), F.lit(0))
    return F.coalesce((chrom > 0) & (F.get(ends, last) > key(F.col("_start"))), F.lit(False))


def overlapping(segments: DataFrame, regions: DataFrame, how: str = "left_anti", most: int = MOST_REGIONS) -> DataFrame:
    """Segments (chrom, start from 1, end inclusive, ...) that overlap none (left_anti) or some
    (left_semi) of the regions (chrom, start from 0, end exclusive).  Chromosome names are compared
    without chr; intervals that only touch don't overlap; a chromosome without regions keeps all.

    Regions are merged first.  If there are then at most `most`, each task searches a sorted array of them by halving;
    else regions and segments meet by bins.
    """
    r = regions.select(bare_chromosome(F.col("chrom")).alias("r_chrom"), F.col("start").cast("long").alias("r_start"), F.col("end").cast("long").alias("r_end"))
    columns = segments.columns
    s = segments.withColumn("_chrom", bare_chromosome(F.col("chrom"))).withColumn("_start", start_from_zero(F.col("start")))
    r = merged(r)
    some = r.limit(most + 1).collect()
    if len(some) <= most:
        hit = _hit(some)
        return s.where(hit if how == "left_semi" else ~hit).select(columns)
    # an interval that overlaps a region shares a bin with it: find the overlapping rows by bin
    overlap = (F.col("_chrom") == F.col("r_chrom")) & (F.col("_start") < F.col("r_end")) & (F.col("r_start") < F.col("end"))
    s = s.withColumn("_row", F.struct(*columns)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_start") / BIN), F.floor(F.greatest(F.col("end") - 1, F.col("_start")) / BIN))))
    r = r.withColumn("r_bin", F.explode(F.sequence(F.floor(F.col("r_start") / BIN), F.floor(F.greatest(F.col("r_end") - 1, F.col("r_start")) / BIN))))
    hits = s.join(r, (F.col("_bin") == F.col("r_bin")) & overlap, "left_semi").select(*columns).distinct()
    same = [segments[c].eqNullSafe(hits[c]) for c in columns]
    return segments.join(hits, same, how)


def chromosomes_without_regions(segments: DataFrame, regions: DataFrame) -> DataFrame:
    """Chromosomes of segments that no region names, to warn of."""
    a = segments.select(bare_chromosome(F.col("chrom")).alias("chrom")).distinct()
    return a.join(regions.select(bare_chromosome(F.col("chrom")).alias("chrom")).distinct(), "chrom", "left_anti")
