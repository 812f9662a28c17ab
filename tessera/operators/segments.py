"""Shared haplotype segments from phased variants.

Alleles are packed, 64 markers to a long integer (a block).  Runs of equal alleles that are long enough to be seeds are
found by the positional prefix order: marker by marker, haplotypes are kept in the order of their
reversed prefixes, so that those which agree longest are neighbours, with the marker from which each agrees with
the one before it.  Where neighbours that agree for long enough part, the pairs that part are reported.
The work is haplotypes times markers, plus the pairs reported; no other pairs are ever formed, however many haplotypes
share a shorter stretch.

A chromosome is cut into windows of blocks.  A window begins early enough for every
seed that ends in it to be recognised, and reports just those.  Each window is dealt to a task for every SHARE of its
haplotypes: all of these tasks keep the order of all haplotypes, which is little work, and each reports the pairs that it finds by its own
ones, in pieces, so that no task ever holds the pairs of a window.  A piece's pairs are compared at once, in all of the markers that the task has; a
segment that can't go on beyond these is finished there and reported with its last seed.  For others, seeds that began before what a window holds
are joined at its seam when the blocks next to them are compared: the blocks of each seed are compared marker by
marker, and so is the next one, round by round, as long as a run or a gap that may be joined reaches
the end of what was compared.  Of a block, only the runs that are long enough or reach its ends are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.config import Detection
from tessera.shared import cut, numbered, passing

PAIR = ["chrom", "h1", "h2"]
#: Markers of a block, and blocks of a window (besides those it begins early by): a task holds a bit for each marker and haplotype.
BLOCK, WINDOW = 64, 64
#: Haplotypes by which one task finds pairs, and pairs that it hands on at once.
SHARE, PIECE = 8_000, 100_000
#: Haplotypes of a group whose pairs are formed at once with those of other groups.
NEAR = 256
#: Pairs times markers that are compared at once (some 10 bytes each).
COMPARED = 8_000_000
SEEDS = "chrom string, sample1 string, hap1 int, sample2 string, hap2 int, first int, last int"
SEGMENT = "start long, end long, length_cm double"
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def _parted(order: np.ndarray, since: np.ndarray, ones: np.ndarray, latest: int, flush: bool, own: np.ndarray, piece: int = PIECE) -> Iterator[Found]:
    """Pairs that agree since `latest` or before and part at this marker (flush: end here, all of them), with the marker
    from which they agree, in pieces.  order: haplotypes by reversed prefix; since: from where each agrees with the one before; ones: its
    allele; own: which haplotypes pairs are found by."""
    cuts = np.flatnonzero(since > latest)  # a group begins here; the first always does
    sizes = np.diff(np.append(cuts, len(order)))
    parts, found, held = sizes > 1, [], 0
    rare = own[order]
    if not flush:
        some = np.add.reduceat(ones, cuts)
        parts &= (some > 0) & (some < sizes)
        rare &= ones == np.repeat(2 * some <= sizes, sizes)
    at = np.flatnonzero(rare & np.repeat(parts, sizes))
    lo = np.repeat(cuts, sizes)[at]
    hi = lo + np.repeat(sizes, sizes)[at]
    near = hi - lo <= NEAR
    for way in (1,) if flush else (1, -1):  # of small groups, all haplotypes meet the next one, then the one after it, and so on
        i, first, last, agree, step = at[near], lo[near], hi[near], np.zeros(near.sum(), np.int64), 0
        while len(i):
            step += way
            inside = np.flatnonzero((i + step < last) & (i + step >= first))
            i, first, last, j = i[inside], first[inside], last[inside], i[inside] + step
            agree = np.maximum(agree[inside], since[j if way == 1 else j + 1])
            part = slice(None) if flush else ones[i] != ones[j]
            found.append((order[i][part], order[j][part], agree[part]))
            held += len(found[-1][0])
            if held >= piece:
                yield tuple(np.concatenate(x) for x in zip(*found, strict=True))
                found, held = [], 0
    for i, first, last in zip(at[~near].tolist(), lo[~near].tolist(), hi[~near].tolist(), strict=True):
        after = np.maximum.accumulate(since[i + 1 : last])
        other = np.arange(len(after)) if flush else np.flatnonzero(ones[i + 1 : last] != ones[i])
        found.append((np.full(len(other), order[i]), order[i + 1 + other], after[other]))
        held += len(other)
        if not flush and i > first:
            before = np.maximum.accumulate(since[i:first:-1])  # of the pair (i, i - 1), (i, i - 2), ...
            other = np.flatnonzero(ones[first:i][::-1] != ones[i])
            found.append((np.full(len(other), order[i]), order[i - 1 - other], before[other]))
            held += len(other)
        if held >= piece:
            yield tuple(np.concatenate(x) for x in zip(*found, strict=True))
            found, held = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def prefix_order(bits: np.ndarray, cm: np.ndarray, begin: int, rules: Detection, ends: bool, own: np.ndarray | None = None, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Runs that are seeds and end at marker begin - 1 or later, in pieces: (haplotypes, haplotypes, first markers, last marker).  bits: haplotypes
    by blocks; cm: genetic positions of the markers; ends: runs also end after the last of them; own: which haplotypes pairs are found by (all)."""
    n, markers = len(bits), len(cm)
    own = np.ones(n, bool) if own is None else own
    order, since = np.arange(n), np.zeros(n, np.int64)
    since[:1] = markers + 1
    for k in range(markers + ends):
        latest = min(int(np.searchsorted(cm, cm[k - 1] - rules.min_seed + 1e-9, "right")) - 1, k - rules.min_markers) if k else -1
        ones = ((bits[:, k // BLOCK] >> np.uint64(k % BLOCK)) & np.uint64(1)).astype(np.int64)[order] if k < markers else np.zeros(n, np.int64)
        if k >= begin and latest >= 0:
            for a, b, first in _parted(order, np.where(np.arange(n) == 0, markers + 1, since), ones, latest, k == markers, own, piece):
                yield a, b, first, k - 1
        if k < markers:
            # those with 0 come first, then those with 1, each in the order they had; a haplotype agrees with the one now before it since the latest start between them
            parts = []
            for x in (0, 1):
                same = np.flatnonzero(ones == x)
                d = np.maximum.reduceat(since[: same[-1] + 1], np.append(0, same[:-1] + 1)) if len(same) else since[:0]
                d[:1] = k + 1
                parts.append((order[same], d))
            order, since = (np.concatenate(x) for x in zip(*parts, strict=True))


def finished(same: np.ndarray, last: np.ndarray, positions: np.ndarray, cm: np.ndarray, opens: bool, closes: bool, rules: Detection) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What becomes of pairs' seeds: (rows, first markers, last markers) of the segments of which they are the last seeds, and the rows
    whose segments may go on beyond these markers.  same: pairs by markers, whether alleles are equal; last: the last marker of each pair's seed; opens, closes: whether
    the chromosome has no marker before, after these."""
    end, kind = len(cm) - 1, np.zeros((len(same), len(cm) + 2), np.int8)
    kind[:, 1:-1] = same
    change = np.diff(kind, axis=1)
    (row, s), e = np.nonzero(change == 1), np.nonzero(change == -1)[1] - 1
    cut_off = ((s == 0) & (not opens)) | ((e == end) & (not closes))  # such a run may be longer
    length = cm[e] - cm[s]
    seed = (length >= rules.min_seed) & (e - s + 1 >= rules.min_markers)
    use = seed | (length >= rules.min_extend) | cut_off
    row, s, e, seed, cut_off = (x[use] for x in (row, s, e, seed, cut_off))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (positions[s[1:]] - positions[e[:-1]] > rules.max_gap) | (rules.max_gap < 0)
    first = np.flatnonzero(new)  # of each segment, its first run
    if not len(first):
        return (*np.zeros((3, 0), np.int64), np.arange(len(same)))
    until = np.append(first[1:], len(row)) - 1
    begin, stop = s[first], e[until]
    goes_on = np.logical_or.reduceat(cut_off, first)
    if not opens:
        goes_on |= positions[begin] - positions[0] <= rules.max_gap
    if not closes:
        goes_on |= positions[end] - positions[stop] <= rules.max_gap
    holds = np.add.reduceat((s <= last[row]) & (last[row] <= e), first) > 0  # the seed that was found is in this one
    last_seed = np.maximum.reduceat(np.where(seed, e, -1), first)
    done = holds & ~goes_on & (last_seed == last[row[first]]) & (cm[stop] - cm[begin] >= rules.min_output)
    return row[first[done]], begin[done], stop[done], row[first[holds & goes_on]]


def _task(rules: Detection, piece: int = PIECE, finish: bool = False):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Seeds that end in one window, found by one share of the haplotypes.  Rows are of blocks (sample, hap, b, m) or of the
        window's markers (b, cms, positions, own, closes)."""
        chrom, _, share, shares = (x.as_py() for x in key)
        rows = pa.Table.from_batches(list(batches))
        ends, blocks = rows.filter(rows["cms"].is_valid()).sort_by("b"), rows.filter(rows["cms"].is_null())
        if not blocks.num_rows or not ends.num_rows:
            return
        sample = blocks["sample"].combine_chunks().dictionary_encode()
        names, number = sample.dictionary.to_numpy(zero_copy_only=False), np.zeros(len(sample.dictionary), np.int64)
        number[np.argsort(names)] = np.arange(len(names))
        sample, hap = number[sample.indices.to_numpy()], blocks["hap"].to_numpy()  # haplotypes are numbered in the order of samples
        names = pa.array(np.sort(names), pa.string())
        order = np.lexsort((blocks["b"].to_numpy(), hap, sample))
        bits = blocks["m"].to_numpy().astype(np.int64)[order].view(np.uint64).reshape(-1, ends.num_rows)
        sample, hap = sample[order[:: ends.num_rows]], hap[order[:: ends.num_rows]]
        cm, positions = (ends[x].combine_chunks().flatten().to_numpy() for x in ("cms", "positions"))
        base, begin = ends["b"][0].as_py() * BLOCK, ends["own"].to_pylist().count(False) * BLOCK
        own = np.arange(len(bits)) % shares == share
        closes, step = any(ends["closes"].to_pylist()), max(1, COMPARED // len(cm))
        names_of = lambda schema: [x.split()[0] for x in schema.split(", ")]
        for a, b, first, last in prefix_order(bits, cm, begin, rules, closes, own, piece):
            a, b = np.minimum(a, b), np.maximum(a, b)
            apart = sample[a] != sample[b]
            a, b, first = a[apart], b[apart], first[apart] + base
            named = lambda x, y: [pa.array([chrom] * len(x), pa.string()), names.take(pa.array(sample[x])), pa.array(hap[x], pa.int32()), names.take(pa.array(sample[y])), pa.array(hap[y], pa.int32())]  # noqa: B023, E731
            if not finish:
                yield pa.RecordBatch.from_arrays([*named(a, b), pa.array(first.astype(np.int32)), pa.array(np.full(len(a), last + base, np.int32))], names=names_of(SEEDS))
                continue
            for i in range(0, len(a), step):
                x, y, begun = a[i : i + step], b[i : i + step], first[i : i + step]
                same = np.unpackbits(np.ascontiguousarray(~(bits[x] ^ bits[y])).astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, : len(cm)]
                row, s, e, open_rows = finished(same, np.full(len(x), last), positions, cm, base == 0, closes, rules)
                rows = np.concatenate((row, open_rows))
                some = len(row)
                segment = (np.append(values, np.zeros(len(open_rows), values.dtype)) for values in (positions[s], positions[e], cm[e] - cm[s]))
                null = np.arange(len(rows)) >= some
                yield pa.RecordBatch.from_arrays([*named(x[rows], y[rows]), pa.array(begun[rows].astype(np.int32)), pa.array(np.full(len(rows), last + base, np.int32)), *(pa.array(values, mask=null) for values in segment)],
                                                 names=names_of(f"{SEEDS}, {SEGMENT}"))

    return run


def packed_blocks(alleles: DataFrame, markers: DataFrame) -> DataFrame:
    """(chrom, b, sample, hap, m): bit j of m is the allele (0 or 1) at marker 64 b + j."""
    rows = alleles.join(markers.select("chrom", "pos", "i"), ["chrom", "pos"])
    bit = F.expr(f"shiftleft(cast(allele as bigint), cast(i % {BLOCK} as int))")
    return rows.groupBy("chrom", F.floor(F.col("i") / BLOCK).cast("int").alias("b"), "sample", "hap").agg(F.bit_or(bit).alias("m"))


def seeds(blocks: DataFrame, ends: DataFrame, rules: Detection, window: int = WINDOW, share: int = SHARE, piece: int = PIECE, finish: bool = False) -> DataFrame:
    """Runs of equal alleles of two samples' haplotypes that are long enough for a seed (SEEDS), first and last by marker; a run
    that began before its window is given from the window's first marker on.  ends: (chrom, b, positions, cms).
    share: haplotypes by which a task finds pairs; piece: pairs that it hands on at once.  finish: instead, (SEEDS, SEGMENT), segments that are finished, with their last
    seeds, and the seeds of others, without a start."""
    last = F.floor(F.element_at("cms", -1) * 1_000_000)  # whole numbers, as range frames need
    at = Window.partitionBy("chrom").orderBy("b")
    rows = ends.select("chrom", "b", last.alias("end"))  # a row for each block of a chromosome
    far = Window.partitionBy("chrom").orderBy("end").rangeBetween(Window.unboundedPreceding, -math.ceil(rules.min_seed * 1_000_000) - 2)
    rows = rows.withColumn("far", F.coalesce(F.max("b").over(far), F.lit(0))).withColumn("far", F.coalesce(F.lag("far").over(at), F.lit(0)))
    rows = rows.withColumn("last", F.max("b").over(Window.partitionBy("chrom")))
    early = F.greatest(F.least("far", F.floor((F.col("b") * BLOCK - rules.min_markers) / BLOCK)), F.lit(0))
    windows = rows.where(F.col("b") % window == 0).select("chrom", F.col("b").alias("own"), F.explode(F.sequence(early.cast("int"), F.least(F.col("b") + window - 1, F.col("last")))).alias("b"), (F.col("b") + window > F.col("last")).alias("closes"))
    windows = cut(windows.withColumnRenamed("own", "w"))
    # the most haplotypes that a block of the chromosome has decide on how many tasks a window is dealt to
    shares = blocks.groupBy("chrom", "b").count().groupBy("chrom").agg(F.ceil(F.max("count") / share).cast("int").alias("shares"))
    windows = windows.join(F.broadcast(cut(shares)), "chrom").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    key = ["chrom", "w", "share", "shares"]
    of = ends.select("chrom", "b", "cms", F.col("positions").cast("array<long>").alias("positions")).join(windows, ["chrom", "b"]).select(*key, F.lit(None).cast("string").alias("sample"), F.lit(None).cast("int").alias("hap"), "b", F.lit(None).cast("long").alias("m"), "cms", "positions", (F.col("b") >= F.col("w")).alias("own"), "closes")
    dealt = blocks.join(F.broadcast(windows.select(*key, "b")), ["chrom", "b"])
    dealt = dealt.select(*key, "sample", F.col("hap").cast("int").alias("hap"), "b", "m", F.lit(None).cast("array<double>").alias("cms"), F.lit(None).cast("array<bigint>").alias("positions"), F.lit(None).cast("boolean").alias("own"), F.lit(None).cast("boolean").alias("closes"))
    # dealt by number: by their size, which isn't their work, the parts of a window would be put into one task again
    parts = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), windows.select(*key).distinct().count())
    return dealt.unionByName(of).repartition(parts, *key).groupBy(*key).applyInArrow(_task(rules, piece, finish), f"{SEEDS}, {SEGMENT}" if finish else SEEDS)


def _compared(near: DataFrame, blocks: DataFrame, ends: DataFrame, rules: Detection) -> DataFrame:
    """Pairs' blocks (PAIR, b, n markers, lo, hi, runs): the first and last place in them at which both are equal, and the runs of
    equal places (first, last, s, e: their markers' numbers, positions and centimorgans) that can be of use: those that reach
    an end of the block, or are long enough to extend."""
    m1, m2 = blocks.select("chrom", "b", F.col("h").alias("h1"), F.col("m").alias("x")), blocks.select("chrom", "b", F.col("h").alias("h2"), F.col("m").alias("y"))
    met = near.join(m1, ["chrom", "b", "h1"]).join(m2, ["chrom", "b", "h2"]).join(ends.select("chrom", "b", "positions", "cms", F.size("positions").alias("n")), ["chrom", "b"])
    met = met.withColumn("same", F.expr(f"~(x ^ y) & shiftrightunsigned(-1L, {BLOCK} - n)"))
    places = lambda bits: F.expr(f"filter(sequence(0, n - 1), j -> getbit({bits}, j) = 1)")
    met = met.withColumn("starts", places("same & ~shiftleft(same, 1)")).withColumn("stops", places("same & ~shiftrightunsigned(same, 1)"))
    runs = F.filter(F.arrays_zip("starts", "stops"), lambda r: (r["starts"] == 0) | (r["stops"] == F.col("n") - 1) | (F.get("cms", r["stops"]) - F.get("cms", r["starts"]) >= rules.min_extend))
    at = lambda j: F.struct(F.get("positions", j).alias("pos"), F.get("cms", j).alias("cm"))
    runs = F.transform(runs, lambda r: F.struct((F.col("b") * BLOCK + r["starts"]).alias("first"), (F.col("b") * BLOCK + r["stops"]).alias("last"), at(r["starts"]).alias("s"), at(r["stops"]).alias("e")))
    return met.select(*PAIR, "b", "n", F.get("starts", F.lit(0)).alias("lo"), F.try_element_at("stops", F.lit(-1)).alias("hi"), runs.alias("runs"))


def _next(known: DataFrame, ends: DataFrame, max_gap: int) -> DataFrame:
    """Blocks next to known ones that a run, or a gap of at most max_gap base pairs after one, reaches."""
    rows = known.join(ends.select("chrom", "b", "positions"), ["chrom", "b"])
    rows = rows.select(*PAIR, "b", F.get("positions", "lo").alias("first"), F.get("positions", "hi").alias("last"),
                       F.coalesce(F.col("lo") == 0, F.lit(False)).alias("open_left"), F.coalesce(F.col("hi") == F.col("n") - 1, F.lit(False)).alias("open_right"))
    pair = Window.partitionBy(*PAIR).orderBy("b")
    rows = rows.withColumn("last", F.last("last", True).over(pair)).withColumn("first", F.first("first", True).over(pair.rowsBetween(0, Window.unboundedFollowing)))
    right = ends.select("chrom", (F.col("b") - 1).alias("b"), F.element_at("positions", 1).alias("edge"))
    left = ends.select("chrom", (F.col("b") + 1).alias("b"), F.element_at("positions", -1).alias("edge"))
    right = rows.join(right, ["chrom", "b"]).where(F.col("open_right") | (F.col("edge") - F.col("last") <= max_gap)).select(*PAIR, (F.col("b") + 1).alias("b"))
    left = rows.join(left, ["chrom", "b"]).where(F.col("open_left") | (F.col("first") - F.col("edge") <= max_gap)).select(*PAIR, (F.col("b") - 1).alias("b"))
    return right.unionByName(left).distinct()


def detect(alleles: DataFrame, positions: DataFrame, rules: Detection, window: int = WINDOW) -> DataFrame:
    """(id1, hap1, id2, hap2, chrom, start, end, length_cm).

    alleles: (chrom, pos, sample, hap, allele), complete, 0 or 1; positions: (chrom, pos, cm).  Markers below
    the minor allele count are left out.  A segment is a maximal run of equal alleles of at least
    min_seed centimorgans and min_markers markers, joined with neighbouring runs of at least
    min_extend across gaps of at most max_gap base pairs, reported from min_output on.
    """
    with passing(alleles.sparkSession) as keep:
        counts = alleles.groupBy("chrom", "pos").agg(F.sum("allele").alias("a"), F.count("*").alias("n"))
        markers = counts.where(F.least("a", F.col("n") - F.col("a")) >= rules.min_mac).join(positions, ["chrom", "pos"])
        markers = cut(numbered(markers.select("chrom", "pos", "cm"), [F.col("pos")], "chrom", "i"))
        blocks = cut(packed_blocks(alleles, markers))
        ends = markers.groupBy("chrom", F.floor(F.col("i") / BLOCK).cast("int").alias("b")).agg(F.sort_array(F.collect_list(F.struct("pos", "cm"))).alias("at"))
        ends = cut(ends.select("chrom", "b", F.col("at.pos").alias("positions"), F.col("at.cm").alias("cms")))
        found = cut(seeds(blocks, ends, rules, window, finish=True))
        names = [F.col("sample1").alias("id1"), "hap1", F.col("sample2").alias("id2"), "hap2", "chrom"]
        done = found.where("start is not null").select(*names, "start", "end", "length_cm")
        found = found.where("start is null")
        if found.isEmpty():
            return keep(done)
        blocks = blocks.select("chrom", "b", F.struct("sample", "hap").alias("h"), "m")
        reach = F.sequence(F.floor(F.col("first") / BLOCK).cast("int") - 1, F.floor(F.col("last") / BLOCK).cast("int") + 1)
        near = found.select("chrom", F.struct(F.col("sample1").alias("sample"), F.col("hap1").alias("hap")).alias("h1"), F.struct(F.col("sample2").alias("sample"), F.col("hap2").alias("hap")).alias("h2"), F.explode(reach).alias("b"))
        near = near.join(ends.select("chrom", "b"), ["chrom", "b"], "left_semi")
        known = cut(_compared(near.distinct(), blocks, ends, rules))
        while True:
            new = cut(_compared(_next(known, ends, rules.max_gap).join(known.select(*PAIR, "b"), [*PAIR, "b"], "left_anti"), blocks, ends, rules))
            if new.isEmpty():
                break
            known = cut(known.unionByName(new))
        # of pairs with open seeds, finished segments may be met again
        met = done.join(found.select(*names).distinct(), ["id1", "hap1", "id2", "hap2", "chrom"], "left_semi").select("id1", "hap1", "id2", "hap2", "chrom", "start")
        rest = _joined(known, rules)
        return keep(cut(done.unionByName(rest.join(met, met.columns, "left_anti").select(done.columns))))


def _joined(known: DataFrame, rules: Detection) -> DataFrame:
    """Segments from the runs in blocks; those that go on in the next block are put together first."""
    pair = Window.partitionBy("chrom", "h1", "h2")
    runs = known.select(*PAIR, F.explode("runs").alias("r")).select(*PAIR, "r.*")
    begins = F.coalesce(F.col("first") != F.lag("last").over(pair.orderBy("first")) + 1, F.lit(True)).cast("int")
    runs = runs.withColumn("begins", begins).withColumn("run", F.sum("begins").over(pair.orderBy("first")))
    runs = runs.groupBy(*PAIR, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min("s").alias("first_at"), F.max("e").alias("last_at"))
    length = F.col("last_at.cm") - F.col("first_at.cm")
    runs = runs.withColumn("seed", (length >= rules.min_seed) & (F.col("last") - F.col("first") + 1 >= rules.min_markers)).where(F.col("seed") | (length >= rules.min_extend))
    before = F.lag("last_at.pos").over(pair.orderBy("first"))
    joined = runs.withColumn("new", (F.coalesce(F.col("first_at.pos") - before > rules.max_gap, F.lit(True)) | F.lit(rules.max_gap < 0)).cast("int"))
    joined = joined.withColumn("g", F.sum("new").over(pair.orderBy("first")))
    out = joined.groupBy("chrom", "h1", "h2", "g").agg(F.min("first_at").alias("s"), F.max("last_at").alias("e"), F.max("seed").alias("seed"))
    out = out.where("seed").withColumn("length_cm", F.col("e.cm") - F.col("s.cm")).where(F.col("length_cm") >= rules.min_output)
    return out.select(F.col("h1.sample").alias("id1"), F.col("h1.hap").alias("hap1"), F.col("h2.sample").alias("id2"), F.col("h2.hap").alias("hap2"), "chrom", F.col("s.pos").alias("start"), F.col("e.pos").alias("end"), "length_cm")
