"""SentencePiece encoding and decoding by a batched Viterbi search.

Texts are normalised as the model says (a leading space is added and spaces become U+2581) and cut
into units: a run of U+2581 with what follows up to the next one.  No piece crosses such a cut.  The
units that a task hasn't met yet are segmented together: hashes of all their substrings probe the
sorted hashes of the pieces (and equal hashes are compared as text), units advance position by
position, and vectorised maxima store the last piece of the best segmentation up to each position.
Characters without a piece become the pieces of their UTF-8 bytes.

What is best depends on how the model was trained.  For a unigram model it is the largest sum of
scores (of equal ones, the longer last piece).  A model of merges has no such sum: a segmentation is
the one that replaying its merges gives if and only if each two neighbours would not be merged
across their border, so two pieces next to each other score 0 or minus infinity, by the order in
which the merges of both are undone.  Ids are the library's in both cases.

Null and empty texts have no tokens; repeated rows are encoded alike.  A text that itself contains
U+2581 decodes with spaces there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokens import Grams, gather, mix, steps

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
UNIT = re.compile(f"{chr(SPACE)}+[^{chr(SPACE)}]*|[^{chr(SPACE)}]+")
#: How much worse than the worst piece an unknown character scores, as in the library.
UNKNOWN_PENALTY = 10.0
#: Bytes of text that one step holds; units, and their characters, that a task remembers.
STEP, MOST_UNITS, MOST_CHARACTERS = 1 << 18, 100_000, 1 << 21
#: Numbers of a character without a piece, and of a unit's start; they merge with nothing.
UNKNOWN, START = -1, -2


class Table:
    """Numbers by 64-bit key: a slot of `first` has the only key that falls there, the rest are searched."""

    def __init__(self, keys: np.ndarray, numbers: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], numbers[order].astype(np.int32)
        self.mask = np.uint64((1 << max(10, 4 + int(len(keys)).bit_length())) - 1)
        self.first = np.full(int(self.mask) + 1, -1, dtype=np.int32)
        slots = (self.keys & self.mask).astype(np.int64)
        self.first[slots] = np.arange(len(keys))
        several = np.bincount(slots, minlength=1) > 1
        self.first[np.flatnonzero(several)] = -2

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        at = self.first[(keys & self.mask).astype(np.int64)]
        several = np.flatnonzero(at == -2)
        at[several] = np.minimum(np.searchsorted(self.keys, keys[several]), len(self.keys) - 1)
        out = np.full(len(keys), -1, dtype=np.int32)
        some = np.flatnonzero(at >= 0)
        own = some[self.keys[at[some]] == keys[some]]
        out[own] = self.numbers[at[own]]
        return out


@dataclass
class Pieces:
    """Ordinary pieces are numbered single characters first, then in the order of their merges.

    keys: hashes of their texts; text, off: characters by number; left and right: the two pieces that
    a piece is merged from (itself if single); pairs: (left, right) that merge; data, data_off: bytes
    of every id.
    """

    merges: bool
    keys: Table
    longest: int
    singles: int
    text: np.ndarray
    off: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    unknown: float
    left: np.ndarray
    right: np.ndarray
    pairs: Table
    bytes_ids: np.ndarray
    data: np.ndarray
    data_off: np.ndarray


def _values(text: np.ndarray) -> np.ndarray:
    return mix(text.astype(np.uint64) + np.uint64(0x1000000))


def replay(units: str, number: dict[str, int], singles: int) -> list[str]:
    """A unit's pieces by merging the best neighbours, the leftmost of equals, until none merge."""
    parts = list(units)
    while True:
        ranks = [number.get(a + b, -1) for a, b in zip(parts[:-1], parts[1:], strict=True)]
        best = min((r for r in ranks if r >= singles), default=None)
        if best is None:
            return parts
        i = ranks.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def load(path: str = MODEL, merges: bool = True) -> Pieces:
    """Read a model's pieces; merges: it was trained by merges (else as a unigram model)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    plain.sort(key=lambda i: (len(model.id_to_piece(i)) > 1, -model.get_score(i), i))
    pieces = [model.id_to_piece(i) for i in plain]
    singles = sum(len(p) == 1 for p in pieces)
    number = {p: i for i, p in enumerate(pieces)}
    text = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
    off = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    hashes = Grams(_values(text), off).span(off[:-1], off[1:])
    left, right = np.arange(len(pieces)), np.arange(len(pieces))
    reachable, pairs = np.ones(len(pieces), dtype=bool), []
    if merges:
        for i, p in enumerate(pieces[singles:], singles):
            splits = [(number[p[:k]], number[p[k:]]) for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
            pairs += [(a << 20 | b, i) for a, b in splits]
            # pieces that make this one come before it; undone, only these merges count
            parts = replay(p, {p[a:b]: number[p[a:b]] for a in range(len(p)) for b in range(a + 1, len(p) + 1) if number.get(p[a:b], i) < i}, singles)
            reachable[i] = len(parts) == 2
            if reachable[i]:
                left[i], right[i] = number[parts[0]], number[parts[1]]
    usable = np.flatnonzero(reachable)
    table_ = Table(hashes[usable], usable)
    pair_table = Table(mix(np.array([k for k, _ in pairs], np.uint64)), np.array([m for _, m in pairs], np.int64))
    scores = np.array([model.get_score(i) for i in plain])
    data = [model.id_to_piece(i).replace(chr(SPACE), " ").encode() for i in range(size)]
    bytes_ids = np.zeros(256, dtype=np.int32)
    for i in range(size):
        if model.is_byte(i):
            data[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
            bytes_ids[data[i][0]] = i
        elif model.is_control(i):
            data[i] = b""
    return Pieces(
        merges, table_, max(map(len, pieces)), singles, text, off, np.array(plain, np.int32), scores, scores.min() - UNKNOWN_PENALTY, left, right, pair_table,
        bytes_ids, np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in data]))),
    )


def compatible(pieces: Pieces, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether replaying the merges of a's text before b's leaves a and b: the merges of both are
    undone from the last, and no pair at the border may merge before the merge undone last."""
    out = np.ones(len(a), dtype=bool)
    live = np.flatnonzero((a >= 0) & (b >= 0))
    x, y, before = a[live], b[live], np.full(len(live), len(pieces.ids))
    while len(live):
        merged = pieces.pairs.find(mix(x.astype(np.uint64) << np.uint64(20) | y.astype(np.uint64)))
        merges = (merged >= 0) & (merged < before)
        out[live[merges]] = False
        more = ~merges & (np.maximum(x, y) >= pieces.singles)
        live, x, y = live[more], x[more], y[more]
        first = x > y
        before = np.where(first, x, y + 1)
        x, y = np.where(first, pieces.right[x], x), np.where(first, y, pieces.left[y])
    return out


def _found(pieces: Pieces, text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, length, number) of all pieces in units, and of characters without one, by end."""
    end_of = np.repeat(off[1:], np.diff(off))
    ends, lengths, numbers = [], [], []
    two = text.astype(np.uint64)
    two[:-1] |= two[1:] << np.uint64(32)
    theirs = np.concatenate((pieces.text, np.zeros(1, np.uint32))).astype(np.uint64)
    theirs[:-1] |= theirs[1:] << np.uint64(32)
    length = np.diff(pieces.off)
    for n, hashes in enumerate(Grams(_values(text), off).all_windows(pieces.longest), 1):
        number = pieces.keys.find(hashes)
        at = np.flatnonzero(number >= 0)
        number = number[at].astype(np.int64)
        some = length[number] == n
        for i in range(0, n - 1, 2):  # two characters at a time, the last alone
            some &= two[at + i] == theirs[pieces.off[number] + i]
        some &= text[at + n - 1] == pieces.text[np.minimum(pieces.off[number] + n - 1, len(pieces.text) - 1)]
        at, number = at[some], number[some]
        if n > 1:
            some = at + n <= end_of[at]
            at, number = at[some], number[some]
        if n == 1:
            single = np.full(len(text), UNKNOWN)
            single[at] = number
            at, number = np.arange(len(text)), single
        ends.append(at + n)
        lengths.append(np.full(len(at), n))
        numbers.append(number)
    ends, lengths, numbers = map(np.concatenate, (ends, lengths, numbers))
    order = np.argsort(ends, kind="stable")
    return ends[order], lengths[order], numbers[order]


def _segment(pieces: Pieces, text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best segmentation of each unit, end to end, and their offsets."""
    n = len(text)
    ends, lengths, numbers = _found(pieces, text, off)
    # no segmentation has a piece across a border that no piece crosses: units are cut there as well
    crossed = np.zeros(n + 2, dtype=np.int64)
    np.add.at(crossed, ends - lengths + 1, 1)
    np.add.at(crossed, ends, -1)
    borders = np.unique(np.concatenate((off, np.flatnonzero(np.cumsum(crossed)[: n + 1] == 0))))
    begin, length = borders[:-1], np.diff(borders)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    slot = np.searchsorted(ends, np.arange(n + 2))
    last, size_at = np.full(n + 1, START), np.zeros(n + 1, dtype=np.int64)
    total = np.zeros(n + 1)
    starts_here = np.zeros(n + 1, dtype=bool)
    starts_here[begin] = True
    active = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1 if len(length) else 1), side="right")
    for j, m in enumerate(active, 1):
        end = begin[:m] + j
        count = slot[end + 1] - slot[end]
        at = gather(slot[end], count)
        size, number = lengths[at], numbers[at]
        from_ = ends[at] - size
        if pieces.merges:
            # at most one is compatible, mostly the longest, which is the last of its end: the others are looked at only where it isn't
            before = np.where(size == j, START, last[from_])
            value = np.full(len(size), -np.inf)
            top = np.cumsum(count) - 1
            good = compatible(pieces, before[top], number[top])
            rest = np.flatnonzero(np.repeat(~good, count))
            value[top[good]] = 0
            value[rest[compatible(pieces, before[rest], number[rest])]] = 0
        else:
            value = np.where(size == j, 0.0, total[from_]) + np.where(number >= 0, pieces.scores[number], pieces.unknown)
        first = np.cumsum(count) - count
        best = np.maximum.reduceat(value, first)
        # of equals the longest, which is the last of its end: pieces are found by length
        is_best = np.flatnonzero(value == np.repeat(best, count))
        pick = np.full(m, -1)
        pick[np.repeat(np.arange(m), count)[is_best]] = is_best
        total[end], last[end], size_at[end] = best, number[pick], size[pick]
        if np.isinf(best).any():
            raise ValueError("the model's pieces don't come from merges")
    chosen = np.zeros(n + 1, dtype=np.int64)
    at = begin + length
    stop = begin
    while len(at):
        size = size_at[at]
        chosen[at] = size
        at = at - size
        live = at > stop
        at, stop = at[live], stop[live]
    stops = np.flatnonzero(chosen)
    number = last[stops]
    known = number >= 0
    characters = text[stops - 1]
    raw = np.frombuffer("".join(map(chr, characters[~known].tolist())).encode("utf-8", "surrogatepass"), np.uint8)
    width = np.select([characters < 0x80, characters < 0x800, characters < 0x10000], [1, 2, 3], 4)
    count = np.where(known, 1, width)
    ids = np.empty(int(count.sum()), dtype=np.int32)
    spread = np.repeat(known, count)
    ids[spread] = pieces.ids[number[known]]
    ids[~spread] = pieces.bytes_ids[raw]
    return ids, np.concatenate(([0], np.cumsum(count)))[np.searchsorted(stops, off, side="right")]


@dataclass
class Memory:
    """Units met so far, by text: their place among `off`, which cuts `ids`."""

    places: dict[str, int] = field(default_factory=dict)
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    off: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))


def encode(pieces: Pieces, texts: list[str | None], memory: Memory | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of texts, end to end, and their offsets."""
    memory = Memory() if memory is None else memory
    if len(memory.places) > MOST_UNITS or len(memory.ids) > MOST_CHARACTERS:
        memory.__init__()
    units, counts = [], [0]
    for t in texts:
        if t:
            units += UNIT.findall(chr(SPACE) + t.replace(" ", chr(SPACE)))
        counts.append(len(units))
    new = list(set(units) - memory.places.keys())
    if new:
        text = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), np.uint32)
        ids, off = _segment(pieces, text, np.concatenate(([0], np.cumsum([len(u) for u in new]))).astype(np.int64))
        memory.places.update(zip(new, range(len(memory.places), len(memory.places) + len(new)), strict=True))
        memory.off = np.concatenate((memory.off, off[1:] + memory.off[-1]))
        memory.ids = np.concatenate((memory.ids, ids))
    place = np.fromiter(map(memory.places.__getitem__, units), np.int64, len(units))
    count = memory.off[place + 1] - memory.off[place]
    total = np.concatenate(([0], np.cumsum(count)))
    return memory.ids[gather(memory.off[place], count)], total[counts]


def decode(pieces: Pieces, ids: np.ndarray, off: np.ndarray) -> list[str]:
    """Texts of token ids: pieces' bytes joined, without the leading space that encoding adds."""
    size = np.diff(pieces.data_off)[ids]
    raw = pieces.data[gather(pieces.data_off[:-1][ids], size)].tobytes()
    ends = np.concatenate(([0], np.cumsum(size)))[off].tolist()
    return [raw[a:b].decode("utf-8", "replace")[1:] if b > a else "" for a, b in zip(ends[:-1], ends[1:], strict=True)]


def with_tokens(documents: DataFrame, path: str = MODEL, text_col: str = "text", lists: bool = True) -> DataFrame:
    """documents with n_tokens, ids_sha256 (of the ids, comma-joined), round_trip (whether the ids
    decode to the text, U+2581 taken as a space) and, if `lists`, tokens (the ids) and decoded, in
    place of columns with these names."""
    pieces = load(path)
    new = {"n_tokens": "long", "ids_sha256": "string", "round_trip": "boolean"} | ({"tokens": "array<int>", "decoded": "string"} if lists else {})
    others = [c for c in documents.columns if c != text_col and c not in new]
    safe = documents.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(others)), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, names = Memory(), list(map(str, range(len(pieces.data_off))))
        for batch in steps(batches, "text", STEP):
            texts = batch.column("text").to_pylist()
            ids, off = encode(pieces, texts, memory)
            decoded = decode(pieces, ids, off)
            same = [(t or "").replace(chr(SPACE), " ") == d for t, d in zip(texts, decoded, strict=True)]
            shas = [hashlib.sha256(",".join([names[i] for i in ids[a:b].tolist()]).encode()).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)]
            columns = [pa.array(np.diff(off)), pa.array(shas, pa.string()), pa.array(same, pa.bool_())]
            if lists:
                columns += [pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids)), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.columns if lists else batch.columns[:-1]), *columns], names=[*(batch.schema.names if lists else batch.schema.names[:-1]), *new])

    schema = ", ".join([*(f"{n} {t}" for n, t in safe.dtypes if lists or n != "text"), *(f"{n} {t}" for n, t in new.items())])
    rows = safe.mapInArrow(run, schema)
    names = {c: f"c{i}" for i, c in enumerate(others)} | ({text_col: "text"} if lists else {})
    return rows.select(*(F.col(n).alias(c) for c, n in names.items()), *new)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the number of tokens, a digest of their ids, and whether they decode to the text."""
    return with_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), lists=False)
