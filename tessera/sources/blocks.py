"""Blocked gzip files and their positional index: the bytes, without Spark.

A blocked file is a row of gzip members of at most 64 KB, each with its size in an extra field.  A place in it is a
virtual offset: where a member begins, shifted by 16 bits, and the place in what it holds.  The index keeps, for each
sequence, the chunks of virtual offsets that each bin of positions has rows in, the least
offset of each 16 KB of positions, and the number of rows.
"""

from __future__ import annotations

import gzip
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import fs

#: Fixed values of the formats: bytes of text in a block, the block that ends a file, the bin that holds counts,
#: the bits of a window of positions, and the first bin of each size.
TEXT = 65280
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
COUNTS_BIN, WINDOW_BITS = 37450, 14
LEVELS = [(26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)]
MAGIC = b"TBI\x01"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def block(text: bytes) -> bytes:
    """One member with at most TEXT bytes."""
    squeezed = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = squeezed.compress(text) + squeezed.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(data) + 25) + data + struct.pack("<II", zlib.crc32(text), len(text))


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds positions begin (from 0) to end (exclusive)."""
    for bits, first in reversed(LEVELS):
        if begin >> bits == (end - 1) >> bits:
            return first + (begin >> bits)
    return 0


def bins_over(begin: int, end: int) -> set[int]:
    """The bins that may hold rows which overlap begin to end."""
    end = min(end, 1 << 29)
    return {0} | {first + i for bits, first in LEVELS for i in range(begin >> bits, ((end - 1) >> bits) + 1)}


@dataclass
class Sequence:
    """The index of one sequence."""

    bins: dict[int, list[list[int]]] = field(default_factory=dict)
    windows: dict[int, int] = field(default_factory=dict)
    rows: int | None = 0

    def add(self, begin: int, end: int, here: int, there: int) -> None:
        """A row at positions begin to end, which lies at virtual offsets here to there."""
        chunks = self.bins.setdefault(bin_of(begin, end), [])
        if chunks and chunks[-1][1] == here:
            chunks[-1][1] = there
        else:
            chunks.append([here, there])
        for w in range(begin >> WINDOW_BITS, ((end - 1) >> WINDOW_BITS) + 1):
            self.windows[w] = min(self.windows.get(w, here), here)
        self.rows += 1

    def join(self, later: Sequence, by: int) -> None:
        """Rows of a part that begins `by` bytes into the file."""
        for b, chunks in later.bins.items():
            self.bins.setdefault(b, []).extend([x + (by << 16), y + (by << 16)] for x, y in chunks)
        for w, at in later.windows.items():
            self.windows[w] = min(self.windows.get(w, at + (by << 16)), at + (by << 16))
        self.rows += later.rows

    def span(self) -> tuple[int, int]:
        chunks = [c for x in self.bins.values() for c in x]
        return min(c[0] for c in chunks), max(c[1] for c in chunks)

    def reach(self, begin: int, end: int) -> tuple[int, int] | None:
        """The virtual offsets between which all rows lie that overlap begin to end."""
        wanted = bins_over(begin, end)
        least = max((at for w, at in self.windows.items() if w <= begin >> WINDOW_BITS), default=0) if begin >> WINDOW_BITS in self.windows else 0
        chunks = [c for b, x in self.bins.items() if b in wanted for c in x if c[1] > least]
        return (max(least, min(c[0] for c in chunks)), max(c[1] for c in chunks)) if chunks else None


def index_bytes(sequences: dict[str, Sequence]) -> bytes:
    names = b"".join(n.encode() + b"\0" for n in sequences)
    out = [MAGIC, struct.pack("<8i", len(sequences), 2, 1, 2, 0, ord("#"), 0, len(names)), names]
    for s in sequences.values():
        out.append(struct.pack("<i", len(s.bins) + 1))
        for b, chunks in sorted(s.bins.items()):
            out.append(struct.pack("<Ii", b, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
        out.append(struct.pack("<IiQQQQ", COUNTS_BIN, 2, *s.span(), s.rows, 0))
        last, offsets = 0, []
        for w in range(max(s.windows, default=-1) + 1):
            last = s.windows.get(w, last)
            offsets.append(last)
        out.append(struct.pack(f"<i{len(offsets)}Q", len(offsets), *offsets))
    whole = b"".join(out)
    return b"".join(block(whole[i : i + TEXT]) for i in range(0, len(whole), TEXT)) + LAST_BLOCK


def read_index(path: str) -> dict[str, Sequence]:
    where, name = opened(path)
    with where.open_input_stream(name, compression=None) as f:
        data = gzip.decompress(f.read())
    if data[:4] != MAGIC:
        raise ValueError(f"{path} is no positional index")
    at = 4

    def take(kind: str) -> tuple:
        nonlocal at
        out = struct.unpack_from("<" + kind, data, at)
        at += struct.calcsize("<" + kind)
        return out

    n, *_, length = take("8i")
    names = data[at : at + length].split(b"\0")[:n]
    at += length
    found = {}
    for name in names:
        s = found[name.decode()] = Sequence(rows=None)
        for _ in range(take("i")[0]):
            b, chunks = take("Ii")
            each = [list(take("QQ")) for _ in range(chunks)]
            if b == COUNTS_BIN:
                s.rows = each[1][0]
            else:
                s.bins[b] = each
        s.windows = dict(enumerate(take(f"{take('i')[0]}Q")))
    return found


def lines(path: str, begin: int, end: int) -> Iterator[bytes]:
    """The lines of a blocked file from one virtual offset to before another."""
    where, name = opened(path)
    with where.open_input_file(name) as f:
        at, skip, rest = begin >> 16, begin & 0xFFFF, b""
        while at << 16 < end:
            f.seek(at)
            head = f.read(18)
            if len(head) < 18:
                break
            size = struct.unpack_from("<H", head, 16)[0] + 1
            text = zlib.decompress(f.read(size - 18)[:-8], -15)
            text = text[skip : end & 0xFFFF if at == end >> 16 else None]
            at, skip = at + size, 0
            *whole, rest = (rest + text).split(b"\n")
            yield from whole
        if rest:
            yield rest


class Writer:
    """Rows into blocks of a stream, and their index."""

    def __init__(self, stream):
        self.stream, self.at, self.text, self.index = stream, 0, bytearray(), {}

    def add(self, chrom: str, begin: int, end: int, line: bytes) -> None:
        here = self.at << 16 | len(self.text)
        self.text += line
        while len(self.text) >= TEXT:
            self._flush()
        self.index.setdefault(chrom, Sequence()).add(begin, max(end, begin + 1), here, self.at << 16 | len(self.text))

    def _flush(self) -> None:
        data = block(bytes(self.text[:TEXT]))
        del self.text[:TEXT]
        self.stream.write(data)
        self.at += len(data)

    def close(self) -> int:
        while self.text:
            self._flush()
        return self.at
