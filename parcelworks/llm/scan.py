"""Words of whole texts, found and hashed with numpy over the bytes of Arrow batches.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. All arrays are made for a slice of a batch, about half a megabyte of text, so a task's memory
follows neither the batch nor the table; a longer text is a slice of its own.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 500_000
WORD = np.ones(256, dtype=bool)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_FACTOR = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, length: int) -> np.ndarray:
    """Powers of the factor, or of its inverse modulo 2**64."""
    known = _powers.get(kind)
    if known is None or len(known) < length:
        base = _FACTOR if kind == "up" else pow(_FACTOR, -1, 2**64)
        steps = np.full(max(length, 2 * SLICE_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return known


def mixed(values: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread evenly; a permutation."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]``; equal runs hash alike wherever they are."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power("up", len(values))[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power("down", len(values) + 1)[starts])


class Words:
    """The words of a slice of texts: byte spans, hashes, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashes: bool = True):
        self.data, self.offsets = data, offsets
        inside = WORD[data]
        first = inside.copy()
        last = inside.copy()
        if len(data):
            follows = inside[:-1].copy()
            precedes = inside[1:].copy()
            edges = offsets[(offsets > 0) & (offsets < len(data))]
            follows[edges - 1] = False
            precedes[edges - 1] = False
            first[1:] &= ~follows
            last[:-1] &= ~precedes
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: words of text i are those from bounds[i] up to bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hash = self._hashes(lower) if hashes else None

    def _hashes(self, lower: bool) -> np.ndarray:
        table = _BYTE[LOWER] if lower else _BYTE
        found = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(found):
            begin = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, begin + SLICE_BYTES, "right")))
            values = table[self.data[begin : self.ends[to - 1]]]
            found[at:to] = runs_hash(values, self.starts[at:to] - begin, self.ends[at:to] - begin)
            at = to
        return found

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of ``size`` words within one text."""
        ends = np.repeat(self.bounds[1:], np.diff(self.bounds))
        starts = np.flatnonzero(np.arange(len(ends)) + size <= ends)
        return starts, runs_hash(self.hash, starts, starts + size)

    def shingles(self, size: int) -> list[np.ndarray]:
        """Each text's distinct hashes of ``size`` words, ascending.

        A text with fewer words has one, of all its words; a text without words has none.
        """
        counts = np.diff(self.bounds)
        starts, hashes = self.windows(size)
        edges = np.searchsorted(starts, self.bounds)
        short = np.flatnonzero((counts > 0) & (counts < size))
        whole = dict(zip(short.tolist(), runs_hash(self.hash, self.bounds[short], self.bounds[short + 1])))
        return [
            np.unique(hashes[a:b]) if a < b else np.array([whole[i]] if i in whole else [], dtype=np.uint64)
            for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist()))
        ]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column one after another, and each text's offset; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text, one row at least."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    # workers live on between tasks, and share an executor's memory
    pa.default_memory_pool().release_unused()


def free_name(taken: list[str], name: str) -> str:
    """``name`` with as many underscores before it as it takes to be no column's, whatever its case."""
    known = {one.lower() for one in taken}
    while name.lower() in known:
        name = "_" + name
    return name


def text_list(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
