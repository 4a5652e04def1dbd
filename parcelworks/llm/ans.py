"""Static range asymmetric numeral coding of token ids, in independent interleaved blocks.

A segment is a run of ids with one frequency table, shared by its blocks. Each block has its own
words, a starting state per lane, and a checksum: its entry in the segment's block table is a
checkpoint from which it decodes alone. All lanes of all blocks advance together as numpy arrays.

Layout of a segment, numbers little-endian: eight bytes ``PWRANS1\\0``; nine unsigned 64-bit
numbers (documents, ids, symbols, bits of the frequency scale, lanes, steps, blocks, words, and
the crc32 of all that follows); per document its key (int64), number of ids (int64) and flags
(uint8: 1 continues the document before, 2 has no key); per symbol its id and frequency (uint32);
per block the number of words, crc32 of its ids (uint32) and lane states (int64 each); the words
(uint32).
"""

import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"PWRANS1\0"
LANES = 64
BLOCK_IDS = 65_536
LOW = 1 << 31
HEAD = 9


def _table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols, their scaled frequencies (all above 0, sum 2**bits), each id's symbol, and bits."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    bits = max(12, int(len(symbols) - 1).bit_length() + 4)
    total = 1 << bits
    scaled = np.maximum(1, counts * total // max(1, counts.sum()))
    left = total - int(scaled.sum())
    by_size = np.argsort(-scaled, kind="stable")
    if left >= 0:
        scaled[by_size[0]] += left
    else:
        for at in by_size:
            less = min(-left, int(scaled[at]) // 2)
            scaled[at] -= less
            left += less
            if not left:
                break
    place = np.zeros(int(symbols[-1]) + 1, dtype=np.int64)
    place[symbols] = np.arange(len(symbols))
    return symbols, scaled.astype(np.int64), place[ids], bits


def encode(keys: np.ndarray, lengths: np.ndarray, flags: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: the ids of its documents one after another."""
    blocks = max(1, -(-len(ids) // BLOCK_IDS))
    steps = -(-len(ids) // (blocks * LANES))
    if len(ids):
        symbols, frequency, coded, bits = _table(ids)
    else:
        symbols, frequency, coded, bits = (np.zeros(0, dtype=np.int64),) * 3 + (12,)
    padded = np.zeros(blocks * steps * LANES, dtype=np.int64)
    padded[: len(coded)] = coded
    padded = padded.reshape(blocks, steps, LANES)
    before = np.cumsum(frequency) - frequency
    limit = frequency << (31 - bits + 32)
    state = np.full((blocks, LANES), LOW, dtype=np.int64)
    words = np.zeros((blocks, steps, LANES), dtype=np.uint32)
    used = np.zeros((blocks, steps, LANES), dtype=bool)
    for step in range(steps - 1, -1, -1):
        symbol = padded[:, step]
        often = frequency[symbol]
        full = state >= limit[symbol]
        used[:, step] = full
        words[:, step] = state & 0xFFFFFFFF
        state = np.where(full, state >> 32, state)
        whole, rest = np.divmod(state, often)
        state = (whole << bits) + rest + before[symbol]
    sizes = used.sum(axis=(1, 2))
    size = steps * LANES
    crcs = [zlib.crc32(ids[b * size : (b + 1) * size].astype("<u4").tobytes()) for b in range(blocks)]
    body = b"".join(
        np.ascontiguousarray(values).astype(kind).tobytes()
        for values, kind in (
            (keys, "<i8"), (lengths, "<i8"), (flags, "u1"), (symbols, "<u4"), (frequency, "<u4"),
            (sizes, "<u4"), (np.array(crcs), "<u4"), (state, "<i8"), (words[used], "<u4"),
        )
    )
    head = [len(keys), len(ids), len(symbols), bits, LANES, steps, blocks, int(sizes.sum()), zlib.crc32(body)]
    return MAGIC + np.array(head, dtype="<u8").tobytes() + body


class Segment:
    """A segment's header and document index; ``ids()`` decodes it."""

    def __init__(self, data: memoryview, at: int):
        if bytes(data[at : at + 8]) != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        head = np.frombuffer(data, "<u8", HEAD, at + 8).astype(np.int64).tolist()
        documents, self.n_ids, n_symbols, self.bits, self.lanes, self.steps, self.blocks, n_words, crc = head
        self.start = place = at + 8 + 8 * HEAD

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal place
            found = np.frombuffer(data, kind, count, place)
            place += found.nbytes
            return found

        self.keys, self.lengths, self.flags = take("<i8", documents), take("<i8", documents), take("u1", documents)
        self.symbols, self.frequency = take("<u4", n_symbols), take("<u4", n_symbols).astype(np.int64)
        self.sizes, self.crcs = take("<u4", self.blocks).astype(np.int64), take("<u4", self.blocks)
        self.states = take("<i8", self.blocks * self.lanes).reshape(self.blocks, self.lanes)
        self.words = take("<u4", n_words)
        self.end, self.data, self.crc = place, data, crc

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of blocks ``first`` up to ``last``, all by default, after checking them."""
        if zlib.crc32(self.data[self.start : self.end]) != self.crc:
            raise ValueError("a segment's checksum does not match")
        last = self.blocks if last is None else last
        if not self.n_ids:
            return np.zeros(0, dtype=np.uint32)
        before = np.cumsum(self.frequency) - self.frequency
        slot_symbol = np.repeat(np.arange(len(self.frequency), dtype=np.int32), self.frequency)
        mask = (1 << self.bits) - 1
        state = self.states[first:last].copy()
        place = (np.cumsum(self.sizes) - self.sizes)[first:last].copy()
        words = np.append(self.words, np.uint32(0)).astype(np.int64)
        found = np.empty((last - first, self.steps, self.lanes), dtype=np.int32)
        for step in range(self.steps):
            slot = state & mask
            symbol = slot_symbol[slot]
            found[:, step] = symbol
            state = self.frequency[symbol] * (state >> self.bits) + slot - before[symbol]
            empty = state < LOW
            rank = np.cumsum(empty, axis=1)
            at = np.where(empty, place[:, None] + rank - 1, len(words) - 1)
            state = np.where(empty, (state << 32) | words[at], state)
            place += rank[:, -1]
        size = self.steps * self.lanes
        ids = self.symbols[found.reshape(-1)][: self.n_ids - first * size]
        for block in range(first, last):
            part = ids[(block - first) * size : (block - first + 1) * size]
            if zlib.crc32(part.astype("<u4").tobytes()) != int(self.crcs[block]):
                raise ValueError(f"block {block}'s checksum does not match")
        return ids


def segments(data: bytes, separator: int = 1) -> Iterator[Segment]:
    """The segments of a file, one after another with ``separator`` bytes behind each."""
    view, at = memoryview(data), 0
    while at < len(view):
        segment = Segment(view, at)
        yield segment
        at = segment.end + separator
