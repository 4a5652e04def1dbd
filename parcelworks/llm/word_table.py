"""What is known of words, by their hashes: one look-up per distinct word of a slice of texts, in numpy.

A word has an entry with a run of values in each column, such as its token ids. Entries are found by
a hash and checked by a second one; a word on which only the first agrees is reported as not found.
When more than ``limit`` entries are held, those used last stay.
"""

from collections.abc import Callable

import numpy as np

from parcelworks.llm.scan import Words, mixed, runs_hash

LIMIT = 300_000
_BYTE = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, 256, dtype=np.uint64)


class Ragged:
    """Runs of values, one per entry."""

    def __init__(self, dtype):
        self.data, self.used = np.zeros(1024, dtype=dtype), 0
        self.starts, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(flat) > len(self.data):
            grown = np.zeros(max(2 * len(self.data), self.used + len(flat)), dtype=self.data.dtype)
            grown[: self.used] = self.data[: self.used]
            self.data = grown
        self.data[self.used : self.used + len(flat)] = flat
        ends = self.used + np.cumsum(lengths)
        self.starts = np.concatenate([self.starts, ends - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used += len(flat)

    def take(self, entries: np.ndarray, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The runs of ``entries`` one after another, without their first ``skip`` values, and their lengths."""
        starts, lengths = self.starts[entries], self.lengths[entries]
        if skip is not None:
            starts, lengths = starts + skip, lengths - skip
        ends = np.cumsum(lengths)
        places = np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.data[places], lengths

    def keep(self, entries: np.ndarray) -> None:
        flat, lengths = self.take(entries)
        self.__init__(self.data.dtype)
        self.append(flat, lengths)


class WordTable:
    """Entries of words.

    ``encode(words, kind)`` gives chunks for new words of one kind: their places in ``words``, and
    for each column the runs one after another and their lengths. A word that is in no chunk cannot
    be used by itself; its entry says so in ``bad``.
    """

    def __init__(self, encode: Callable, dtypes: list, limit: int = LIMIT):
        self.encode, self.limit = encode, limit
        self.columns = [Ragged(dtype) for dtype in dtypes]
        self.keys, self.entry = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.checks, self.used = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.bad = np.zeros(0, dtype=bool)
        self.now = 0

    def _forget(self) -> None:
        """Keep the half of the limit that was used last."""
        kept = np.sort(np.argsort(-self.used, kind="stable")[: self.limit // 2])
        places = np.full(len(self.used), -1)
        places[kept] = np.arange(len(kept))
        there = places[self.entry] >= 0
        self.keys, self.entry = self.keys[there], places[self.entry[there]]
        self.checks, self.used, self.bad = self.checks[kept], self.used[kept], self.bad[kept]
        for column in self.columns:
            column.keep(kept)

    def _add(self, words: list[bytes], kinds: np.ndarray, checks: np.ndarray) -> np.ndarray:
        found = np.full(len(words), -1)
        first = at = len(self.used)
        for kind in np.unique(kinds).tolist():
            chosen = np.flatnonzero(kinds == kind)
            for places, runs in self.encode([words[place] for place in chosen.tolist()], kind):
                for column, (flat, lengths) in zip(self.columns, runs, strict=True):
                    column.append(flat, lengths)
                found[chosen[places]] = at + np.arange(len(places))
                at += len(places)
        bad = np.flatnonzero(found < 0)
        for column in self.columns:
            column.append(column.data[:0], np.zeros(len(bad), dtype=np.int64))
        found[bad] = at + np.arange(len(bad))
        order = np.argsort(found)
        self.checks = np.concatenate([self.checks, checks[order]])
        self.used = np.concatenate([self.used, np.full(len(words), self.now)])
        self.bad = np.concatenate([self.bad, np.arange(first, first + len(words)) >= at])
        return found

    def entries(self, words: Words, kinds: np.ndarray | None = None) -> np.ndarray:
        """The entry of each word; -1 where it has none to itself. They hold until the next call."""
        if len(self.used) > self.limit:
            self._forget()
        self.now += 1
        if not len(words.starts):
            return np.zeros(0, dtype=np.int64)
        kinds = np.zeros(len(words.starts), dtype=np.int64) if kinds is None else kinds
        keys = words.hash ^ mixed(kinds.astype(np.uint64) + np.uint64(99))
        check = runs_hash(_BYTE[words.data], words.starts, words.ends)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, unique)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == unique[known]
        found = np.full(len(unique), -1)
        found[known] = self.entry[place[known]]
        if len(new := np.flatnonzero(~known)):
            at = first[new]
            raw = words.data.tobytes()
            spelled = [raw[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())]
            found[new] = self._add(spelled, kinds[at], check[at])
            self.keys = np.insert(self.keys, place[new], unique[new])
            self.entry = np.insert(self.entry, place[new], found[new])
        self.used[found] = self.now
        own = found[inverse]
        return np.where((self.checks[own] == check) & ~self.bad[own], own, -1)
