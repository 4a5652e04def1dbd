"""Repeated passages of thirteen words by digests of windows, partitioned by prefixes.

No suffix trees are built: a 64-bit digest of a suffix's first thirteen words, its window, stands
for the suffix, and equal digests are taken for equal windows. A suffix's group is named by a prefix of its words: one word, or two, four or all thirteen where a shorter prefix
begins too many suffixes for one task. Counts of prefixes, in 65,536 classes a depth, are all
that comes to the driver; from them each class of prefixes gets its group of suffixes.

A task holds one group and sorts its digests. Each run of equal ones is a repeat, a "node", and its
places, the "leaves", are the occurrences. A leaf whose document is not the node's smallest begins
a window that is to go. Longer repeats add no such window, so maximal repeats are not made.

A window that alone fills a group, such as a notice in a third of all documents, would not fit a
task however deep its prefix. Those few are found by counting (combined on the map side), and with
the smallest document of each, a table bounded by the number of suffixes over the group size, they
are decided where the texts are read. Whole texts are dealt once, compressed, to meet the windows.
"""

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.ordering import partitions
from parcelworks.llm.scan import Words, batch_of, mixed, runs_hash, slices, text_bytes

WINDOW = 13
DEPTHS = (1, 2, 4)
CLASSES = 1 << 16
GROUP_SUFFIXES = 1_500_000
SLICE_BYTES = 4_000_000
DEEPER = -1


@dataclass
class Routes:
    """Which group the suffixes of each class of prefixes go to, depth by depth.

    ``levels`` holds for each depth an array with the group of each class, or ``DEEPER``. What is
    left at the full depth goes to one of ``rest`` groups, from ``first_rest`` on, but for the
    windows in ``heavy_digests``, whose smallest documents are ``heavy_documents``.
    """

    window: int = WINDOW
    depths: list[int] = field(default_factory=list)
    levels: list[np.ndarray] = field(default_factory=list)
    groups: int = 0
    rest: int = 1
    heavy_digests: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    heavy_documents: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))


def _classes(words: Words, starts: np.ndarray, depth: int) -> np.ndarray:
    return (runs_hash(words.hash, starts, starts + depth) >> np.uint64(48)).astype(np.int64)


def _starts(words: Words, window: int) -> np.ndarray:
    ends = np.repeat(words.bounds[1:], np.diff(words.bounds))
    return np.flatnonzero(np.arange(len(ends)) + window <= ends)


def _deeper(words: Words, starts: np.ndarray, routes: Routes) -> np.ndarray:
    """The suffixes whose group no level so far decides."""
    for depth, level in zip(routes.depths, routes.levels):
        starts = starts[level[_classes(words, starts, depth)] == DEEPER]
    return starts


def _class_counts(routes: Routes, depth: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                words = Words(*text_bytes(part.column("text")))
                starts = _deeper(words, _starts(words, routes.window), routes)
                counts += np.bincount(_classes(words, starts, depth), minlength=CLASSES)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["class", "suffixes"])

    return rows


def _heavy_counts(routes: Routes) -> Callable:
    """(digest, times, smallest document) of the windows that no level decides, counted by task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                words = Words(*text_bytes(part.column("text")))
                starts = _deeper(words, _starts(words, routes.window), routes)
                digests = runs_hash(words.hash, starts, starts + routes.window)
                owner = np.searchsorted(words.bounds, starts, "right") - 1
                documents = part.column("doc_id").to_numpy(zero_copy_only=False)[owner]
                order = np.argsort(digests, kind="stable")
                digests, documents = digests[order], documents[order]
                first = np.flatnonzero(np.append(True, digests[1:] != digests[:-1])) if len(digests) else order
                least = np.minimum.reduceat(documents, first) if len(first) else documents
                times = np.diff(np.append(first, len(digests)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests[first].view(np.int64)), pa.array(times), pa.array(least.astype(np.int64))],
                    ["digest", "times", "least"],
                )

    return rows


def plan_groups(
    docs: DataFrame, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES, depths: tuple[int, ...] = DEPTHS
) -> Routes:
    """Groups of at most about ``group_suffixes`` suffixes, for documents (doc_id, text) with keys."""
    routes = Routes(window)
    for depth in [d for d in depths if d < window] + [window]:
        counted = docs.mapInArrow(_class_counts(routes, depth), "class long, suffixes long")
        counts = np.zeros(CLASSES, dtype=np.int64)
        for row in counted.groupBy("class").agg(F.sum("suffixes").alias("suffixes")).collect():
            counts[row["class"]] = row["suffixes"]
        if not routes.levels:
            # no larger than the limit, and small enough to keep all tasks at work
            group_suffixes = min(group_suffixes, max(20_000, int(counts.sum()) // (2 * partitions(docs.sparkSession))))
        level = np.full(CLASSES, DEEPER, dtype=np.int32)
        held = group_suffixes
        for one in np.flatnonzero(counts <= group_suffixes).tolist():
            if held + counts[one] > group_suffixes:
                routes.groups += 1
                held = 0
            held += counts[one]
            level[one] = routes.groups - 1
        routes.depths.append(depth)
        routes.levels.append(level)
        left = int(counts[level == DEEPER].sum())
        if not left:
            return routes
    routes.rest = -(-left // group_suffixes)
    counted = docs.mapInArrow(_heavy_counts(routes), "digest long, times long, least long")
    heavy = (
        counted.groupBy("digest").agg(F.sum("times").alias("times"), F.min("least").alias("least"))
        .filter(F.col("times") > group_suffixes // 8).select("digest", "least").collect()
    )
    digests = np.array([row["digest"] for row in heavy], dtype=np.int64).view(np.uint64)
    order = np.argsort(digests)
    routes.heavy_digests = digests[order]
    routes.heavy_documents = np.array([row["least"] for row in heavy], dtype=np.int64)[order]
    return routes


def _planes(values: np.ndarray, width: int) -> bytes:
    """Differences of values, byte by byte: the upper bytes are mostly zeros and compress well."""
    steps = np.diff(values, prepend=values[:1] * 0).astype(f"<i{width}")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, width).T).tobytes()


def _unplaned(data: memoryview, count: int, width: int) -> np.ndarray:
    bytes_ = np.frombuffer(data[: count * width], dtype=np.uint8).reshape(width, count)
    return np.cumsum(np.ascontiguousarray(bytes_.T).view(f"<i{width}").ravel().astype(np.int64))


def _suffix_rows(routes: Routes, buckets: int) -> Callable:
    """Suffixes by group, packed: (group, 0, block), and windows decided at once: (-1, bucket, block)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                words = Words(*text_bytes(part.column("text")))
                documents = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                starts = _starts(words, routes.window)
                if not len(starts):
                    continue
                group = np.full(len(starts), DEEPER, dtype=np.int64)
                for depth, level in zip(routes.depths, routes.levels):
                    open_ = np.flatnonzero(group == DEEPER)
                    group[open_] = level[_classes(words, starts[open_], depth)]
                digests = runs_hash(words.hash, starts, starts + routes.window)
                left = np.flatnonzero(group == DEEPER)
                if len(left):
                    group[left] = routes.groups + (mixed(digests[left]) % np.uint64(routes.rest)).astype(np.int64)
                if len(routes.heavy_digests):
                    at = np.searchsorted(routes.heavy_digests, digests[left])
                    at = np.minimum(at, len(routes.heavy_digests) - 1)
                    heavy = left[routes.heavy_digests[at] == digests[left]]
                    at = np.searchsorted(routes.heavy_digests, digests[heavy])
                    owner = np.searchsorted(words.bounds, starts[heavy], "right") - 1
                    later = documents[owner] > routes.heavy_documents[at]
                    decided = list(_found(documents[owner[later]], (starts[heavy] - words.bounds[owner])[later], buckets))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([-1] * len(decided), pa.int32()),
                            pa.array([bucket for bucket, _ in decided], pa.int32()),
                            pa.array([packed for _, packed in decided], pa.binary()),
                        ],
                        ["group", "bucket", "block"],
                    )
                    group[heavy] = -2
                order = np.argsort(group, kind="stable")
                edges = np.flatnonzero(np.diff(group[order], prepend=-3))
                names, blocks = [], []
                for a, b in zip(edges.tolist(), np.append(edges[1:], len(order)).tolist()):
                    if group[order[a]] < 0:
                        continue
                    some = order[a:b]
                    names.append(int(group[some[0]]))
                    head = struct.pack("<qq", len(documents), len(some))
                    blocks.append(
                        head + _planes(documents, 8) + _planes(words.bounds[:-1], 4) + _planes(starts[some], 4)
                        + digests[some].tobytes()
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), pa.array([0] * len(names), pa.int32()), pa.array(blocks, pa.binary())],
                    ["group", "bucket", "block"],
                )

    return rows


def bucket_of(documents: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket in which a document's text meets its windows."""
    return (mixed(documents.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _found(documents: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Windows to go, packed for each bucket of documents that has any."""
    bucket = bucket_of(documents, buckets)
    order = np.lexsort((places, documents, bucket))
    bucket, documents, places = bucket[order], documents[order], places[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(edges.tolist(), np.append(edges[1:], len(bucket)).tolist()):
        yield int(bucket[a]), struct.pack("<q", b - a) + _planes(documents[a:b], 8) + _planes(places[a:b], 4)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    count, view = struct.unpack_from("<q", packed)[0], memoryview(packed)[8:]
    return _unplaned(view, count, 8), _unplaned(view[8 * count :], count, 4)


def repeat_nodes(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of a group's leaves by path, and where each node at the window's depth begins."""
    order = np.argsort(digests, kind="stable")
    ordered = digests[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))


def _later_windows(buckets: int) -> Callable:
    """The subtree of each group, and the leaves whose document is not their node's smallest, by bucket."""

    def subtree(held: list[bytes]) -> pa.RecordBatch:
        documents, places, digests = [], [], []
        for block in held:
            n_documents, n = struct.unpack_from("<qq", block)
            view = memoryview(block)[16:]
            keys = _unplaned(view, n_documents, 8)
            bounds = _unplaned(view[8 * n_documents :], n_documents, 4)
            starts = _unplaned(view[12 * n_documents :], n, 4)
            digests.append(np.frombuffer(view[12 * n_documents + 4 * n :], dtype=np.uint64))
            # of documents without words, which begin where the next one does, none is meant
            owner = np.searchsorted(bounds, starts, "right") - 1
            documents.append(keys[owner])
            places.append((starts - bounds[owner]).astype(np.int32))
        documents, places, digests = map(np.concatenate, (documents, places, digests))
        order, first = repeat_nodes(digests)
        ordered = documents[order]
        least = np.repeat(np.minimum.reduceat(ordered, first), np.diff(np.append(first, len(order))))
        later = order[ordered > least]
        return packed_rows(list(_found(documents[later], places[later], buckets)))

    def packed_rows(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([one for one, _ in found], pa.int32()), pa.array([one for _, one in found], pa.binary())],
            ["bucket", "windows"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []
        for batch in batches:
            for group, bucket, block in zip(*[batch.column(n).to_pylist() for n in ("group", "bucket", "block")]):
                if group == -1:
                    yield packed_rows([(bucket, block)])
                    continue
                if group != name and held:
                    yield subtree(held)
                    held = []
                name = group
                held.append(block)
        if held:
            yield subtree(held)

    return rows


def repeated_windows(
    docs: DataFrame,
    buckets: int,
    window: int = WINDOW,
    group_suffixes: int = GROUP_SUFFIXES,
    depths: tuple[int, ...] = DEPTHS,
) -> DataFrame:
    """(bucket, windows): windows that also start in a document with a smaller key, by bucket of documents.

    A bucket has a row per group that found any; ``windows`` holds keys and first words, packed.
    """
    routes = plan_groups(docs, window, group_suffixes, depths)
    suffixes = docs.mapInArrow(_suffix_rows(routes, buckets), "group int, bucket int, block binary")
    salted = suffixes.selectExpr("*", "CASE WHEN group < 0 THEN xxhash64(block) ELSE group END AS dealt")
    grouped = salted.repartition(routes.groups + routes.rest, F.col("dealt")).sortWithinPartitions("group")
    return grouped.drop("dealt").mapInArrow(_later_windows(buckets), "bucket int, windows binary")


KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
)


def _packed_texts(buckets: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                packed = []
                for text in part.column("text").to_pylist():
                    text = (text or "").encode("utf-8")
                    packed.append(struct.pack("<q", len(text)) + pa.compress(text, "zstd", asbytes=True))
                # documents without a key are spread out
                keys = part.column("doc_id").fill_null(-(2**63)).to_numpy(zero_copy_only=False)
                spread = np.where(keys == -(2**63), np.arange(len(keys)), keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket_of(spread, buckets)), part.column("doc_id"), pa.array(packed, pa.binary())],
                    ["bucket", "doc_id", "data"],
                )

    return rows


def _kept_rows(window: int) -> Callable:
    def kept(key: int | None, packed: bytes, starts: np.ndarray) -> tuple:
        size = struct.unpack_from("<q", packed)[0]
        words = pa.decompress(packed[8:], size, "zstd", asbytes=True).split()
        starts = starts[starts + window <= len(words)]
        if not len(starts):
            return key, len(words), 0, b" ".join(words).decode("utf-8")
        gone = np.zeros(len(words) + 1, dtype=np.int32)
        np.add.at(gone, starts, 1)
        np.add.at(gone, starts + window, -1)
        keep = np.cumsum(gone[:-1]) == 0
        return key, len(words), int(len(words) - keep.sum()), b" ".join(compress(words, keep.tolist())).decode("utf-8")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A bucket: first all its windows, then its texts one after another."""
        found, documents, places = [], None, None
        nothing = np.zeros(0, dtype=np.int64)
        for batch in batches:
            out, held = [], 0
            for doc, data, windows in zip(*[batch.column(name).to_pylist() for name in ("doc_id", "data", "windows")]):
                if windows is not None:
                    found.append(_unpacked(windows))
                    continue
                if documents is None:
                    documents = np.concatenate([one for one, _ in found] or [nothing])
                    places = np.concatenate([one for _, one in found] or [nothing])
                    order = np.argsort(documents, kind="stable")
                    documents, places, found = documents[order], places[order], []
                starts = nothing
                if doc is not None:
                    starts = places[np.searchsorted(documents, doc) : np.searchsorted(documents, doc, "right")]
                out.append(kept(doc, data, starts))
                held += len(data)
                if held > SLICE_BYTES:
                    yield batch_of(KEPT, **dict(zip(KEPT.names, zip(*out))))
                    out, held = [], 0
            if out:
                yield batch_of(KEPT, **dict(zip(KEPT.names, zip(*out))))

    return rows


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    group_suffixes: int = GROUP_SUFFIXES,
    depths: tuple[int, ...] = DEPTHS,
) -> DataFrame:
    """Per document: key, numbers of words and of removed ones, and the kept words joined by spaces.

    A word goes if a window of thirteen words that covers it also starts in a document with a
    smaller key, by the texts as given. Keys are unique where they are not null; a document
    without a key keeps its words and removes no others. A null text has no words; an empty table
    gives no row. Other columns are not read.
    """
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    named = narrow.filter("doc_id IS NOT NULL")
    buckets = partitions(docs.sparkSession)
    found = repeated_windows(named, buckets, window, group_suffixes, depths)
    texts = narrow.mapInArrow(_packed_texts(buckets), "bucket int, doc_id long, data binary")
    both = texts.selectExpr("bucket", "doc_id", "data", "CAST(NULL AS binary) AS windows").union(
        found.selectExpr("bucket", "CAST(NULL AS long)", "CAST(NULL AS binary)", "windows")
    )
    met = both.repartitionById(buckets, F.col("bucket")).sortWithinPartitions(F.expr("windows IS NULL"))
    return met.mapInArrow(_kept_rows(window), "doc_id long, n_words long, n_removed long, kept_text string")
