"""Near-duplicate documents by min-max hashing, every link confirmed on the full shingle sets.

A document's set holds the hashes of its distinct runs of five lower-cased words. For each
permutation both the smallest and the largest image of the set are kept: either agrees between
two sets with the probability of their Jaccard similarity, so a permutation's one evaluation per
shingle gives two values of the signature. Four values make a band, minima and maxima in bands
of their own. Sets that share a band are candidates.

Documents with equal sets are one class, and only its smallest key goes on. In a band's bucket the
smallest key is compared with all others first, which is as many pairs as members. Buckets that
still hold documents of different groups are then gone through once more: all pairs across their
groups are compared where they lie, large buckets block by block, and only the links found leave
the task. So no link found by a band is lost for want of a common partner. Signatures sort out the pairs far below the threshold; all
others are compared on their sets. At a similarity of 0.75 a pair shares none of the 40 bands
with a probability of 2.5e-7.
"""

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.groups import components, stored
from parcelworks.llm.scan import Words, batch_of, mixed, slices, text_bytes

SHINGLE = 5
PERMUTATIONS = 80
BAND_VALUES = 4
PERCENT = 75
#: pairs whose signatures agree in a smaller share cannot be links: nearly six deviations below 0.75
LEAST_AGREEMENT = 0.55
#: most documents and shingles of a block
BLOCK = 4096
BLOCK_SHINGLES = 4_000_000

_random = np.random.Generator(np.random.PCG64(7))
_FLIP = _random.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)[:, None]
_TIMES = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_BAND = mixed(np.arange(2 * PERMUTATIONS // BAND_VALUES, dtype=np.uint64) + np.uint64(1))


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the minimum under each permutation, then of the maximum under each."""
    low = np.full(PERMUTATIONS, 2**64 - 1, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        images = (shingles[None, at : at + 4096] ^ _FLIP) * _TIMES
        np.minimum(low, images.min(axis=1), out=low)
        np.maximum(high, images.max(axis=1), out=high)
    return (mixed(np.concatenate([low, high])) >> np.uint64(48)).astype(np.uint16)


def buckets(values: np.ndarray) -> np.ndarray:
    """The bucket of each band; no two bands share buckets."""
    return mixed(values.view(np.uint64) ^ _BAND).view(np.int64)


SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("class_key", pa.binary()),
        ("signature", pa.binary()), ("buckets", pa.list_(pa.int64())),
    ]
)
SIGNED_SQL = "doc_id long, n_shingles long, class_key binary, signature binary, buckets array<long>"


def _signed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for part in slices(batch):
            words = Words(*text_bytes(part.column("text")), lower=True)
            sizes, keys, signatures, places = [], [], [], []
            for shingles in words.shingles(SHINGLE):
                sizes.append(len(shingles))
                if len(shingles):
                    values = signature(shingles)
                    keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    signatures.append(values.tobytes())
                    places.append(buckets(values))
                else:
                    keys.append(None)
                    signatures.append(None)
                    places.append(None)
            yield batch_of(
                SIGNED, doc_id=part.column("doc_id"), n_shingles=sizes, class_key=keys,
                signature=signatures, buckets=places,
            )


def _agreeing(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pairs:
        if not len(batch):
            continue
        one, two = (
            np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=np.uint16).reshape(len(batch), -1)
            for name in ("one", "two")
        )
        near = (one == two).mean(axis=1) >= LEAST_AGREEMENT
        yield batch.select(["a", "b"]).filter(pa.array(near))


@lru_cache(maxsize=64)
def _unpacked_set(packed: bytes) -> np.ndarray:
    text = np.frombuffer(pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd"), dtype=np.uint8)
    return Words(text, np.array([0, len(text)]), lower=True).shingles(SHINGLE)[0]


def _linked(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets are similar enough to ``one``; all are ascending and not empty."""
    sizes = np.array([len(other) for other in others])
    every = np.concatenate(others)
    place = np.minimum(np.searchsorted(one, every), len(one) - 1)
    common = np.add.reduceat((one[place] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= percent * (len(one) + sizes - common)


def _links_across(percent: int) -> Callable:
    """Links between groups within a bucket or two of its blocks, one per pair of groups and block.

    A pair is compared in the bucket of the first band that it shares, and nowhere else, so in all
    buckets together once. Rows come ordered by bucket and blocks; two blocks at most are held.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(held: list[dict]) -> pa.RecordBatch:
        ids = np.array([row["id"] for row in held])
        groups = np.array([row["component"] for row in held])
        blocks = np.array([row["block"] for row in held])
        sizes = np.array([row["n_shingles"] for row in held])
        values = np.frombuffer(b"".join(row["signature"] for row in held), dtype=np.uint16).reshape(len(held), -1)
        earlier = values.view(np.uint64)[:, : held[0]["band"]]
        same_block = held[0]["low"] == held[0]["high"]
        sets: dict[int, np.ndarray] = {}
        found: dict[tuple[int, int], tuple[int, int]] = {}

        def set_of(at: int) -> np.ndarray:
            if at not in sets:
                sets[at] = _unpacked_set(held[at]["packed"])
            return sets[at]

        for at in range(len(held)):
            may = (groups != groups[at]) & (ids > ids[at])
            may &= 100 * np.minimum(sizes, sizes[at]) >= percent * np.maximum(sizes, sizes[at])
            if not same_block:
                may &= blocks != blocks[at]
            others = np.flatnonzero(may)
            others = others[~(earlier[others] == earlier[at]).any(axis=1)]
            others = others[(values[others] == values[at]).mean(axis=1) >= LEAST_AGREEMENT]
            if len(others):
                for other in others[_linked(set_of(at), [set_of(one) for one in others.tolist()], percent)].tolist():
                    found.setdefault((int(groups[at]), int(groups[other])), (int(ids[at]), int(ids[other])))
        pairs = list(found.values())
        return batch_of(schema, a=[a for a, _ in pairs], b=[b for _, b in pairs])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None
        for batch in batches:
            for row in batch.to_pylist():
                now = (row["bucket"], row["low"], row["high"])
                if now != name and held:
                    yield links(held)
                    held = []
                name = now
                held.append(row)
        if held:
            yield links(held)

    return rows


def _confirmed(percent: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("one").to_pylist(), batch.column("two").to_pylist())
            links = [bool(_linked(_unpacked_set(one), [_unpacked_set(two)], percent)[0]) for one, two in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    return rows


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, limit=4_000_000):
            packed = []
            for text in part.column("text").to_pylist():
                text = (text or "").encode("utf-8")
                packed.append(len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(packed, pa.binary())], ["id", "packed"])


def _with(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with ``column`` of both sides as one and two."""
    first = table.selectExpr("id AS a", f"{column} AS one")
    second = table.selectExpr("id AS b", f"{column} AS two")
    return pairs.join(first, "a").join(second, "b").select("a", "b", "one", "two")


def near_copy_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document: key, size of its set, smallest key that links lead to, and whether it is that one.

    Keys are unique where they are not null. Sets of equal texts are equal, so copies are linked.
    A text with fewer than five words has one shingle of all of them; a null text, or one without
    words, has none and is linked with nothing, and so is a document without a key, which is kept.
    An empty table gives no row. Other columns are not read.
    """
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    signed = stored(narrow.mapInArrow(_signed_rows, SIGNED_SQL), "signatures")
    usable = signed.filter("doc_id IS NOT NULL AND class_key IS NOT NULL")
    classes = stored(
        usable.groupBy("class_key").agg(
            F.expr("min(doc_id) AS id"), F.expr("count(*) AS copies"),
            F.expr("min_by(struct(n_shingles, signature, buckets), doc_id) AS first"),
        ).selectExpr("class_key", "id", "copies", "first.n_shingles", "first.signature", "first.buckets"),
        "classes",
    )
    signatures = classes.select("id", "n_shingles", "signature")
    members = classes.select("id", "n_shingles", F.posexplode("buckets").alias("band", "bucket"))
    shared = members.groupBy("bucket").agg(F.expr("min(id) AS leader"), F.expr("count(*) AS members")).filter("members > 1")
    members = stored(members.join(shared, "bucket"), "members")
    packed = narrow.withColumnRenamed("doc_id", "id").mapInArrow(_packed_texts, "id long, packed binary")
    texts = stored(packed.join(members.select("id").distinct(), "id", "left_semi"), "candidate-texts")

    pairs = members.filter("id > leader").selectExpr("leader AS a", "id AS b").distinct()
    pairs = _with(pairs, signatures, "signature").mapInArrow(_agreeing, "a long, b long")
    links = stored(_with(pairs, texts, "packed").mapInArrow(_confirmed(percent), "a long, b long"), "links")
    groups = components(links)
    grouped = members.join(groups, "id", "left").selectExpr(
        "bucket", "band", "id", "n_shingles", "coalesce(component, id) AS component"
    )
    unlike = grouped.groupBy("bucket").agg(
        F.expr("min(component) < max(component) AS unlike"),
        F.expr(f"int(ceil(greatest(count(*) / {BLOCK}, sum(n_shingles) / {BLOCK_SHINGLES}))) AS blocks"),
    )
    # a block of a large bucket meets every other block once
    open_rows = (
        grouped.join(unlike.filter("unlike").select("bucket", "blocks"), "bucket")
        .selectExpr("*", "pmod(hash(id), blocks) AS block")
        .selectExpr("*", "explode(sequence(0, blocks - 1)) AS other")
        .selectExpr("bucket", "band", "id", "component", "block", "least(block, other) AS low", "greatest(block, other) AS high")
        .join(signatures, "id")
        .join(texts, "id")
    )
    across = (
        open_rows.repartition(F.col("bucket"), F.col("low"), F.col("high"))
        .sortWithinPartitions("bucket", "low", "high")
        .mapInArrow(_links_across(percent), "a long, b long")
    )
    groups = components(links.union(stored(across, "links-across")))

    copies = classes.filter("copies > 1").selectExpr("class_key", "id AS class_id")
    documents = signed.select("doc_id", "n_shingles", "class_key").join(copies, "class_key", "left")
    documents = documents.selectExpr("doc_id", "n_shingles", "coalesce(class_id, doc_id) AS id")
    return documents.join(groups, "id", "left").selectExpr(
        "doc_id", "n_shingles",
        "CASE WHEN doc_id IS NOT NULL THEN coalesce(component, id) END AS component_id",
        "coalesce(doc_id = coalesce(component, id), true) AS kept",
    )
