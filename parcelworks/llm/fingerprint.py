"""Document fingerprints: one-permutation MinHash, optimally densified, packed to low-order bits.

Each distinct run of five words is hashed once; the hash's high bits name a bin, and a bin keeps
its smallest hash. An empty bin takes the value of a bin drawn by a hash of its own number and the
attempt, drawn again until that bin is not empty, so that two sets with the same filled bins fill
the others alike and each filled bin is as likely to be drawn. Four low-order bits of each bin's
value, hashed once more with the bin's number, are kept, as base64. Different values agree in them once in sixteen times, which the likeness takes
out again: (agreeing - 1/16) / (1 - 1/16), between 0 and 1.
"""

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.ordering import cuts, part_of, partitions
from parcelworks.llm.scan import Words, batch_of, mixed

SHINGLE = 5
BINS = 512
BITS = 4
BATCH_BYTES = 500_000
EMPTY = np.uint64(2**64 - 1)
_BIN = mixed(np.arange(BINS, dtype=np.uint64))
_targets: list[np.ndarray] = []


def _target(attempt: int) -> np.ndarray:
    """The bin that each empty bin draws at an attempt."""
    while len(_targets) <= attempt:
        number = np.arange(BINS, dtype=np.uint64) + np.uint64(BINS * (len(_targets) + 1))
        _targets.append((mixed(number) % np.uint64(BINS)).astype(np.int64))
    return _targets[attempt]


def sketches(shingles: list[np.ndarray]) -> list[bytes]:
    """The packed bins of each set; an empty set has no bytes."""
    sizes = np.array([len(one) for one in shingles])
    if not sizes.sum():
        return [b""] * len(shingles)
    hashes = np.concatenate(shingles)
    document = np.repeat(np.arange(len(shingles)), sizes)
    place = document * BINS + (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    bins = np.full(len(shingles) * BINS, EMPTY)
    np.minimum.at(bins, place, hashes)
    bins = bins.reshape(len(shingles), BINS)
    filled = bins != EMPTY
    values = bins.copy()
    row, column = np.nonzero(~filled & (sizes > 0)[:, None])
    attempt = 0
    while len(row):
        drawn = _target(attempt)[column]
        found = filled[row, drawn]
        values[row[found], column[found]] = bins[row[found], drawn[found]]
        row, column = row[~found], column[~found]
        attempt += 1
    # other bits of a value in each bin, so that bins filled alike do not agree by chance together
    low = (mixed(values ^ _BIN) & np.uint64(2**BITS - 1)).astype(np.uint8)
    packed = low[:, 0::2] << BITS | low[:, 1::2]
    return [one.tobytes() if size else b"" for one, size in zip(packed, sizes.tolist())]


def likeness(one: bytes, two: bytes) -> float:
    """Estimated Jaccard similarity of two sets from their packed bins."""
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    differ = np.frombuffer(one, dtype=np.uint8) ^ np.frombuffer(two, dtype=np.uint8)
    agreeing = (np.count_nonzero(differ < 16) + np.count_nonzero(differ & 15 == 0)) / BINS
    chance = 1 / 2**BITS
    return float(min(1.0, max(0.0, (agreeing - chance) / (1 - chance))))


def fingerprints(texts: list[bytes]) -> list[bytes]:
    """Packed bins of whole texts, a slice of them in memory at a time."""
    out, at = [], 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to]) <= BATCH_BYTES):
            held += len(texts[to])
            to += 1
        offsets = np.cumsum([0] + [len(text) for text in texts[at:to]])
        data = np.frombuffer(b"".join(texts[at:to]), dtype=np.uint8)
        out += sketches(Words(data, offsets).shingles(SHINGLE))
        at = to
    return out


def text_of(packed: bytes) -> str:
    return base64.b64encode(packed).decode()


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of another."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)
RESULT_SQL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _sized(rows: Iterator[tuple], limit: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _compared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in descending order of key; a lent row at the end only follows the one before."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            names = ("doc_id", "text", "lent", "part")
            yield from zip(*[batch.column(name).to_pylist() for name in names])

    end = (None, "", True, None)
    everything = chain(((doc, text or "", lent, part) for doc, text, lent, part in rows()), [end])
    before = None
    for group in _sized(everything, BATCH_BYTES):
        own = ([before] if before else []) + group
        before = own[-1]
        first = [(one, two) for one, two in zip(own, own[1:]) if not one[2]]
        if not first:
            continue
        texts = [one[1] for one, _ in first]
        changed = [edited(one[1], two[1]) for one, two in first]
        following = [two[1] for _, two in first]
        # the next document's fingerprint is at hand but for the last one, which is made twice
        prints = fingerprints([text.encode("utf-8") for text in texts])
        known = dict(zip(map(id, texts), prints))
        others = [
            known.get(id(text)) if id(text) in known else fingerprints([text.encode("utf-8")])[0] for text in following
        ]
        changed_bytes = [text.encode("utf-8") for text in changed]
        changed_prints = fingerprints(changed_bytes)
        yield batch_of(
            RESULT,
            doc_id=[one[0] for one, _ in first],
            n_chars=[len(text) for text in texts],
            edited_sha256=[hashlib.sha256(text).hexdigest() for text in changed_bytes],
            fingerprint=list(map(text_of, prints)),
            edited_fingerprint=list(map(text_of, changed_prints)),
            near_edited=list(map(likeness, prints, changed_prints)),
            near_next=list(map(likeness, prints, others)),
        )


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited form, and two likenesses.

    A document's next one has the next smaller key, the smallest key's next one has the largest.
    The texts are dealt once, to ranges of keys; each range also gets the first document of the
    range after it, which is one row a range. Keys are unique; rows without a key come last, in
    the order of their texts; if none has a key, the last one's next text is empty. A null text is an empty one, whose fingerprint is empty; it is like
    other empty ones alone. A single document is its own next one; an empty table gives no row.
    Other columns are not read.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    at = cuts(narrow, "doc_id", partitions(spark))
    dealt = narrow.withColumn("part", part_of("doc_id", at))
    # the largest key of each range, and the range that lends it: one row a range
    heads = {row["part"]: row["head"] for row in dealt.groupBy("part").agg(F.max("doc_id").alias("head")).collect()}
    held = sorted(heads)
    # it follows the smallest key of the range above; the table's largest key follows its smallest
    lenders = {heads[part]: held[(place + 1) % len(held)] for place, part in enumerate(held) if heads[part] is not None}
    pairs = ", ".join(f"{head}L, {part}" for head, part in lenders.items())
    borrowed = dealt.selectExpr("*", "false AS lent")
    if lenders:
        borrowed = dealt.selectExpr(
            "doc_id", "text",
            f"explode(CASE WHEN map({pairs})[doc_id] IS NULL THEN array(struct(part, false AS lent)) "
            f"ELSE array(struct(part, false AS lent), struct(map({pairs})[doc_id] AS part, true AS lent)) END) AS at",
        ).selectExpr("doc_id", "text", "at.part AS part", "at.lent AS lent")
    ordered = borrowed.repartitionById(len(at) + 1, F.col("part")).sortWithinPartitions(
        "part", "lent", F.desc_nulls_last("doc_id"), "text"
    )
    return ordered.mapInArrow(_compared_rows, RESULT_SQL)
