"""Packing by powers of two: each document is cut into pieces whose lengths are powers of two.

A document of n ids gives as many pieces of the longest length as fit, then one piece per bit of
the rest, longest first. Each piece is a sequence of its own, so no sequence crosses documents
and none is padded; sequences of one length are numbered one after another, which makes them a
bucket of batches of equal shape.
"""

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.ordering import cuts, new_folder, part_of, partitions
from parcelworks.llm.scan import batch_of, slices
from parcelworks.llm.tokens import encoder

LONGEST = 4096
END_ID = 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def lengths_of(n_ids: int, longest: int = LONGEST) -> list[int]:
    """The lengths that a document of ``n_ids`` is cut into; ``longest`` is a power of two."""
    rest = n_ids % longest
    bits = [1 << bit for bit in range(longest.bit_length() - 2, -1, -1) if rest >> bit & 1]
    return [longest] * (n_ids // longest) + bits


def _piece_rows(vocabulary: str, longest: int) -> Callable:
    schema = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
    end = np.array([END_ID], dtype="<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_all
        for batch in batches:
            for part in slices(batch):
                out = []
                encoded = encode(part.column("text"))
                for doc, own in zip(part.column("doc_id").to_pylist(), encoded):
                    ids, start = memoryview(own + end), 0
                    for length in lengths_of(len(ids) // 4, longest):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        out.append((doc, start, length, crc, len(ids) // 4))
                        start += length
                yield batch_of(schema, **dict(zip(schema.names, zip(*out))))

    return rows


def pack(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """One row per piece: its place in the document, its ids' crc32, its sequence and offset there.

    Sequences are numbered from 0, the longest lengths first and by key within a length. A null
    text has the end id only; rows without a key are packed like others, and equal keys are
    numbered by start and crc32. An empty table gives no piece. Other columns are not read. The
    narrow pieces are written once, below the shared folder, as texts are encoded for them.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    folder = new_folder(spark, "pieces")
    narrow.mapInArrow(_piece_rows(vocabulary, longest), PIECES).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    return numbered(pieces)


def numbered(pieces: DataFrame) -> DataFrame:
    """Pieces with dense sequence numbers; a count per range of keys and length is all that meets."""
    spark = pieces.sparkSession
    at = cuts(pieces, "doc_id", partitions(spark))
    dealt = pieces.withColumn("part", part_of("doc_id", at))
    # at most 13 lengths for each range of keys
    bases = dealt.groupBy("length", "part").count().selectExpr(
        "length", "part",
        "coalesce(sum(count) OVER (ORDER BY length DESC, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base",
    )
    ranked = dealt.selectExpr(
        "*", "row_number() OVER (PARTITION BY part, length ORDER BY doc_id, start, ids_crc32) - 1 AS place"
    )
    return ranked.join(F.broadcast(bases), ["length", "part"]).selectExpr(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "base + place AS sequence_id", "0L AS offset"
    )
