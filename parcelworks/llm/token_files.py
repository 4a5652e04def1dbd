"""Documents as files of range-coded token ids, in key order, and back.

Documents are dealt to ranges of ascending keys, one file each; a task encodes its range segment
by segment (see ``ans``), so it holds a few million ids whatever the file's size. Files are
written by Spark's committers and read by its readers, so any store will do and a lost task is
run again. A file is its segments with a line feed behind each.
"""

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm import ans
from parcelworks.llm.ordering import cuts, part_of, partitions
from parcelworks.llm.scan import batch_of, slices
from parcelworks.llm.tokens import encoder

END_ID = 2
SEGMENT_IDS = 2_000_000


def _segment_rows(vocabulary: str, segment_ids: int) -> Callable:
    end = np.array([END_ID], dtype="<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_all
        keys, lengths, flags, parts, held = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            data = ans.encode(np.array(keys), np.array(lengths), np.array(flags), ids)
            for values in (keys, lengths, flags, parts):
                values.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["segment"])

        for batch in batches:
            for part in slices(batch):
                encoded = encode(part.column("text"))
                for key, ids in zip(part.column("key").to_pylist(), encoded):
                    ids, at, flag = ids + end, 0, 0 if key is not None else 2
                    while at < len(ids):
                        piece = ids[at : at + 4 * (segment_ids - held)]
                        keys.append(key or 0)
                        lengths.append(len(piece) // 4)
                        flags.append(flag | (1 if at else 0))
                        parts.append(piece)
                        held += len(piece) // 4
                        at += len(piece)
                        if held >= segment_ids:
                            yield flush()
        if held:
            yield flush()

    return rows


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the ids of every whole text, each followed by the end id, in ascending key order.

    A null text has the end id only. Documents without a key come first, equal keys in the order
    of their texts. An empty table makes a folder without segments. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    at = cuts(docs, key, parts)
    dealt = docs.select(
        part_of(key, at).alias("part"), F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(text)).alias("text")
    )
    ordered = dealt.repartitionById(len(at) + 1, F.col("part")).sortWithinPartitions("key", "text")
    segments = ordered.mapInArrow(_segment_rows(vocabulary, segment_ids), "segment binary")
    segments.selectExpr("CAST(segment AS string) AS value").write.text(folder, lineSep="\n")


READ = "file int, place long, doc_id long, n_tokens long, ids_crc32 long, local_start long"


def _document_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("file", pa.int32())]
        + [(name, pa.int64()) for name in ("place", "doc_id", "n_tokens", "ids_crc32", "local_start")]
    )
    for batch in batches:
        for row, file in enumerate(batch.column("file").to_pylist()):
            content = batch.column("content")[row].as_buffer()
            start, place, open_row = 0, 0, None
            for segment in ans.segments(content):
                data, at, rows = memoryview(segment.ids().astype("<u4").tobytes()), 0, []
                for doc, size, flag in zip(segment.keys.tolist(), segment.lengths.tolist(), segment.flags.tolist()):
                    piece = data[4 * at : 4 * (at + size)]
                    at += size
                    if flag & 1:
                        open_row[3] += size
                        open_row[4] = zlib.crc32(piece, open_row[4])
                        start += size
                        continue
                    if open_row:
                        rows.append(open_row)
                    open_row = [file, place, None if flag & 2 else doc, size, zlib.crc32(piece), start]
                    start += size
                    place += 1
                if rows:
                    yield batch_of(schema, **dict(zip(schema.names, zip(*rows))))
            if open_row:
                yield batch_of(schema, **dict(zip(schema.names, zip(open_row))))


def _file_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.int32()), ("ids", pa.int64())])
    for batch in batches:
        sizes = [sum(s.n_ids for s in ans.segments(content.as_buffer())) for content in batch.column("content")]
        yield batch_of(schema, file=batch.column("file").to_pylist(), ids=sizes)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: key, ids before it in all files, number of ids and their crc32.

    Every block's checksum is checked. The files' sizes come from their headers, one row a file.
    """
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").selectExpr(
        "int(regexp_extract(path, 'part-([0-9]+)', 1)) AS file", "content"
    )
    sizes = files.mapInArrow(_file_sizes, "file int, ids long").selectExpr(
        "file", "coalesce(sum(ids) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before"
    )
    documents = files.mapInArrow(_document_rows, READ)
    return documents.join(F.broadcast(sizes), "file").selectExpr(
        "doc_id", "before + local_start AS start", "n_tokens", "ids_crc32"
    )
