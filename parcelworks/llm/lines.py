"""Line dedup by overlapping windows of three consecutive lines.

Every window of three lines of one document is hashed. Of windows with equal lines anywhere in
the table the first, by document key and then by place, stays; each later one covers its three
lines, and covered lines are removed, however many windows cover them.

A window's digest meets its first occurrence in a join with the digests that occur more than
once. Counting combines on the map side, so a window that a third of all documents hold is one
row per task there, and the join's large partitions are split by Spark.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.scan import batch_of, free_name, slices, text_list

WINDOW = 3
ADDED = ("n_lines", "n_removed", "kept_text")


def _window_rows(window: int) -> Callable:
    schema = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("place", pa.int32())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                digests, docs, places = [], [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), text_list(part.column("text"))):
                    lines = text.split(b"\n")
                    for place in range(len(lines) - window + 1):
                        joined = b"\n".join(lines[place : place + window])
                        digests.append(hashlib.blake2b(joined, digest_size=16).digest())
                        docs.append(doc)
                        places.append(place)
                yield batch_of(schema, digest=digests, doc_id=docs, place=places)

    return rows


def _kept_rows(window: int, names: list[str], text_name: str, places_name: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_name):
                out = []
                for text, places in zip(text_list(part.column(text_name)), part.column(places_name).to_pylist()):
                    lines = text.split(b"\n") if text else []
                    covered = np.zeros(len(lines), dtype=bool)
                    for place in places or ():
                        covered[place : place + window] = True
                    kept = [line for line, gone in zip(lines, covered.tolist()) if not gone]
                    out.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode("utf-8")))
                n_lines, n_removed, texts = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in names]
                    + [pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())],
                    [*names, *ADDED],
                )

    return rows


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, places) of the windows that also occur earlier: in a smaller key, or above."""
    windows = docs.mapInArrow(_window_rows(window), "digest binary, doc_id long, place int")
    firsts = (
        windows.groupBy("digest")
        .agg(F.expr("min(struct(doc_id, place)) AS first"), F.expr("count(*) AS times"))
        .filter("times > 1")
        .select("digest", "first")
    )
    later = windows.join(firsts, "digest").filter("struct(doc_id, place) > first")
    return later.groupBy("doc_id").agg(F.expr("array_agg(place) AS places"))


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """All rows and columns but the text, with ``n_lines``, ``n_removed`` and ``kept_text``.

    Keys are unique where they are not null. Lines are parted by line feeds. A null or empty text
    has no lines, one of fewer than three lines no window. A document without a key keeps all its
    lines, and no other document's are removed for its sake. An empty table gives no row. Columns
    that already have the added names, in any case, are replaced; any others are carried.
    """
    names = [name for name in docs.columns if name != text and name.lower() not in ADDED]
    given_text, doc, places = (free_name(docs.columns, name) for name in ("given_text", "found_doc", "places"))
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    found = repeated_windows(narrow.filter("doc_id IS NOT NULL"), window)
    given = docs.select(*[F.col(quoted(name)) for name in names], F.col(quoted(text)).alias(given_text))
    named = found.select(F.col("doc_id").alias(doc), F.col("places").alias(places))
    marked = given.join(named, given[quoted(key)].cast("long") == named[quoted(doc)], "left").drop(doc)
    return marked.mapInArrow(
        _kept_rows(window, names, given_text, places), f"{fields}, n_lines long, n_removed long, kept_text string"
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``kept_lines`` of the key and text alone, the key as ``doc_id``."""
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    return kept_lines(narrow, window=window)


ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS place
  FROM documents WHERE text <> ''),
windows AS (
  SELECT doc_id, place, line,
         lead(line, 1) OVER doc AS second, lead(line, 2) OVER doc AS third
  FROM lines WINDOW doc AS (PARTITION BY doc_id ORDER BY place)),
ranked AS (
  SELECT doc_id, place,
         row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, place) AS nth
  FROM windows WHERE third IS NOT NULL),
covered AS (
  SELECT DISTINCT doc_id, place + step AS place
  FROM ranked, (SELECT unnest([0, 1, 2]) AS step) WHERE nth > 1),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.place) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE c.place IS NULL), '') AS kept_text
  FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.place = c.place GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
