"""CSV files whose quoted cells hold line breaks, read by many tasks each.

The text reader deals a file's lines to byte ranges. Whether a range begins within a quoted cell
depends on the quotes of all ranges before it, so the files are gone through twice: the first scan
notes the parity of quotes in each range and how many records end there in either case; a prefix
over a file's ranges then tells which ranges begin within a cell. The second scan makes records
from the first true boundary of each range; the few records that cross a boundary are put together
from their pieces. Spark's own parser reads the cells.

Quotes stand around whole cells, doubled within them, as writers of such files do; a lone quote in
a bare cell is not supported, nor are files whose lines end with a carriage return alone.
"""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from parcelworks.functions.logic import literal, quoted

#: ranges that begin within a cell are told to all tasks; each is a path and a number
OPEN_RANGES = 100_000

RANGES_SQL = "path string, start long, odd boolean, if_shut long, if_open long"
RANGES = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("odd", pa.bool_()), ("if_shut", pa.int64()), ("if_open", pa.int64())]
)
PIECES_SQL = "path string, start long, piece int, first boolean, record string"
PIECES = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("piece", pa.int32()), ("first", pa.bool_()), ("record", pa.string())]
)
#: what a row of the second scan is: a whole record, the end of one, the middle of one, the begin of one
WHOLE, END, MIDDLE, BEGIN = range(4)


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(paths)).selectExpr(
        "_metadata.file_path AS path", "_metadata.file_block_start AS start", "value AS line"
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """(path, start, lines) of a batch, split where another range begins."""
    paths, starts = batch.column("path"), batch.column("start").to_numpy()
    codes = paths.dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
        yield paths[a].as_py(), int(starts[a]), batch.column("line").slice(a, b - a)


def _within(lines: pa.Array, open_before: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line begins, and ends, within a quoted cell."""
    odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1
    after = (np.cumsum(odd) + open_before) & 1
    return np.concatenate([[open_before], after[:-1]]).astype(bool), after.astype(bool)


def _blank(lines: pa.Array) -> np.ndarray:
    return pc.or_(pc.equal(lines, ""), pc.equal(lines, "\r")).to_numpy(zero_copy_only=False)


def _range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for path, start, lines in _runs(batch) if len(batch) else ():
            known = held.setdefault((path, start), [0, 0, 0])
            before, after = _within(lines, bool(known[0]))
            blank = _blank(lines)
            # records end where a line ends outside a cell; a blank line between records is none
            known[1] += int((~after & ~(blank & ~before)).sum())
            known[2] += int((after & ~(blank & before)).sum())
            known[0] = int(after[-1])
    rows = [(path, start, bool(odd), shut, open_) for (path, start), (odd, shut, open_) in held.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RANGES)], schema=RANGES)


def ranges(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, start, within, records) per byte range of each file.

    ``within`` tells whether the range begins within a quoted cell, ``records`` how many records
    end in it, headers included, blank lines not; a cell left open at a file's end ends there.
    """
    found = _lines(spark, paths).mapInArrow(_range_rows, RANGES_SQL)
    return spark.sql(
        """
        SELECT path, start, within, CASE WHEN within THEN if_open ELSE if_shut END
            + CASE WHEN last AND (within <> odd) THEN 1 ELSE 0 END AS records
        FROM (
          SELECT *, coalesce(sum(int(odd)) OVER (PARTITION BY path ORDER BY start
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS within,
            lead(start) OVER (PARTITION BY path ORDER BY start) IS NULL AS last
          FROM {found})""",
        found=found,
    )


def records_per_file(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, rows): records below the header of each file, counted without parsing any."""
    return spark.sql(
        "SELECT path, greatest(sum(records) - 1, 0L) AS rows FROM {ranges} GROUP BY path", ranges=ranges(spark, paths)
    )


def _piece_rows(begin_within: set[tuple[str, int]]) -> Callable:
    """Records of each range, and the pieces of those that cross its edges."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, kind, first, state = None, [], WHOLE, False, False

        def made(records: list, kinds: list, firsts: list) -> pa.RecordBatch:
            n = len(records)
            columns = [[now[0]] * n, [now[1]] * n, kinds, firsts, records]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)

        def rest() -> Iterator[pa.RecordBatch]:
            # a range that ends within a cell: what is held goes on in the next range
            if now is not None and held:
                yield made(["\n".join(held)], [MIDDLE if kind == END else BEGIN], [first])

        for batch in batches:
            for path, start, lines in _runs(batch) if len(batch) else ():
                if (path, start) != now:
                    yield from rest()
                    now, held = (path, start), []
                    state = (path, start) in begin_within
                    kind, first = (END, False) if state else (WHOLE, start == 0)
                before, after = _within(lines, state)
                state = bool(after[-1])
                texts, blank = lines.to_pylist(), _blank(lines)
                records, kinds, firsts = [], [], []
                for text, a, b, empty in zip(texts, before.tolist(), after.tolist(), blank.tolist()):
                    if b:
                        held.append(text)
                    elif a or not empty:
                        held.append(text)
                        records.append("\n".join(held).removesuffix("\r"))
                        kinds.append(kind)
                        firsts.append(first)
                        held, kind, first = [], WHOLE, False
                if records:
                    yield made(records, kinds, firsts)
        yield from rest()

    return rows


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """(path, record): the text of every record below each file's header; None if too many ranges begin within cells."""
    within = ranges(spark, paths).filter("within").select("path", "start").limit(OPEN_RANGES + 1).collect()
    if len(within) > OPEN_RANGES:
        return None
    begin_within = {(row["path"], row["start"]) for row in within}
    pieces = _lines(spark, paths).mapInArrow(_piece_rows(begin_within), PIECES_SQL)
    if not begin_within:
        # no record crosses an edge; one may be open at the end of its file
        return pieces.filter("NOT first").select("path", "record")
    return spark.sql(
        f"""
        SELECT path, record FROM {{pieces}} WHERE piece = {WHOLE} AND NOT first
        UNION ALL
        SELECT path, array_join(transform(sort_array(array_agg(struct(start, piece, record))), x -> x.record), '\n') AS record
        FROM (
          SELECT *, max(CASE WHEN piece = {BEGIN} THEN start END) OVER (PARTITION BY path ORDER BY start, piece) AS begun
          FROM {{pieces}} WHERE piece <> {WHOLE})
        GROUP BY path, begun HAVING NOT bool_or(first)""",
        pieces=pieces,
    )


def read_split(spark: SparkSession, names: Sequence[str], paths: Sequence[str], dialect: dict) -> DataFrame | None:
    """(path, columns...) of files with this header, each record parsed on its own."""
    found = records(spark, paths)
    if found is None:
        return None
    schema = ", ".join(f"c{place} string" for place in range(len(names)))
    options = ", ".join(f"{literal(name)}, {literal(str(value).lower() if isinstance(value, bool) else value)}" for name, value in dialect.items())
    parsed = found.selectExpr("path", f"from_csv(record, {literal(schema)}, map({options})) AS cells")
    return parsed.selectExpr("path", *[f"cells.c{place} AS {quoted(name)}" for place, name in enumerate(names)])
