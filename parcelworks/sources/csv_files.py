"""CSV readers: every column as text, repeated headers kept apart, missing tokens as null."""

import csv
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from parcelworks import fixed
from parcelworks.functions.casts import null_tokens, strict
from parcelworks.functions.logic import quoted
from parcelworks.operators.checks import require_header
from parcelworks.sources.manifest import file_name, listed_files, missing_months, month_of, select_files
from parcelworks.sources.split_csv import read_split

# quoted fields may hold commas, doubled quotes and line breaks
OPEN_COST = "spark.sql.files.openCostInBytes"
DIALECT = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}


def distinct_names(header: Sequence[str | None]) -> list[str]:
    """Header names with repeats numbered ``X``, ``X.1``, ``X.2`` ... skipping taken names."""
    given = [name or f"Unnamed: {place}" for place, name in enumerate(header)]
    taken, names = set(given), []
    seen: set[str] = set()
    for name in given:
        if name in seen:
            number = 1
            while f"{name}.{number}" in taken:
                number += 1
            name = f"{name}.{number}"
            taken.add(name)
        seen.add(name)
        names.append(name)
    return names


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The names in the first record of a file; reads no further than that record needs."""
    first = spark.read.options(**{**DIALECT, "header": False}).csv(path).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return distinct_names(list(first))


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a file, from the split that begins it; no split is read on."""
    for batch in batches:
        if len(batch):
            if batch.column("start")[0].as_py() == 0:
                yield batch.slice(0, 1).select(["path", "line"])
            return


def headers_of(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The names in the first line of each file, in one job whatever their number.

    A first line with a quote left open goes on in the next one; such a file is read by itself.
    """
    lines = spark.read.text(list(paths)).selectExpr(
        "_metadata.file_path AS path", "_metadata.file_block_start AS start", "value AS line"
    )
    # a split holds one file at most
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        found = {row["path"]: row["line"] for row in lines.mapInArrow(_first_lines, "path string, line string").collect()}
    finally:
        spark.conf.set(OPEN_COST, before)
    headers = []
    by_name = {unquote(urlsplit(path).path): line for path, line in found.items()}
    for path in paths:
        line = found.get(path, by_name.get(unquote(urlsplit(path).path)))
        if line is None or line.count('"') % 2:
            headers.append(header_of(spark, path))
        else:
            cells = next(csv.reader([line.removeprefix("\ufeff")]), [])
            headers.append(distinct_names(cells))
    return headers


def text_schema(names: Sequence[str]) -> str:
    return ", ".join(f"{quoted(name)} string" for name in names)


def read_files(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> list[DataFrame]:
    """A DataFrame of text columns per distinct header, with lineage columns.

    ``SourceFile`` is the file's name and ``SourceMonth`` the month in it. Quoted cells may hold line
    breaks with ``multi_line``, for which files are gone through twice; they are split either way.
    """
    if not paths:
        raise ValueError("no files to read")
    by_header = defaultdict(list)
    for path, header in zip(paths, headers_of(spark, paths)):
        by_header[tuple(header)].append(path)
    return [_read_alike(spark, names, group, multi_line) for names, group in by_header.items()]


def read_csv(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> DataFrame:
    """The files of ``read_files`` as one DataFrame, joined by column name, copies included."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read_files(spark, paths, multi_line))


def _read_alike(spark: SparkSession, names: Sequence[str], paths: Sequence[str], multi_line: bool) -> DataFrame:
    frame, name = read_split(spark, names, paths, DIALECT) if multi_line else None, file_name("path")
    if frame is None:
        # without line breaks in cells; or with so many open ranges that each file is one task
        frame = spark.read.options(**{**DIALECT, "multiLine": multi_line}).schema(text_schema(names)).csv(list(paths))
        name = file_name("_metadata.file_path")
    return frame.selectExpr(
        *[f"{null_tokens(quoted(column))} AS {quoted(column)}" for column in names],
        f"{month_of(name)} AS SourceMonth",
        f"{name} AS SourceFile",
    )


def monthly_paths(
    spark: SparkSession, folder: str, prefix: str, prefer_filled: bool, first_month: str = fixed.FIRST_MONTH
) -> list[str]:
    """The selected monthly files of a folder, by month; a month without a file is an error."""
    paths = listed_files(spark, folder, prefix)
    gaps = sorted(row.source_month for row in missing_months(paths, first_month).collect())
    if gaps:
        raise ValueError(f"{prefix} is missing monthly files: {', '.join(gaps)}")
    chosen = select_files(paths, prefer_filled, first_month).orderBy("source_month").collect()
    if not chosen:
        raise FileNotFoundError(f"no monthly files found for prefix {prefix}")
    return [row.path for row in chosen]


def read_monthly(
    spark: SparkSession,
    folder: str,
    prefix: str,
    prefer_filled: bool,
    first_month: str = fixed.FIRST_MONTH,
    multi_line: bool = True,
) -> list[DataFrame]:
    """``read_files`` of the ``monthly_paths`` of a folder."""
    return read_files(spark, monthly_paths(spark, folder, prefix, prefer_filled, first_month), multi_line)


def read_strict(spark: SparkSession, path: str, schema: dict[str, str]) -> DataFrame:
    """A CSV with exactly this header, each cell cast strictly; a bad row or cell is an error."""
    require_header(header_of(spark, path), list(schema))
    frame = spark.read.options(**DIALECT, mode="FAILFAST").schema(text_schema(list(schema))).csv(path)
    return frame.selectExpr(*[f"{strict(quoted(name), kind)} AS {quoted(name)}" for name, kind in schema.items()])
