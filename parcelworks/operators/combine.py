"""Combining monthly data: union, category filter, manifest and summaries."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from parcelworks import fixed
from parcelworks.functions.logic import literal, percent, quoted
from parcelworks.operators.checks import check_rows
from parcelworks.sources.manifest import file_name, month_of, version_of


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; a column a frame lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def of_category(column: str = fixed.CATEGORY_COLUMN, value: str = fixed.CATEGORY) -> str:
    return f"{quoted(column)} = {literal(value)}"


def keep_category(
    df: DataFrame, column: str = fixed.CATEGORY_COLUMN, value: str = fixed.CATEGORY
) -> DataFrame:
    """Rows whose column is exactly ``value``, case and blanks included."""
    return df.filter(of_category(column, value))


def category_distribution(
    df: DataFrame, dataset: str, column: str = fixed.CATEGORY_COLUMN
) -> DataFrame:
    """Rows and percent per value; missing values count under a label of their own."""
    labelled = df.selectExpr(f"coalesce({quoted(column)}, {literal(fixed.MISSING_LABEL)}) AS {quoted(column)}")
    counted = labelled.groupBy(column).count().withColumnRenamed("count", "row_count")
    total = counted.groupBy().sum("row_count").scalar().alias("total")
    return counted.select("*", total).selectExpr(
        f"{literal(dataset)} AS dataset",
        quoted(column),
        "row_count",
        f"{percent('row_count', 'total', 4)} AS percent_of_dataset",
    )


def source_manifest(df: DataFrame, dataset: str) -> DataFrame:
    """Rows and category rows per source file."""
    counted = df.groupBy("SourceMonth", "SourceFile").agg(
        F.expr("count(*) AS rows_read"), F.expr(f"count_if({of_category()}) AS residential_rows")
    )
    return counted.selectExpr(
        f"{literal(dataset)} AS dataset",
        "SourceMonth AS source_month",
        "SourceFile AS source_file",
        f"{version_of('SourceFile')} AS source_version",
        "rows_read",
        "residential_rows",
    )


def file_manifest(counted: DataFrame, read: DataFrame, dataset: str) -> DataFrame:
    """``source_manifest`` with ``rows_read`` counted in the files themselves, not in what was read of them.

    ``counted`` has (path, rows) for every file, ``read`` the rows that were read; a file of which
    none was read is listed too.
    """
    name = file_name("path")
    files = counted.selectExpr(f"{name} AS source_file", f"{month_of(name)} AS source_month", "rows AS rows_read")
    kept = source_manifest(read, dataset).select("source_file", "residential_rows")
    return files.join(kept, "source_file", "left").selectExpr(
        f"{literal(dataset)} AS dataset",
        "source_month",
        "source_file",
        f"{version_of('source_file')} AS source_version",
        "rows_read",
        "coalesce(residential_rows, 0L) AS residential_rows",
    )


def aggregation_summary(manifest: DataFrame, combined: DataFrame, kept: DataFrame, dataset: str) -> DataFrame:
    """Months, files and row totals of a dataset: files by the manifest, tables by their own rows.

    ``manifest`` comes from the files, ``combined`` is the united table and ``kept`` the rows of
    the category; each is counted for itself, so that totals that should agree can differ.
    """
    files = manifest.filter(f"dataset = {literal(dataset)}").selectExpr(
        f"{literal(dataset)} AS dataset",
        "min(source_month) AS first_month",
        "max(source_month) AS last_month",
        "count(*) AS monthly_files_used",
        "sum(rows_read) AS rows_before_concat",
    )
    rows = combined.selectExpr("count(*) AS rows").scalar()
    after = kept.selectExpr("count(*) AS rows").scalar()
    # before the filter stands the combined table with any category, a missing one included
    before = combined.selectExpr(f"count_if({of_category()}) + count_if(NOT coalesce({of_category()}, false)) AS rows").scalar()
    return files.select(
        "*",
        rows.alias("rows_after_concat"),
        before.alias("rows_before_residential_filter"),
        after.alias("rows_after_residential_filter"),
    )


def parts_reconcile(combined: DataFrame, manifest: DataFrame, dataset: str) -> DataFrame:
    """The files' row counts, read from the files, add up to the rows of the combined table."""
    sides = combined.selectExpr("1L AS rows", "0L AS parts").unionByName(
        manifest.selectExpr("0L AS rows", "rows_read AS parts")
    )
    return check_rows(
        sides, {f"{dataset} combined rows equal the files' rows": ("sum(rows)", "sum(parts)")}
    )
