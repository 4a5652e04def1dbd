"""Which monthly file to read: month and version from the file name, one file per month."""

from pyspark.sql import DataFrame, SparkSession

from parcelworks import fixed
from parcelworks.functions.logic import literal


def file_name(path: str) -> str:
    return f"element_at(split({path}, '/'), -1)"


def month_of(name: str) -> str:
    """``YYYYMM`` from a monthly file name; a name without one is an error."""
    month = f"regexp_extract({name}, r'{fixed.MONTH_PATTERN}', 1)"
    complaint = f"string(raise_error(concat('no YYYYMM in file name ', {name})))"
    return f"CASE WHEN {month} <> '' THEN {month} ELSE {complaint} END"


def version_of(name: str) -> str:
    stem = rf"regexp_replace({name}, r'\.[^.]*$', '')"
    return f"CASE WHEN contains({stem}, {literal(fixed.FILLED_MARK)}) THEN 'filled' ELSE 'raw' END"


def listed_files(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """Paths of the monthly CSV files with the prefix; only names are read, never content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{prefix}20*.csv")
        .load(folder)
        .select("path")
    )


def described(paths: DataFrame) -> DataFrame:
    """Adds ``source_file``, ``source_month`` and ``source_version`` to ``path``."""
    name = file_name("path")
    return paths.selectExpr(
        "path",
        f"{name} AS source_file",
        f"{month_of(name)} AS source_month",
        f"{version_of(name)} AS source_version",
    )


def select_files(
    paths: DataFrame, prefer_filled: bool, first_month: str = fixed.FIRST_MONTH
) -> DataFrame:
    """One file per month from ``first_month`` on, of the preferred version if there is one.

    Among files of the same month and version the last by path wins.
    """
    preferred = "filled" if prefer_filled else "raw"
    choice = (
        "row_number() OVER (PARTITION BY source_month "
        f"ORDER BY source_version = '{preferred}' DESC, path DESC) AS choice"
    )
    return (
        described(paths)
        .filter(f"source_month >= {literal(first_month)}")
        .selectExpr("*", choice)
        .filter("choice = 1")
        .drop("choice")
    )


def missing_months(paths: DataFrame, first_month: str = fixed.FIRST_MONTH) -> DataFrame:
    """Months between ``first_month`` and the latest file's month that have no file."""
    first = f"to_date({literal(first_month)}, 'yyyyMM')"
    present = described(paths).select("source_month").distinct()
    expected = (
        present.selectExpr("to_date(max(source_month), 'yyyyMM') AS latest")
        .filter(f"latest >= {first}")
        .selectExpr(f"explode(sequence({first}, latest, interval 1 month)) AS day")
        .selectExpr("date_format(day, 'yyyyMM') AS source_month")
    )
    return expected.join(present, "source_month", "left_anti")
