"""Exact quantiles over any months from stored counts: a new month reads itself and a few bins of the rest.

The index counts, per month and field, how often values have each setting of their upper 22 bits
(``quantiles.bins_of``), with the least and the greatest value of each such bin. Counts of months
add up, so the bins that hold the wanted ranks of any set of months are known without its rows.
Of these only those in such bins, about a thousandth of a field's range each, are read again.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks.functions.casts import typed_number
from parcelworks.functions.logic import any_of, literal, number, quoted
from parcelworks.operators.quantiles import added, bins_of, holding, long_values, quantiles

#: ranges of values that are told to the scan one by one; beyond that the bins alone choose
RANGES_TO_PUSH = 500
INDEX = "field string, bin long, rows long, least double, most double, _month string"


def index_months(df: DataFrame, path: str, fields: Sequence[str], month: str, months: Sequence[str] | None = None) -> None:
    """Count the values of ``months``, all by default, into the index at ``path``; other months stay as they are.

    A month that is given again replaces its counts. Give a ``df`` that is partitioned by month, so
    that only its months are read.
    """
    chosen = df if months is None else df.filter(F.col(quoted(month)).isin(list(months)))
    bins = bins_of(long_values(chosen, fields, [month]), [month])
    named = bins.withColumn("_month", F.col(quoted(month)).cast("string")).select("field", "bin", "rows", "least", "most", "_month")
    # as many rows as bins, at most 2**22 a month and field
    named.hint("rebalance", "_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "_month"
    ).parquet(path)


def stored_index(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """The index's counts of ``months``, all by default; folders of others are not read."""
    index = spark.read.schema(INDEX).parquet(path)
    return index if months is None else index.filter(F.col("_month").isin(list(months)))


def in_ranges(df: DataFrame, ranges: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows with a value in one of the ranges (field, least, most), as a filter that reaches the scan."""
    found = ranges.filter("least IS NOT NULL").select("field", "least", "most").distinct().limit(RANGES_TO_PUSH + 1).collect()
    if len(found) > RANGES_TO_PUSH:
        return df
    inside = [
        f"{typed_number(df, row['field'])} BETWEEN {number(row['least'])} AND {number(row['most'])}"
        for row in found
        if row["field"] in fields
    ]
    return df.filter(any_of(inside))


def indexed_quantiles(
    index: DataFrame,
    df: DataFrame,
    fields: Sequence[str],
    probabilities: Mapping[str, float],
    month: str,
    by_month: bool = False,
) -> DataFrame:
    """``quantiles`` of ``df`` from its index: (field, n, ...), or per month with ``by_month``.

    ``index`` has the counts of exactly the rows of ``df``, as ``stored_index`` and a table of the
    same months do.
    """
    by = [month] if by_month else []
    named = index.withColumn(month, F.col("_month")) if month != "_month" else index
    wanted = named.filter(" OR ".join(f"field = {literal(name)}" for name in fields))
    bins = added(wanted.drop("_month") if month != "_month" else wanted, by)
    rows = in_ranges(df, holding(bins, probabilities, by), fields)
    values = long_values(rows, fields, by)
    return quantiles(values, probabilities, by, broadcast=True, bins=bins)
