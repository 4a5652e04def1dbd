"""Interquartile-range bounds, outlier and business-rule flags, and the filtered set.

Bounds are computed once over the whole table and kept as a small stored result: a pair of
numbers per field, used as literals by the passes that flag rows, in batch or on a stream.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks import fixed
from parcelworks.functions.casts import typed_number
from parcelworks.functions.logic import any_of, holds, number, quoted, with_exprs
from parcelworks.operators.profile import iqr_bounds, iqr_counts, outside
from parcelworks.operators.quantiles import long_values, quantiles

Pair = tuple[float | None, float | None]
Bounds = Mapping[str, Pair]


def iqr_summary(
    df: DataFrame, fields: Sequence[str] = fixed.OUTLIER_FIELDS, multiplier: float = fixed.IQR_MULTIPLIER
) -> DataFrame:
    """Quartiles, bounds and outliers per field; percent of all rows, unrounded."""
    values = long_values(df, fields)
    return iqr_counts(values, iqr_bounds(values, multiplier)).selectExpr(
        "field",
        "rows_total",
        "rows_non_null",
        "rows_missing",
        "q1",
        "q3",
        "iqr",
        "lower_bound",
        "upper_bound",
        "outlier_count",
        "outlier_count / rows_total * 100 AS outlier_pct",
    )


def bounds_table(
    df: DataFrame,
    fields: Sequence[str] = fixed.OUTLIER_FIELDS,
    multiplier: float = fixed.IQR_MULTIPLIER,
) -> DataFrame:
    """(field, lower_bound, upper_bound), one row per field."""
    return iqr_bounds(long_values(df, fields), multiplier).select("field", "lower_bound", "upper_bound")


def as_bounds(bounds: DataFrame, fields: Sequence[str] = fixed.OUTLIER_FIELDS) -> Bounds:
    """A bounds table as a mapping; as many rows as fields come to the driver."""
    found = {row.field: (row.lower_bound, row.upper_bound) for row in bounds.collect()}
    return {name: found.get(name, (None, None)) for name in fields}


def store_bounds(bounds: Bounds, spark: SparkSession, path: str) -> None:
    """Keep bounds for later runs and streams."""
    rows = [(name, lower, upper) for name, (lower, upper) in bounds.items()]
    spark.createDataFrame(rows, "field string, lower_bound double, upper_bound double").write.mode(
        "overwrite"
    ).parquet(path)


def stored_bounds(spark: SparkSession, path: str, fields: Sequence[str] = fixed.OUTLIER_FIELDS) -> Bounds:
    return as_bounds(spark.read.parquet(path), fields)


def _outlier(value: str, bounds: Pair) -> str:
    return outside(value, number(bounds[0]), number(bounds[1]))


def with_outlier_flags(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Outlier and business-rule flags, and whether a row is left out of analysis."""
    outlier = {f"{name}_outlier_flag": _outlier(typed_number(df, name), pair) for name, pair in bounds.items()}
    invalid = {
        "ClosePrice_invalid_flag": holds(f"{typed_number(df, 'ClosePrice')} <= 0"),
        "LivingArea_invalid_flag": holds(f"{typed_number(df, 'LivingArea')} <= 0"),
        "DaysOnMarket_invalid_flag": holds(f"{typed_number(df, 'DaysOnMarket')} < 0"),
    }
    return with_exprs(
        df,
        {
            **outlier,
            "any_outlier_flag": any_of(outlier.values()),
            **invalid,
            "business_rule_invalid_flag": any_of(invalid.values()),
            "analysis_exclude_flag": any_of([*outlier.values(), *invalid.values()]),
        },
    )


def filtered(flagged: DataFrame) -> DataFrame:
    """Rows kept for analysis; missing values stay."""
    return flagged.filter("NOT analysis_exclude_flag")


def dataset_comparison(flagged: DataFrame, fields: Sequence[str] = fixed.OUTLIER_FIELDS) -> DataFrame:
    """Rows and exact medians of the full and of the filtered set.

    Each row counts once per set it belongs to.
    """
    sets = (
        "explode(CASE WHEN analysis_exclude_flag THEN array('full_flagged') "
        "ELSE array('full_flagged', 'clean_filtered') END) AS dataset"
    )
    members = flagged.selectExpr(*[quoted(name) for name in fields], sets)
    # two datasets, so their bins are a few rows
    values = long_values(members, fields, ["dataset"])
    medians = quantiles(values, {"median": 0.5}, ["dataset"], broadcast=True).groupBy("dataset").agg(
        *[F.expr(f"max(CASE WHEN field = '{name}' THEN median END) AS median_{name}") for name in fields]
    )
    sizes = members.groupBy("dataset").agg(F.expr("count(*) AS row_count"))
    return sizes.join(medians, "dataset", "left").select(
        "dataset", "row_count", *[f"median_{name}" for name in fields]
    )


def with_ratio_quality(df: DataFrame, bounds: Pair, column: str = fixed.RATIO_COLUMN) -> DataFrame:
    """Outlier and eligible flags of a ratio, and the ratio nulled where it is not eligible."""
    ratio = typed_number(df, column)
    eligible = f"{column}Eligible"
    judged = with_exprs(df, {eligible: f"{ratio} IS NOT NULL AND NOT {_outlier(ratio, bounds)}"})
    return with_exprs(
        judged,
        {
            f"{column}OutlierFlag": f"{ratio} IS NOT NULL AND NOT {eligible}",
            column: f"CASE WHEN {eligible} THEN {ratio} END",
        },
    )
