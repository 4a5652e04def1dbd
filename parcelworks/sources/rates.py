"""The weekly interest-rate series, from a file the user supplies."""

from pyspark.sql import DataFrame, SparkSession

from parcelworks import fixed
from parcelworks.functions.casts import date_of, number_of


def weekly_rates(spark: SparkSession, path: str) -> DataFrame:
    """The series as read from CSV, in text columns."""
    return spark.read.option("header", True).csv(path)


def observations(
    weekly: DataFrame,
    date_column: str = fixed.RATE_DATE_COLUMN,
    value_column: str = fixed.RATE_VALUE_COLUMN,
) -> DataFrame:
    """(date, rate) of the weeks that have both."""
    return weekly.selectExpr(
        f"{date_of(weekly, date_column)} AS date",
        f"{number_of(weekly, value_column)} AS {fixed.RATE_COLUMN}",
    ).dropna()
