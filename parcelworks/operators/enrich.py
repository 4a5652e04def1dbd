"""Joining a monthly interest rate to dated records."""

from pyspark.sql import DataFrame, functions as F

from parcelworks import fixed
from parcelworks.functions.casts import date_of
from parcelworks.functions.logic import literal, quoted, with_exprs, year_month
from parcelworks.operators.checks import check_rows, unique_key

MONTH = "year_month"
RATE = fixed.RATE_COLUMN


def monthly_rates(observed: DataFrame) -> DataFrame:
    """Mean rate and number of observations per calendar month."""
    months = observed.selectExpr(f"{year_month('date')} AS {MONTH}", RATE)
    return months.groupBy(MONTH).agg(
        F.expr(f"avg({RATE}) AS {RATE}"), F.expr("count(*) AS weekly_observation_count")
    )


def rate_series(monthly: DataFrame, last_month: str, first_month: str = fixed.FIRST_RATE_MONTH) -> DataFrame:
    """Months of the charted window with their first day, in order."""
    window = f"{MONTH} BETWEEN {literal(first_month)} AND {literal(last_month)}"
    return monthly.filter(window).selectExpr("*", f"date(concat({MONTH}, '-01')) AS date").orderBy(MONTH)


def dated(df: DataFrame, date_column: str, formats=fixed.DATE_FORMATS) -> DataFrame:
    """Rows with a valid date, and their month as text."""
    valid = with_exprs(df, {date_column: date_of(df, date_column, formats)}).dropna(subset=[date_column])
    return with_exprs(valid, {MONTH: year_month(quoted(date_column))})


def with_rates(
    df: DataFrame, date_column: str, monthly: DataFrame, formats=fixed.DATE_FORMATS
) -> DataFrame:
    """Left join of the month's rate.

    ``monthly`` has one row per calendar month (see ``rate_keys_unique``), at most some thousand
    rows however large the data, so it is broadcast.
    """
    return dated(df, date_column, formats).join(F.broadcast(monthly), MONTH, "left")


def rate_keys_unique(monthly: DataFrame) -> DataFrame:
    """Check that no month occurs twice, so the join cannot multiply rows."""
    return unique_key(monthly, "months repeated in the rate table", MONTH)


def unmatched_months(df: DataFrame, date_column: str, monthly: DataFrame) -> DataFrame:
    """Months of the records that have no rate, with their rows, in order."""
    months = dated(df, date_column).groupBy(MONTH).count().withColumnRenamed("count", "rows")
    present = monthly.filter(f"{RATE} IS NOT NULL")
    return months.join(F.broadcast(present), MONTH, "left_anti").orderBy(MONTH)


def all_matched(enriched: DataFrame, dataset: str) -> DataFrame:
    """Check that every enriched row has a rate; one row, or one per month without a rate, named."""
    without = enriched.filter(f"{RATE} IS NULL").groupBy(MONTH).count()
    named = without.selectExpr(
        f"concat({literal(dataset + ' rows without a rate in ')}, {MONTH}) AS `check`",
        "count AS observed", "0L AS expected", "false AS passed",
    )
    return check_rows(enriched, {f"{dataset} rows without a rate": (f"count_if({RATE} IS NULL)", "0")}).unionByName(named)


def join_quality(
    df: DataFrame, date_column: str, monthly: DataFrame, dataset: str, formats=fixed.DATE_FORMATS
) -> DataFrame:
    """Rows before and after the date check, and rows left without a rate, in one pass."""
    keyed = df.selectExpr(f"{year_month(date_of(df, date_column, formats))} AS {MONTH}")
    return keyed.join(F.broadcast(monthly), MONTH, "left").selectExpr(
        f"{literal(dataset)} AS dataset",
        f"{literal(date_column)} AS date_column",
        "count(*) AS rows_before_date_validation",
        f"count_if({MONTH} IS NULL) AS invalid_or_missing_date_rows_removed",
        f"count({MONTH}) AS rows_after_date_validation",
        f"count_if({MONTH} IS NOT NULL AND {RATE} IS NULL) AS rows_without_mortgage_rate",
    )
