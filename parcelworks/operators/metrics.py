"""Price and timeline metrics of sold records."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from parcelworks import fixed
from parcelworks.functions.casts import elapsed_days
from parcelworks.functions.logic import guarded_ratio, literal, quoted, rows_of, with_exprs, year_month
from parcelworks.operators.quantiles import few_groups, grouped_median

# eligibility flag of each metric
ELIGIBLE = {
    "PriceRatio": "price_ratio_eligible_flag",
    "PricePerSqFt": "ppsf_eligible_flag",
    "ListingToContractDays": "listing_to_contract_eligible_flag",
    "ContractToCloseDays": "contract_to_close_eligible_flag",
}
COVERAGE_LABELS = {
    "PriceRatio": "PriceRatio / CloseToOriginalListRatio",
    "PricePerSqFt": "PricePerSqFt",
    "ListingToContractDays": "ListingToContractDays",
    "ContractToCloseDays": "ContractToCloseDays",
}


def price_metrics(sold: DataFrame) -> DataFrame:
    """Sale price over original list price and per square foot, where the divisor is positive."""
    ratio = guarded_ratio("ClosePrice", "OriginalListPrice")
    return with_exprs(
        sold,
        {
            "PriceRatio": ratio,
            "CloseToOriginalListRatio": ratio,
            "PricePerSqFt": guarded_ratio("ClosePrice", "LivingArea"),
        },
    )


def calendar_fields(df: DataFrame, date_column: str) -> DataFrame:
    """Year, month and ``yyyy-MM`` of a date."""
    date = quoted(date_column)
    return with_exprs(df, {"Year": f"year({date})", "Month": f"month({date})", "YrMo": year_month(date)})


def timeline_days(sold: DataFrame) -> DataFrame:
    """Days from listing to contract and from contract to close; may be negative."""
    return with_exprs(
        sold,
        {
            "ListingToContractDays": elapsed_days(sold, "ListingContractDate", "PurchaseContractDate"),
            "ContractToCloseDays": elapsed_days(sold, "PurchaseContractDate", "CloseDate"),
        },
    )


def eligibility_flags(sold: DataFrame) -> DataFrame:
    """Whether each metric is present."""
    return with_exprs(sold, {flag: f"{metric} IS NOT NULL" for metric, flag in ELIGIBLE.items()})


def engineer(sold: DataFrame) -> DataFrame:
    """All metrics of a clean sold table."""
    return eligibility_flags(timeline_days(calendar_fields(price_metrics(sold), "CloseDate")))


def metric_coverage(engineered: DataFrame) -> DataFrame:
    """Populated and missing rows per metric, in one pass."""
    counts = engineered.selectExpr("count(*) AS total", *[f"count({metric}) AS {metric}" for metric in ELIGIBLE])
    rows = [(literal(label), metric, f"total - {metric}") for metric, label in COVERAGE_LABELS.items()]
    return rows_of(counts, rows, ["metric", "rows_populated", "rows_missing"])


def county_summary(engineered: DataFrame, by: str = "CountyOrParish") -> DataFrame:
    """Size, median price and mean metrics per county, largest first; a missing county is a group."""
    means = {
        "AveragePricePerSqFt": "PricePerSqFt",
        "AveragePriceRatio": "PriceRatio",
        "AverageDaysOnMarket": "DaysOnMarket",
        "AverageListingToContractDays": "ListingToContractDays",
        "AverageContractToCloseDays": "ContractToCloseDays",
    }
    groups = engineered.groupBy(by).agg(
        F.expr("count(*) AS Transactions"),
        *[F.expr(f"avg({column}) AS {name}") for name, column in means.items()],
    )
    medians = grouped_median(engineered, "ClosePrice", [by], "MedianClosePrice", few_groups(engineered, [by]))
    return (
        groups.join(medians, groups[by].eqNullSafe(medians[by]), "left")
        .select(groups[by], "Transactions", "MedianClosePrice", *means)
        .orderBy(F.desc("Transactions"), by)
    )


def complete_sample(engineered: DataFrame, order: Sequence[str], rows: int = fixed.SAMPLE_ROWS) -> DataFrame:
    """The first rows, in the given order, that have every metric."""
    return (
        engineered.dropna(subset=list(ELIGIBLE)).orderBy(*order).limit(rows).select(*fixed.SAMPLE_COLUMNS)
    )
