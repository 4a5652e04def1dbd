"""Monthly market measures, rankings and the publication audit."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks import fixed
from parcelworks.functions.logic import in_list, literal, number, quoted
from parcelworks.operators.outliers import Pair
from parcelworks.operators.quantiles import every_group_median, grouped_median
from parcelworks.sources import versions

# name: (column, aggregation, closed sales only)
MEASURES = {
    "measure_median_close_price": ("ClosePrice", "median", True),
    "measure_average_days_on_market": ("DaysOnMarket", "average", True),
    "measure_average_ratio": ("CloseToOriginalListRatio", "average", True),
    "measure_new_listings": ("NewListings", "sum", False),
    "measure_closed_sales": ("ClosedSales", "sum", False),
}


def sum_or_zero(column: str) -> str:
    """A sum that is zero, not null, over no values."""
    return f"coalesce(sum({column}), 0)"


VOLUMES = [f"{sum_or_zero(name)} AS {name}" for name in ("NewListings", "ClosedSales")]


def monthly_summary(events: DataFrame) -> DataFrame:
    """Counts, exact median price, mean days and mean ratio per month, in order."""
    means = [
        "avg(DaysOnMarket) AS AverageDaysOnMarket",
        "avg(CloseToOriginalListRatio) AS AverageCloseToOriginalListRatio",
    ]
    totals = events.groupBy("YrMo").agg(*[F.expr(text) for text in [*VOLUMES, *means]])
    # a row per calendar month
    medians = grouped_median(events, "ClosePrice", ["YrMo"], "MedianClosePrice", broadcast=True)
    # null-safe, as a plain equality would add a filter to one use of the counted prices only
    summary = totals.join(medians, totals.YrMo.eqNullSafe(medians.YrMo), "left").select(
        totals.YrMo,
        "NewListings",
        "ClosedSales",
        "MedianClosePrice",
        "AverageDaysOnMarket",
        "AverageCloseToOriginalListRatio",
    )
    return with_low_volume(summary).orderBy("YrMo")


def monthly_volumes(events: DataFrame) -> DataFrame:
    """New listings and closed sales per month."""
    return events.groupBy("YrMo").agg(*[F.expr(text) for text in VOLUMES])


def with_low_volume(monthly: DataFrame, share: float = fixed.LOW_VOLUME_SHARE) -> DataFrame:
    """Flags months below a share of the median month.

    The input has one row per calendar month, so one window over all of them stays small.
    """
    return monthly.selectExpr(
        "*",
        *[
            f"{name} < percentile({name}, 0.5) OVER () * {share}D AS {name}LowVolumeFlag"
            for name in ("NewListings", "ClosedSales")
        ],
    )


def top_sellers(sales: DataFrame, by: str, top: int = fixed.TOP_SELLERS) -> DataFrame:
    """Names with the largest sales volume, then units, then name; missing names are left out."""
    sums = [f"{sum_or_zero(name)} AS {name}" for name in ("SalesVolume", "UnitsSold")]
    return (
        sales.filter(f"{quoted(by)} IS NOT NULL")
        .groupBy(by)
        .agg(*[F.expr(text) for text in sums])
        .orderBy(F.desc("SalesVolume"), F.desc("UnitsSold"), by)
        .limit(top)
    )


def sliced(events: DataFrame, slicers: Mapping[str, Sequence[str]]) -> DataFrame:
    """Events whose columns take one of the chosen values; a column not named is not restricted."""
    for column, values in slicers.items():
        events = events.filter(f"{quoted(column)} IN ({in_list(values)})")
    return events


def measure_series(
    events: DataFrame,
    measure: str,
    aggregation: str,
    closed_only: bool,
    slicers: Mapping[str, Sequence[str]] = {},
) -> DataFrame:
    """One measure per month of the event date: median, average or sum."""
    chosen = sliced(events, slicers)
    if closed_only:
        chosen = chosen.filter(f"EventType = {literal(fixed.CLOSED_SALE)}")
    by_month = chosen.selectExpr("trunc(EventDate, 'month') AS EventMonth", measure)
    if aggregation == "median":
        return every_group_median(by_month, measure, ["EventMonth"], measure, broadcast=True)
    uses = {"sum": sum_or_zero(measure), "average": f"avg({measure})"}
    return by_month.groupBy("EventMonth").agg(F.expr(f"{uses[aggregation]} AS {measure}"))


def published_measure(
    spark: SparkSession,
    root: str,
    name: str,
    slicers: Mapping[str, Sequence[str]] = {},
    first: str | None = None,
    last: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """A measure of published events between two months, ``yyyy-MM``, both included; open where not given.

    A version keeps a folder per month, so only the folders within the window are read, and of them
    the columns of the slicers and the measure. Events without a month lie in no window. Slicers
    and months that match nothing give no row.
    """
    events = versions.read_version(spark, root, version)
    if first is not None:
        events = events.filter(f"_month >= {literal(first)}")
    if last is not None:
        events = events.filter(f"_month <= {literal(last)}")
    return measure_series(events, *MEASURES[name], slicers)


def publication_audit(
    counts: DataFrame,
    events: DataFrame,
    monthly: DataFrame,
    sales: DataFrame,
    ratio_bounds: Pair,
) -> DataFrame:
    """One row that reconciles inputs, removed duplicates, published events and months.

    ``counts`` is the result of ``dedupe_counts`` over both sources, ``events`` the published
    events, ``monthly`` their volumes with low-volume flags and ``sales`` the published sales.
    The four one-row results meet as scalar subqueries.
    """

    def of(source: str, column: str) -> str:
        return f"coalesce(sum(CASE WHEN SourceDataset = {literal(source)} THEN {column} END), 0)"

    def low_months(flag: str) -> str:
        return f"array_join(array_sort(collect_list(CASE WHEN {flag} THEN YrMo END)), ';')"

    inputs = counts.selectExpr(
        f"{of(fixed.SOLD_SOURCE, 'rows_in')} AS sold_input_rows",
        f"{of(fixed.LISTING_SOURCE, 'rows_in')} AS listing_input_rows",
        f"{of(fixed.SOLD_SOURCE, 'rows_removed')} AS sold_exact_duplicates_removed",
        f"{of(fixed.LISTING_SOURCE, 'rows_removed')} AS listing_exact_duplicates_removed",
    )
    parts = {
        "published": events.selectExpr(
            f"count_if(EventType = {literal(fixed.CLOSED_SALE)}) AS closed_sale_events",
            f"count_if(EventType = {literal(fixed.NEW_LISTING)}) AS new_listing_events",
            "count_if(CloseToOriginalListRatioOutlierFlag) AS ratio_outlier_rows",
            "count_if(CloseToOriginalListRatioEligible) AS ratio_eligible_rows",
            "count(*) AS market_event_rows",
        ),
        "calendar": monthly.selectExpr(
            "count(*) AS calendar_months",
            "min(YrMo) AS first_month",
            "max(YrMo) AS latest_month",
            f"{low_months('NewListingsLowVolumeFlag')} AS low_new_listing_months",
            f"{low_months('ClosedSalesLowVolumeFlag')} AS low_closed_sales_months",
        ),
        "sold": sales.selectExpr("count(*) AS competitive_sales_rows"),
    }
    joined = inputs.select(
        "*", *[part.select(F.struct("*")).scalar().alias(name) for name, part in parts.items()]
    )
    return joined.selectExpr(
        "sold_input_rows",
        "listing_input_rows",
        "published.closed_sale_events",
        "published.new_listing_events",
        "sold_exact_duplicates_removed",
        "listing_exact_duplicates_removed",
        "sold.competitive_sales_rows",
        "published.ratio_outlier_rows",
        "published.ratio_eligible_rows",
        "published.market_event_rows",
        "calendar.calendar_months",
        "calendar.first_month",
        "calendar.latest_month",
        f"{number(ratio_bounds[0])} AS ratio_iqr_lower_bound",
        f"{number(ratio_bounds[1])} AS ratio_iqr_upper_bound",
        "calendar.low_new_listing_months",
        "calendar.low_closed_sales_months",
    )
