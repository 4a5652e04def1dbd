"""The stages from combined records to published tables, as DataFrame compositions."""

from collections.abc import Callable

from pyspark.sql import DataFrame

from parcelworks import fixed
from parcelworks.functions.casts import coerce
from parcelworks.operators.checks import check_rows, require_columns
from parcelworks.operators.clean import clean_rows, listing_rules, sold_rules
from parcelworks.operators.combine import keep_category
from parcelworks.operators.enrich import with_rates
from parcelworks.operators.events import (
    DEDUPE_KEY,
    EVENT_COLUMNS,
    REPEATED_TO_BROADCAST,
    first_of_each,
    identified_sales,
    listing_events,
    repeated_inputs,
    sale_events,
    with_sellers,
)
from parcelworks.operators.metrics import engineer
from parcelworks.operators.outliers import Pair, as_bounds, bounds_table, with_outlier_flags
from parcelworks.sources.staging import staged


def enriched_sold(sold: DataFrame, monthly: DataFrame) -> DataFrame:
    return with_rates(keep_category(sold), "CloseDate", monthly)


def enriched_listings(listings: DataFrame, monthly: DataFrame) -> DataFrame:
    return with_rates(keep_category(listings), "ListingContractDate", monthly)


def typed_sold(enriched: DataFrame, formats=fixed.DATE_FORMATS) -> DataFrame:
    """Numbers and dates of sold rows cast leniently, free of NaN.

    Store the result before cleaning: a filter on computed columns makes Spark compute them
    once per predicate.
    """
    require_columns(enriched, fixed.REQUIRED_SOLD_COLUMNS, "sold")
    return coerce(enriched, fixed.SOLD_NUMERIC_COLUMNS, fixed.SOLD_DATE_COLUMNS, formats)


def typed_listings(enriched: DataFrame, formats=fixed.DATE_FORMATS) -> DataFrame:
    """As ``typed_sold``, for listing rows."""
    require_columns(enriched, fixed.REQUIRED_LISTING_COLUMNS, "listings")
    return coerce(enriched, fixed.LISTING_NUMERIC_COLUMNS, fixed.LISTING_DATE_COLUMNS, formats)


def clean_sold(typed: DataFrame) -> DataFrame:
    """Sold rows that break no removing rule, with all rule flags."""
    return clean_rows(typed, sold_rules())


def clean_listings(typed: DataFrame) -> DataFrame:
    """Listing rows that break no removing rule, with all rule flags."""
    return clean_rows(typed, listing_rules())


def engineered_sold(cleaned: DataFrame) -> DataFrame:
    return engineer(cleaned)


def flagged_sold(engineered: DataFrame) -> DataFrame:
    """Outlier flags by bounds over the whole table: one pass for the bounds, one for the flags."""
    return with_outlier_flags(engineered, as_bounds(bounds_table(engineered)))


def ratio_bounds(kept: DataFrame, multiplier: float = fixed.IQR_MULTIPLIER) -> Pair:
    """Bounds of the price ratio over all kept sales, before any are deduplicated."""
    fields = [fixed.RATIO_COLUMN]
    return as_bounds(bounds_table(kept, fields, multiplier), fields)[fixed.RATIO_COLUMN]


def filtered_reconcile(kept: DataFrame, comparison: DataFrame) -> DataFrame:
    """Check that the rows kept are as many as the comparison of the two sets reports."""
    sides = kept.selectExpr("1L AS rows", "0L AS summary").unionByName(
        comparison.filter("dataset = 'clean_filtered'").selectExpr("0L AS rows", "row_count AS summary")
    )
    return check_rows(sides, {"filtered rows equal the summary": ("sum(rows)", "sum(summary)")})


def arrival_order(tie_breakers) -> list[str]:
    """The total order that decides which of several equal events is the first."""
    return ["SourceMonth", *tie_breakers]


def all_events(
    kept: DataFrame, listings: DataFrame, bounds: Pair, tie_breakers=(), columns=EVENT_COLUMNS
) -> DataFrame:
    """Sale and listing events of every input row, duplicates included, with ``columns`` of the event table."""
    order = arrival_order(tie_breakers)
    sales = sale_events(kept, bounds, order, columns=columns)
    return sales.unionByName(
        listing_events(listings, [name for name in order if name in listings.columns], columns=columns),
        allowMissingColumns=True,
    )


def events_among(
    kept: DataFrame, listings: DataFrame, bounds: Pair, tie_breakers=(), columns=EVENT_COLUMNS
) -> Callable[[DataFrame], DataFrame]:
    """``all_events`` whose identities have given hashes, for typed dates: rows are chosen before events are made.

    The chosen rows are stored: choosing and making events at once is more code than the JVM compiles.
    """

    def rows_of(df: DataFrame, event_type: str, date: str, source: str, hashes: DataFrame) -> DataFrame:
        names = {date, "ListingKey", fixed.RATIO_COLUMN, *arrival_order(tie_breakers), *columns}
        needed = df.select(*[name for name in df.columns if name in names])
        return staged(repeated_inputs(needed, event_type, date, source, hashes), "repeated-inputs")

    def chosen(hashes: DataFrame) -> DataFrame:
        sales = rows_of(kept, fixed.CLOSED_SALE, "CloseDate", fixed.SOLD_SOURCE, hashes)
        listed = rows_of(listings, fixed.NEW_LISTING, "ListingContractDate", fixed.LISTING_SOURCE, hashes)
        return all_events(sales, listed, bounds, tie_breakers, columns)

    return chosen


def market_events(
    events: DataFrame, tie_breakers=(), among: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One row per event identity and source, with the columns of the event table that ``events`` has.

    ``among`` are the ``events_among`` the same inputs, which spare making all events to choose repeated ones.
    """
    kept = first_of_each(events, DEDUPE_KEY, arrival_order(tie_breakers), REPEATED_TO_BROADCAST, among)
    return kept.select(*[name for name in fixed.EVENT_SCHEMA if name in events.columns])


def sales_table(kept: DataFrame, bounds: Pair, tie_breakers=()) -> DataFrame:
    """One sales record per closed-sale identity, chosen as for the events.

    Names are made after the choice: all columns at once are more code than the JVM compiles.
    """
    order = arrival_order(tie_breakers)
    names = ["ListAgentFirstName", "ListAgentLastName"]
    sales = identified_sales(kept, bounds).select(*dict.fromkeys([*fixed.SALE_COLUMNS, *names, *order]))
    return with_sellers(first_of_each(sales, ["EventId"], order)).select(*fixed.SALE_COLUMNS)
