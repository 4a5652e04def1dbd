"""Market events and sales records, and their deduplication."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from parcelworks import fixed
from parcelworks.functions.casts import clean_text, coerce
from parcelworks.functions.logic import literal, quoted, with_exprs
from parcelworks.operators.checks import only_category
from parcelworks.operators.metrics import calendar_fields
from parcelworks.operators.outliers import Pair, with_ratio_quality
from parcelworks.sources.staging import staged

EVENT_COLUMNS = list(fixed.EVENT_SCHEMA)
DEDUPE_KEY = ["SourceDataset", "EventId"]
#: hashes of repeated keys that are broadcast, some tens of megabytes
REPEATED_TO_BROADCAST = 1_000_000
#: rows that are ordered at once without a look at which keys repeat
ROWS_ORDERED_AT_ONCE = 1_000_000


def standardize_dimensions(df: DataFrame, columns: Sequence[str] = fixed.DIMENSION_COLUMNS) -> DataFrame:
    """Clean text in every dimension; a postal code loses a trailing ``.0``."""
    cleaned = {name: clean_text(quoted(name)) for name in columns}
    if "PostalCode" in cleaned:
        cleaned["PostalCode"] = rf"regexp_replace({cleaned['PostalCode']}, r'\.0$', '')"
    return with_exprs(df, cleaned)


def event_id(event_type: str, key: str, date: str) -> str:
    """Type, key and day in one text; null when the key is missing."""
    bar = literal(fixed.EVENT_ID_SEPARATOR)
    return f"concat({literal(event_type)}, {bar}, {clean_text(key)}, {bar}, date_format({date}, 'yyyy-MM-dd'))"


def agent_name(full: str, first: str, last: str) -> str:
    """The full name, else first and last name, else null."""
    either = f"concat_ws(' ', {clean_text(first)}, {clean_text(last)})"
    # of trimmed parts, so there is nothing more to trim
    return f"coalesce({clean_text(full)}, nullif({either}, ''))"


def with_event_date(df: DataFrame, date_column: str) -> DataFrame:
    dated = coerce(df, dates=[date_column])
    return calendar_fields(with_exprs(dated, {"EventDate": f"date({quoted(date_column)})"}), "EventDate")


def _as_event(
    df: DataFrame, event_type: str, source: str, carry: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    is_sale = int(event_type == fixed.CLOSED_SALE)
    return with_exprs(
        df,
        {
            "EventType": literal(event_type),
            "EventId": event_id(event_type, "ListingKey", "EventDate"),
            "NewListings": f"{1 - is_sale}",
            "ClosedSales": f"{is_sale}",
            "RecordCount": "1",
            "SourceDataset": literal(source),
        },
    ).select(*columns, *carry)


def _dimensions(columns: Sequence[str]) -> list[str]:
    return [name for name in fixed.DIMENSION_COLUMNS if name in columns]


def _prepared_sales(
    sold: DataFrame, ratio_bounds: Pair, dimensions: Sequence[str] = fixed.DIMENSION_COLUMNS
) -> DataFrame:
    dated = with_event_date(standardize_dimensions(sold, dimensions), "CloseDate")
    return with_ratio_quality(dated, ratio_bounds)


def repeated_inputs(
    df: DataFrame, event_type: str, date: str, source: str, hashes: DataFrame
) -> DataFrame:
    """Rows whose event's ``DEDUPE_KEY`` has one of the hashes, before their events are made."""
    return with_hash_among(df, [literal(source), event_id(event_type, "ListingKey", quoted(date))], hashes)


def sale_events(
    sold: DataFrame,
    ratio_bounds: Pair,
    carry: Sequence[str] = (),
    source: str = fixed.SOLD_SOURCE,
    columns: Sequence[str] = EVENT_COLUMNS,
) -> DataFrame:
    """A closed-sale event per sold row, with ``columns`` of the event table; ``carry`` keeps columns that order duplicates."""
    prepared = _prepared_sales(sold, ratio_bounds, _dimensions(columns))
    return _as_event(prepared, fixed.CLOSED_SALE, source, carry, columns)


def listing_events(
    listings: DataFrame,
    carry: Sequence[str] = (),
    source: str = fixed.LISTING_SOURCE,
    columns: Sequence[str] = EVENT_COLUMNS,
) -> DataFrame:
    """A new-listing event per listing row, without any sale measure."""
    measures = ["ClosePrice", "DaysOnMarket", "CloseToOriginalListRatio", "PricePerSqFt"]
    flags = ["CloseToOriginalListRatioOutlierFlag", "CloseToOriginalListRatioEligible"]
    prepared = with_exprs(
        with_event_date(standardize_dimensions(listings, _dimensions(columns)), "ListingContractDate"),
        {name: "double(NULL)" for name in measures} | {name: "false" for name in flags},
    )
    return _as_event(prepared, fixed.NEW_LISTING, source, carry, columns)


def sale_records(sold: DataFrame, ratio_bounds: Pair, carry: Sequence[str] = ()) -> DataFrame:
    """Sales with seller names, volume and units, one per sold row."""
    return with_sellers(identified_sales(sold, ratio_bounds)).select(*fixed.SALE_COLUMNS, *carry)


def identified_sales(sold: DataFrame, ratio_bounds: Pair) -> DataFrame:
    """Sold rows with the identity, date and judged ratio of their sale."""
    return with_exprs(
        _prepared_sales(sold, ratio_bounds),
        {
            "EventId": event_id(fixed.CLOSED_SALE, "ListingKey", "EventDate"),
            "CloseDate": "EventDate",
            "SalesVolume": "ClosePrice",
            "UnitsSold": "1",
        },
    )


def with_sellers(sales: DataFrame) -> DataFrame:
    """Names of agent and offices, trimmed; an agent without a full name by first and last name."""
    return with_exprs(
        sales,
        {
            "ListAgentFullName": agent_name("ListAgentFullName", "ListAgentFirstName", "ListAgentLastName"),
            "ListOfficeName": clean_text("ListOfficeName"),
            "BuyerOfficeName": clean_text("BuyerOfficeName"),
        },
    )


def with_hash_among(df: DataFrame, key: Sequence[str], hashes: DataFrame, kind: str = "SEMI") -> DataFrame:
    """Rows the hash of whose key expressions is among ``hashes``, which are broadcast; with ANTI, all others."""
    return df.sparkSession.sql(
        f"SELECT /*+ BROADCAST(h) */ d.* FROM {{df}} d LEFT {kind} JOIN {{hashes}} h ON xxhash64({', '.join(key)}) = h.hash",
        df=df,
        hashes=hashes,
    )


def first_of_each(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    broadcast: int = 0,
    repeats: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The first row of every key in the given total order; a missing key is one key.

    Rows are gone through once. Spark keeps one row per key in each task before it shuffles (window
    group limit), so a key that repeats very often sends one row per task.

    With ``broadcast``, hashes of keys that repeat are counted first, from the key columns alone, and
    stored, unless there are few rows in all; where they are at most as many, only rows with such a hash are ordered, and all others
    stay where they are, unshuffled. ``df`` is then gone through three times; give a stored table or
    a view on one. ``repeats`` makes the rows of ``df`` for some hashes (see ``with_hash_among``), for
    views that are costly to compute for all rows only to choose a few.
    """
    keys, by = ", ".join(map(quoted, key)), ", ".join(map(quoted, order))
    # hashes are faster to compare than texts that begin alike
    hashed = f"xxhash64({keys})"

    def first(rows: DataFrame) -> DataFrame:
        placed = rows.selectExpr("*", f"row_number() OVER (PARTITION BY {hashed}, {keys} ORDER BY {by}) AS place")
        return placed.filter("place = 1").drop("place")

    if not broadcast or df.limit(ROWS_ORDERED_AT_ONCE + 1).count() <= ROWS_ORDERED_AT_ONCE:
        return first(df)
    counted = df.selectExpr(f"{hashed} AS hash").groupBy("hash").count()
    repeated = staged(counted.filter("count > 1").select("hash"), "repeated")
    found = repeated.count()
    if found > broadcast:
        return first(df)
    if not found:
        return df
    # at most ``broadcast`` hashes, as counted; keys that share a hash are told apart by ``first``
    parts = [quoted(name) for name in key]
    often = repeats(repeated).select(*map(quoted, df.columns)) if repeats else with_hash_among(df, parts, repeated)
    return with_hash_among(df, parts, repeated, "ANTI").union(first(often))


def dedupe_counts(events: DataFrame, key: Sequence[str] = DEDUPE_KEY) -> DataFrame:
    """Rows in, kept and removed per source, and rows whose identity is missing."""
    per_key = events.groupBy(*key).count()
    totals = [
        "sum(count) AS rows_in",
        "count(*) AS rows_kept",
        "sum(count) - count(*) AS rows_removed",
        f"sum(CASE WHEN {quoted(key[-1])} IS NULL THEN count ELSE 0 END) AS rows_without_id",
    ]
    return per_key.groupBy(*key[:-1]).agg(*[F.expr(text) for text in totals])


def typed_dimensions(df: DataFrame, dataset: str, value: str = fixed.CATEGORY) -> DataFrame:
    """Check that the trimmed category of every row to be published is the one kept."""
    return only_category(df, dataset, value=value, trimmed=True)


def not_yet_published(events: DataFrame, published: DataFrame, key: Sequence[str] = DEDUPE_KEY) -> DataFrame:
    """Events whose identity an earlier run has not published; those without identity stay."""
    return events.join(published.select(*key), list(key), "left_anti")
