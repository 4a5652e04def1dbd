"""Registered queries: each operator over domain data derived from a warehouse folder."""

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from parcelworks import fixed
from parcelworks.functions.casts import clean_text, coercion_audit, parse_date, parse_number, strict
from parcelworks.functions.logic import quoted, with_exprs
from parcelworks.operators import checks, clean, combine, duplicates, enrich, events, lattice, market, metrics, outliers, profile, rank_index
from parcelworks.plans import stages
from parcelworks.sources import identities, manifest, rates, sinks, versions, warehouse
from parcelworks.sources.split_csv import records_per_file
from parcelworks.sources.staging import new_folder, staged
from parcelworks.streaming import firsts, flagging, jobs, running

Query = Callable[[SparkSession, str], DataFrame]

SOLD_RULE_COLUMNS = list(dict.fromkeys([fixed.CATEGORY_COLUMN, *fixed.REQUIRED_SOLD_COLUMNS]))
LISTING_RULE_COLUMNS = list(dict.fromkeys([fixed.CATEGORY_COLUMN, *fixed.REQUIRED_LISTING_COLUMNS]))
TIES = warehouse.SOLD_TIE_BREAKERS
SALE_ID = events.event_id(fixed.CLOSED_SALE, "ListingKey", "CloseDate")
EVENT_INPUTS = [
    "ListingKey",
    "ListPrice",
    "OriginalListPrice",
    "LivingArea",
    "rate_30yr_fixed",
    "SourceMonth",
    *fixed.DIMENSION_COLUMNS,
]

#: the month and the kind of an event, by which measures choose
MEASURED_EVENTS = ["EventDate", "EventType"]
#: what the audit counts in the published events
AUDITED_EVENTS = [
    "EventType",
    "YrMo",
    "NewListings",
    "ClosedSales",
    "CloseToOriginalListRatioOutlierFlag",
    "CloseToOriginalListRatioEligible",
]
SELLER_COLUMNS = ["ListAgentFullName", "ListAgentFirstName", "ListAgentLastName", "ListOfficeName", "BuyerOfficeName"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the last bits of sums and interpolations depend on their order."""
    return with_exprs(
        df, {name: f"round({quoted(name)}, {digits})" for name, kind in df.dtypes if kind == "double"}
    )


def rounded_rate(df: DataFrame) -> DataFrame:
    """Only the mean rate rounded; the other numbers of a row are exact in themselves."""
    return with_exprs(df, {fixed.RATE_COLUMN: f"round({fixed.RATE_COLUMN}, 6)"})


# ---- inputs -------------------------------------------------------------------------------


def residential_sold(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    names = dict.fromkeys(["PropertyType", *columns])
    return combine.keep_category(warehouse.sold(spark, folder, *names))


def residential_listings(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    names = dict.fromkeys(["PropertyType", *columns])
    return combine.keep_category(warehouse.listings(spark, folder, *names))


def monthly_rates(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.monthly_rates(rates.observations(warehouse.weekly_rates(spark, folder)))


def cleaned_sold(spark: SparkSession, folder: str, *columns: str, rated: bool = False) -> DataFrame:
    """Clean sold rows over the stored typed table, as the stages hand tables on.

    The rate is joined only where a query asks for it or has it as a stage (``rated``), and only
    columns it asks for are stored; a rate that is not stored is one that Spark need not look up.
    """
    names = dict.fromkeys([*SOLD_RULE_COLUMNS, *columns])
    source = warehouse.sold(spark, folder, *[name for name in names if name != fixed.RATE_COLUMN])
    if rated or fixed.RATE_COLUMN in names:
        source = stages.enriched_sold(source, monthly_rates(spark, folder))
    else:
        source = enrich.dated(combine.keep_category(source), "CloseDate")
    return stages.clean_sold(staged(stages.typed_sold(source).select(*names), "sold"))


def cleaned_listings(spark: SparkSession, folder: str, *columns: str, rated: bool = False) -> DataFrame:
    """Clean listing rows over the stored typed table."""
    names = dict.fromkeys([*LISTING_RULE_COLUMNS, *columns])
    source = warehouse.listings(spark, folder, *[name for name in names if name != fixed.RATE_COLUMN])
    if rated or fixed.RATE_COLUMN in names:
        source = stages.enriched_listings(source, monthly_rates(spark, folder))
    else:
        source = enrich.dated(combine.keep_category(source), "ListingContractDate")
    return stages.clean_listings(staged(stages.typed_listings(source).select(*names), "listings"))


def engineered(spark: SparkSession, folder: str, *columns: str, rated: bool = False) -> DataFrame:
    """Metrics of the clean sold rows, a view on the stored typed table that passes read column-pruned."""
    return stages.engineered_sold(cleaned_sold(spark, folder, "OriginalListPrice", *columns, rated=rated))


def event_inputs(wanted: Sequence[str]) -> list[str]:
    """The inputs of events with the ``wanted`` columns."""
    return [name for name in EVENT_INPUTS if name in ("ListingKey", "SourceMonth", *wanted)]


def kept_sales(
    spark: SparkSession, folder: str, *columns: str, wanted: Sequence[str] = events.EVENT_COLUMNS
) -> tuple[DataFrame, outliers.Pair]:
    """Sales kept for analysis, with the inputs of ``wanted`` event columns and ``columns``, and the bounds of their ratio."""
    table = engineered(spark, folder, *event_inputs(wanted), *TIES, *columns, rated=True)
    kept = outliers.filtered(stages.flagged_sold(table))
    return kept, stages.ratio_bounds(kept)


def every_event(
    spark: SparkSession, folder: str, *columns: str, wanted: Sequence[str] = events.EVENT_COLUMNS
) -> tuple[DataFrame, Callable[[], DataFrame], DataFrame, outliers.Pair]:
    """All events before deduplication with the ``wanted`` columns, a maker of those kept, the kept sales, with
    ``columns`` besides, and the ratio bounds."""
    wanted = [*events.DEDUPE_KEY, *[name for name in wanted if name not in events.DEDUPE_KEY]]
    kept, bounds = kept_sales(spark, folder, *columns, wanted=wanted)
    ties = [name for name in TIES if name in warehouse.LISTING_COLUMNS]
    listings = cleaned_listings(spark, folder, *event_inputs(wanted), *ties, rated=True)
    found = stages.all_events(kept, listings, bounds, TIES, wanted)
    among = stages.events_among(kept, listings, bounds, TIES, wanted)
    return found, lambda: stages.market_events(found, TIES, among), kept, bounds


def published_events(
    spark: SparkSession, folder: str, wanted: Sequence[str] = events.EVENT_COLUMNS
) -> DataFrame:
    """The stored event table the market measures read: the ``wanted`` columns of all events."""
    _, firsts_of, _, _ = every_event(spark, folder, wanted=wanted)
    return staged(firsts_of().select(*wanted), "events")


# ---- combining files ----------------------------------------------------------------------


def file_selection(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.select_files(warehouse.file_paths(spark, folder), prefer_filled=False)


def month_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.missing_months(warehouse.file_paths(spark, folder))


def source_lineage(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.sold(spark, folder, "ListingKey", "SourceFile").selectExpr(
        "ListingKey",
        f"{manifest.month_of('SourceFile')} AS SourceMonth",
        "SourceFile",
        f"{manifest.version_of('SourceFile')} AS source_version",
    )


def category_filter(spark: SparkSession, folder: str) -> DataFrame:
    return residential_sold(spark, folder, "ListingKey").select("ListingKey", "PropertyType")


def category_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        combine.union_by_name(
            [
                combine.category_distribution(warehouse.sold(spark, folder, "PropertyType"), "sold"),
                combine.category_distribution(
                    warehouse.listings(spark, folder, "PropertyType"), "listing"
                ),
            ]
        )
    )


def _manifests(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["PropertyType", "SourceMonth", "SourceFile"]
    return combine.source_manifest(warehouse.sold(spark, folder, *columns), "sold").unionByName(
        combine.source_manifest(warehouse.listings(spark, folder, *columns), "listing")
    )


def source_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _manifests(spark, folder)


def aggregation_summary(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["PropertyType", "SourceMonth", "SourceFile"]
    manifest = _manifests(spark, folder)
    tables = {"sold": warehouse.sold(spark, folder, *columns), "listing": warehouse.listings(spark, folder, *columns)}
    return combine.union_by_name(
        [combine.aggregation_summary(manifest, df, combine.keep_category(df), name) for name, df in tables.items()]
    )


def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    shared = ["ListingKey", "PropertyType", "ListPrice"]
    return combine.union_by_name(
        [
            warehouse.sold(spark, folder, *shared, "ClosePrice"),
            warehouse.listings(spark, folder, *shared, "PropertySubType"),
        ]
    )


def _with_copies(spark: SparkSession, folder: str) -> DataFrame:
    names = ["ListPriceText", "ListPriceText.1", "ListPriceText.2", "CityText", "CityText.1"]
    renamed = {name: name.replace("Text", "") for name in names}
    return warehouse.listings(spark, folder, "ListingKey", *names, "SourceMonth", "SourceFile").withColumnsRenamed(
        renamed
    )


def duplicate_column_audit(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.audit(_with_copies(spark, folder), "listing")


def duplicate_column_totals(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.audit_totals(duplicates.audit(_with_copies(spark, folder), "listing"))


def duplicate_column_merge(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.merged(_with_copies(spark, folder)).drop("SourceMonth", "SourceFile")


# ---- casts --------------------------------------------------------------------------------


def numeric_coercion(spark: SparkSession, folder: str) -> DataFrame:
    return with_exprs(
        warehouse.sold(spark, folder, "ListingKey", "ClosePriceText"),
        {"ClosePrice": parse_number("ClosePriceText")},
    )


def numeric_coercion_audit(spark: SparkSession, folder: str) -> DataFrame:
    text = warehouse.sold(spark, folder, "ClosePriceText", "ListPrice").withColumnRenamed(
        "ClosePriceText", "ClosePrice"
    )
    return coercion_audit(text, "sold", fixed.SOLD_NUMERIC_COLUMNS)


def date_coercion(spark: SparkSession, folder: str) -> DataFrame:
    return with_exprs(
        warehouse.sold(spark, folder, "ListingKey", "CloseDateText"),
        {"CloseDate": parse_date("CloseDateText")},
    )


def date_coercion_audit(spark: SparkSession, folder: str) -> DataFrame:
    text = warehouse.sold(spark, folder, "CloseDateText", "PurchaseContractDate").withColumnRenamed(
        "CloseDateText", "CloseDate"
    )
    return coercion_audit(text, "sold", fixed.SOLD_DATE_COLUMNS, kind="date")


def strict_cast(spark: SparkSession, folder: str) -> DataFrame:
    orders = warehouse.table(spark, folder, "orders")
    cells = orders.selectExpr(
        "string(o_orderkey) AS key",
        "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS day",
        "concat(' ', o_custkey) AS customer",
        "string(bigint(o_totalprice)) AS price",
        "CASE WHEN o_orderstatus = 'F' THEN 'TRUE ' ELSE 'false' END AS finished",
    )
    kinds = {"key": "string", "day": "date", "customer": "integer", "price": "real", "finished": "boolean"}
    return cells.selectExpr(*[f"{strict(name, kind)} AS {name}" for name, kind in kinds.items()])


def clean_string(spark: SparkSession, folder: str) -> DataFrame:
    return with_exprs(
        warehouse.sold(spark, folder, "ListingKey", "ListAgentFullName"),
        {"ListAgentFullName": clean_text("ListAgentFullName")},
    )


def standardize_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    return events.standardize_dimensions(
        warehouse.sold(spark, folder, "ListingKey", *fixed.DIMENSION_COLUMNS)
    )


def agent_name_fallback(spark: SparkSession, folder: str) -> DataFrame:
    parts = ["ListAgentFullName", "ListAgentFirstName", "ListAgentLastName"]
    return warehouse.sold(spark, folder, "ListingKey", *parts).selectExpr(
        "ListingKey", f"{events.agent_name(*parts)} AS ListAgentFullName"
    )


# ---- profiles -----------------------------------------------------------------------------


def missing_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_summary(_profiled_sold(spark, folder))


def high_missing(spark: SparkSession, folder: str) -> DataFrame:
    return profile.high_missing(missing_summary(spark, folder))


def _profiled_sold(spark: SparkSession, folder: str) -> DataFrame:
    return residential_sold(
        spark,
        folder,
        "ListingKey",
        "CountyOrParish",
        "ListAgentFullName",
        "PurchaseContractDate",
        "CloseDate",
        *fixed.PROFILE_COLUMNS,
        "Latitude",
        "Longitude",
    )


def numeric_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.numeric_summary(residential_sold(spark, folder, *fixed.PROFILE_COLUMNS)))


def numeric_summary_listings(spark: SparkSession, folder: str) -> DataFrame:
    present = [name for name in fixed.PROFILE_COLUMNS if name != "ClosePrice"]
    return rounded(profile.numeric_summary(residential_listings(spark, folder, *present)))


def outlier_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.outlier_summary(residential_sold(spark, folder, *fixed.PROFILE_COLUMNS)))


def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.histogram(residential_sold(spark, folder, *fixed.PROFILE_COLUMNS)))


def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.box_stats(residential_sold(spark, folder, *fixed.PROFILE_COLUMNS)))


# ---- rates --------------------------------------------------------------------------------


def monthly_rate_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(monthly_rates(spark, folder))


def rate_series(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(enrich.rate_series(monthly_rates(spark, folder), "1999-06", "1996-02"))


def rate_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    sales = residential_sold(spark, folder, "ListingKey", "CloseDate")
    return rounded(enrich.with_rates(sales, "CloseDate", monthly_rates(spark, folder)))


def join_key_check(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.rate_keys_unique(monthly_rates(spark, folder))


def unmatched_months(spark: SparkSession, folder: str) -> DataFrame:
    sales = residential_sold(spark, folder, "CloseDate")
    return enrich.unmatched_months(sales, "CloseDate", monthly_rates(spark, folder))


def join_quality(spark: SparkSession, folder: str) -> DataFrame:
    monthly = staged(monthly_rates(spark, folder), "rates")
    return enrich.join_quality(
        residential_sold(spark, folder, "CloseDate"), "CloseDate", monthly, "sold"
    ).unionByName(
        enrich.join_quality(
            residential_listings(spark, folder, "ListingContractDate"),
            "ListingContractDate",
            monthly,
            "listings",
        )
    )


# ---- cleaning -----------------------------------------------------------------------------


def numeric_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _flags(
        residential_sold(spark, folder, "ListingKey", *SOLD_RULE_COLUMNS),
        clean.numeric_rules("ClosePrice", "close_price"),
    )


def numeric_flags_listings(spark: SparkSession, folder: str) -> DataFrame:
    return _flags(
        residential_listings(spark, folder, "ListingKey", *LISTING_RULE_COLUMNS),
        clean.numeric_rules("ListPrice", "list_price"),
    )


def date_flags(spark: SparkSession, folder: str) -> DataFrame:
    dates = ["ListingContractDate", "PurchaseContractDate", "CloseDate"]
    return _flags(residential_sold(spark, folder, "ListingKey", *dates), clean.date_rules())


def geo_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _flags(
        residential_sold(spark, folder, "ListingKey", "Latitude", "Longitude"), clean.geographic_rules()
    )


def _flags(df: DataFrame, rules) -> DataFrame:
    return clean.with_flags(df, rules).select("ListingKey", *[rule.flag for rule in rules])


def clean_sold_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _clean_columns(cleaned_sold(spark, folder, "ListingKey"), clean.sold_rules())


def clean_listing_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _clean_columns(cleaned_listings(spark, folder, "ListingKey"), clean.listing_rules())


def _clean_columns(df: DataFrame, rules) -> DataFrame:
    kept = [rule.flag for rule in rules if not rule.removes]
    return df.select("ListingKey", "LivingArea", "DaysOnMarket", "Latitude", "Longitude", *kept)


def flag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return clean.flag_counts(
        residential_sold(spark, folder, *SOLD_RULE_COLUMNS), "sold", clean.sold_rules()
    ).unionByName(
        clean.flag_counts(
            residential_listings(spark, folder, *LISTING_RULE_COLUMNS), "listings", clean.listing_rules()
        )
    )


def cleaning_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        clean.cleaning_summary(
            residential_sold(spark, folder, *SOLD_RULE_COLUMNS), "sold", clean.sold_rules()
        ).unionByName(
            clean.cleaning_summary(
                residential_listings(spark, folder, *LISTING_RULE_COLUMNS), "listings", clean.listing_rules()
            )
        )
    )


# ---- metrics ------------------------------------------------------------------------------


def price_metrics(spark: SparkSession, folder: str) -> DataFrame:
    sales = residential_sold(spark, folder, "ListingKey", "ClosePrice", "OriginalListPrice", "LivingArea")
    return metrics.price_metrics(sales).select(
        "ListingKey", "PriceRatio", "CloseToOriginalListRatio", "PricePerSqFt"
    )


def calendar_fields(spark: SparkSession, folder: str) -> DataFrame:
    sales = residential_sold(spark, folder, "ListingKey", "CloseDate")
    return metrics.calendar_fields(sales, "CloseDate").drop("PropertyType")


def timeline_days(spark: SparkSession, folder: str) -> DataFrame:
    dates = ["ListingContractDate", "PurchaseContractDate", "CloseDate"]
    sales = residential_sold(spark, folder, "ListingKey", *dates)
    return metrics.timeline_days(sales).select(
        "ListingKey", "ListingToContractDays", "ContractToCloseDays"
    )


def eligibility_flags(spark: SparkSession, folder: str) -> DataFrame:
    return engineered(spark, folder, "ListingKey").select("ListingKey", *metrics.ELIGIBLE.values())


def metric_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.metric_coverage(engineered(spark, folder))


def county_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.county_summary(engineered(spark, folder, "CountyOrParish")))


def complete_sample(spark: SparkSession, folder: str) -> DataFrame:
    order = ["SourceMonth", "ListingKey", "CloseDate", *TIES]
    return metrics.complete_sample(engineered(spark, folder, "CountyOrParish", *order), order)


# ---- outliers -----------------------------------------------------------------------------


def iqr_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(outliers.iqr_summary(engineered(spark, folder)))


def iqr_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = stages.flagged_sold(engineered(spark, folder, "ListingKey"))
    return flagged.select(
        "ListingKey",
        *[f"{name}_outlier_flag" for name in fixed.OUTLIER_FIELDS],
        "any_outlier_flag",
        *[f"{name}_invalid_flag" for name in fixed.OUTLIER_FIELDS],
        "business_rule_invalid_flag",
        "analysis_exclude_flag",
    )


def iqr_filtered(spark: SparkSession, folder: str) -> DataFrame:
    flagged = stages.flagged_sold(engineered(spark, folder, "ListingKey"))
    return outliers.filtered(flagged).select("ListingKey", *fixed.OUTLIER_FIELDS)


def dataset_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(outliers.dataset_comparison(stages.flagged_sold(engineered(spark, folder))))


def ratio_bounds(spark: SparkSession, folder: str) -> DataFrame:
    kept = outliers.filtered(stages.flagged_sold(engineered(spark, folder)))
    return rounded(outliers.bounds_table(kept, [fixed.RATIO_COLUMN]))


def ratio_quality(spark: SparkSession, folder: str) -> DataFrame:
    kept, bounds = kept_sales(spark, folder)
    ratio = fixed.RATIO_COLUMN
    return outliers.with_ratio_quality(kept, bounds).select(
        "ListingKey", ratio, f"{ratio}OutlierFlag", f"{ratio}Eligible"
    )


# ---- events and market --------------------------------------------------------------------


def event_id(spark: SparkSession, folder: str) -> DataFrame:
    return residential_sold(spark, folder, "ListingKey", "CloseDate").selectExpr(
        "ListingKey", f"{SALE_ID} AS EventId"
    )


def market_events(spark: SparkSession, folder: str) -> DataFrame:
    _, firsts_of, _, _ = every_event(spark, folder)
    return rounded_rate(firsts_of())


def republished_events(spark: SparkSession, folder: str) -> DataFrame:
    """The latest version of the events, after a first one that lacked half a month and a whole dataset."""
    table, root = staged(market_events(spark, folder), "events"), new_folder(spark, "published")
    versions.publish(table.filter("ClosedSales = 1 AND day(EventDate) < 15"), root, "YrMo")
    versions.publish(table, root, "YrMo")
    return versions.read_version(spark, root).select(*table.columns)


def event_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    sales = residential_sold(spark, folder, "ListingKey", "CloseDate", "ClosePrice", "SourceMonth", *TIES)
    named = with_exprs(sales, {"EventId": SALE_ID})
    first = events.first_of_each(named, ["EventId"], stages.arrival_order(TIES))
    return first.select("EventId", "ClosePrice")


def dedupe_counts(spark: SparkSession, folder: str) -> DataFrame:
    found, _, _, _ = every_event(spark, folder)
    return events.dedupe_counts(found)


def competitive_sales(spark: SparkSession, folder: str) -> DataFrame:
    kept, bounds = kept_sales(spark, folder, *SELLER_COLUMNS)
    return rounded_rate(stages.sales_table(kept, bounds, TIES))


def publish_extract(spark: SparkSession, folder: str) -> DataFrame:
    _, firsts_of, _, _ = every_event(spark, folder)
    return rounded_rate(sinks.publishable(firsts_of()))


def monthly_summary(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["YrMo", "NewListings", "ClosedSales", "ClosePrice", "DaysOnMarket", fixed.RATIO_COLUMN]
    return rounded(market.monthly_summary(published_events(spark, folder, wanted)))


def low_volume_months(spark: SparkSession, folder: str) -> DataFrame:
    _, firsts_of, _, _ = every_event(spark, folder)
    return market.with_low_volume(market.monthly_volumes(firsts_of()))


def measure(name: str, spark: SparkSession, folder: str) -> DataFrame:
    wanted = [*MEASURED_EVENTS, market.MEASURES[name][0]]
    return rounded(market.measure_series(published_events(spark, folder, wanted), *market.MEASURES[name]))


def measure_filtered(spark: SparkSession, folder: str) -> DataFrame:
    chosen = {"City": ["Brand#1", "Brand#2", "Brand#3"], "PropertySubType": ["ECONOMY", "SMALL"]}
    column, aggregation, closed_only = market.MEASURES["measure_median_close_price"]
    found = published_events(spark, folder, [*MEASURED_EVENTS, *chosen, column])
    return rounded(market.measure_series(found, column, aggregation, closed_only, chosen))


def measure_window(spark: SparkSession, folder: str) -> DataFrame:
    """Four months of a measure for two slicers, from the month folders of a published version."""
    root = new_folder(spark, "published")
    versions.publish(published_events(spark, folder), root, "YrMo")
    chosen = {"City": ["Brand#1", "Brand#2", "Brand#3"], "PropertySubType": ["ECONOMY", "SMALL"]}
    return rounded(
        market.published_measure(spark, root, "measure_median_close_price", chosen, "1995-03", "1995-06")
    )


def new_identities(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a full delivery whose identity an earlier one, of the first halves of months, did not have."""
    wanted = [*events.DEDUPE_KEY, "EventDate", "YrMo"]
    root, events_table = new_folder(spark, "identities"), published_events(spark, folder, wanted)
    identities.add(events_table.filter("day(EventDate) < 15"), root)
    return identities.fresh(events_table, root).select("SourceDataset", "EventId", "YrMo")


def slicer_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """All five measures for three choices of slicers, from the stored counts alone."""
    path = new_folder(spark, "lattice")
    measured = [column for column, _, _ in market.MEASURES.values()]
    lattice.store_lattice(published_events(spark, folder, [*MEASURED_EVENTS, *fixed.SLICER_COLUMNS, *measured]), path)
    choices = {
        "all": {},
        "city": {"City": ["Brand#1", "Brand#2", "Brand#3"]},
        "city and kind": {"City": ["Brand#1", "Brand#2", "Brand#3"], "PropertySubType": ["ECONOMY", "SMALL"]},
    }
    parts = [
        lattice.lattice_measure(spark, path, name, chosen).selectExpr(
            f"'{label}' AS choice", f"'{name}' AS measure", "EventMonth", f"double({market.MEASURES[name][0]}) AS value"
        )
        for label, chosen in choices.items()
        for name in market.MEASURES
    ]
    return rounded(combine.union_by_name(parts))


def top_sellers(by: str, spark: SparkSession, folder: str) -> DataFrame:
    kept, bounds = kept_sales(spark, folder, *SELLER_COLUMNS)
    return rounded(market.top_sellers(stages.sales_table(kept, bounds, TIES), by), 2)


def publication_audit(spark: SparkSession, folder: str) -> DataFrame:
    found, firsts_of, kept, bounds = every_event(spark, folder, *SELLER_COLUMNS)
    published = staged(firsts_of().select(*AUDITED_EVENTS), "events")
    return rounded(
        market.publication_audit(
            events.dedupe_counts(found),
            published,
            market.with_low_volume(market.monthly_volumes(published)),
            stages.sales_table(kept, bounds, TIES),
            bounds,
        )
    )


# ---- gates --------------------------------------------------------------------------------


def gate_category(spark: SparkSession, folder: str) -> DataFrame:
    return checks.only_category(warehouse.sold(spark, folder, "PropertyType"), "sold").unionByName(
        checks.only_category(residential_listings(spark, folder), "listings")
    )


def gate_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean.stays_clean(cleaned_sold(spark, folder), "sold", clean.sold_rules()).unionByName(
        clean.stays_clean(cleaned_listings(spark, folder), "listings", clean.listing_rules())
    )


def gate_event_date(spark: SparkSession, folder: str) -> DataFrame:
    listings = residential_listings(spark, folder, "ListingContractDate")
    sales = residential_sold(spark, folder, "CloseDate")
    return checks.dates_present(listings, "listings", "ListingContractDate").unionByName(
        checks.dates_present(sales, "sold", "CloseDate")
    )


def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["PropertyType", "SourceMonth", "SourceFile"]
    sold = warehouse.sold(spark, folder, *columns)
    table = engineered(spark, folder, *EVENT_INPUTS, *TIES, *SELLER_COLUMNS)
    flagged = staged(stages.flagged_sold(table), "flagged")
    kept = outliers.filtered(flagged)
    bounds = stages.ratio_bounds(kept)
    published = stages.market_events(events.sale_events(kept, bounds, stages.arrival_order(TIES)), TIES)
    # the files' side is counted in CSV files of the same rows, by quotes and line ends
    files = new_folder(spark, "sold-files")
    sinks.write_csv(sold, files)
    manifest = records_per_file(spark, [files]).selectExpr("rows AS rows_read")
    parts = [
        combine.parts_reconcile(sold, manifest, "sold"),
        checks.same_row_count("flagged rows equal engineered rows", flagged, table),
        stages.filtered_reconcile(kept, outliers.dataset_comparison(flagged)),
        checks.same_row_count(
            "market sales equal competitive sales",
            published.filter(f"EventType = '{fixed.CLOSED_SALE}'"),
            stages.sales_table(kept, bounds, TIES),
        ),
    ]
    return combine.union_by_name(parts)


# ---- streams ------------------------------------------------------------------------------


def _arriving_sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Residential sold records from order lines read as a stream."""
    lines = (
        spark.readStream.schema(warehouse.table(spark, folder, "lineitem").schema)
        .option("pathGlobFilter", "lineitem.parquet")
        .parquet(folder)
    )
    return combine.keep_category(warehouse.sold_from(lines, folder, "PropertyType", *columns))


def _landed(stream: DataFrame, label: str) -> DataFrame:
    """Everything that has arrived, appended to a table by a stream run to its end."""
    spark, path = stream.sparkSession, new_folder(stream.sparkSession, label)
    jobs.land(stream, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return _landed(_arriving_sales(spark, folder, "ListingKey", "SourceMonth", "SourceFile"), "ingest")


def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    named = _arriving_sales(spark, folder, "ListingKey", "CloseDate").selectExpr(f"{SALE_ID} AS EventId")
    return _landed(jobs.deduped(named, ["EventId"]), "dedupe")


def stream_first_events(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["ListingKey", "CloseDate", "ClosePrice", "SourceMonth", *TIES]
    named = with_exprs(_arriving_sales(spark, folder, *columns), {"EventId": SALE_ID}).select(
        "EventId", "ClosePrice", "SourceMonth", *[name for name in TIES if name not in ("EventId", "ClosePrice", "SourceMonth")]
    )
    path = new_folder(spark, "firsts")
    order = stages.arrival_order(TIES)
    firsts.land_first(named, f"{path}/table", f"{path}/checkpoint", ["EventId"], order).awaitTermination()
    return firsts.landed_first(spark, f"{path}/table", named.schema, ["EventId"]).select("EventId", "ClosePrice")


def indexed_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    sales = residential_sold(spark, folder, "SourceMonth", *fixed.OUTLIER_FIELDS)
    path = new_folder(spark, "rank-index")
    rank_index.index_months(sales, path, fixed.OUTLIER_FIELDS, "SourceMonth")
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    index = rank_index.stored_index(spark, path)
    found = rank_index.indexed_quantiles(index, sales, fixed.OUTLIER_FIELDS, quartiles, "SourceMonth")
    return rounded(found.select("field", "n", *quartiles))


def stream_flags(spark: SparkSession, folder: str) -> DataFrame:
    bounds = outliers.as_bounds(
        outliers.bounds_table(residential_sold(spark, folder, *fixed.OUTLIER_FIELDS))
    )
    arriving = _arriving_sales(spark, folder, "ListingKey", *fixed.OUTLIER_FIELDS)
    flagged = outliers.with_outlier_flags(arriving, bounds)
    return _landed(flagged.select("ListingKey", "any_outlier_flag", "analysis_exclude_flag"), "flags")


def stream_refreshed_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries of months, each flagged by the bounds of what has come until then."""
    path = new_folder(spark, "refreshed")
    sales = residential_sold(spark, folder, "ListingKey", "SourceMonth", *fixed.OUTLIER_FIELDS)
    early = "coalesce(SourceMonth < '202407', false)"
    for delivery in (early, f"NOT {early}"):
        sales.filter(delivery).write.mode("append").parquet(f"{path}/arrived")
        so_far = spark.read.schema(sales.schema).parquet(f"{path}/arrived")
        bounds = outliers.as_bounds(outliers.bounds_table(so_far))
        flagging.publish_bounds(bounds, spark, f"{path}/bounds")
        arriving = spark.readStream.schema(sales.schema).parquet(f"{path}/arrived")
        flagging.flag_arriving(arriving, f"{path}/bounds", f"{path}/flags", f"{path}/checkpoint").awaitTermination()
    return flagging.flagged_rows(spark, f"{path}/flags").select("ListingKey", "any_outlier_flag", "analysis_exclude_flag")


def _arriving_closings(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["CloseDate", "ClosePrice", "OriginalListPrice", "LivingArea", "DaysOnMarket"]
    sales = metrics.price_metrics(metrics.calendar_fields(_arriving_sales(spark, folder, *columns), "CloseDate"))
    return sales.selectExpr("*", "0 AS NewListings", "1 AS ClosedSales")


def stream_monthly_summary(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "running")
    jobs.count_into(_arriving_closings(spark, folder), f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    return rounded(jobs.running_summary(spark, f"{path}/counts"))


def stream_state_summary(spark: SparkSession, folder: str) -> DataFrame:
    checkpoint = new_folder(spark, "running-state")
    running.run_counts(_arriving_closings(spark, folder), checkpoint).awaitTermination()
    return rounded(running.running_measures(spark, checkpoint))


QUERIES: dict[str, Query] = {
    "file_selection": file_selection,
    "month_gaps": month_gaps,
    "source_lineage": source_lineage,
    "category_filter": category_filter,
    "category_distribution": category_distribution,
    "source_manifest": source_manifest,
    "aggregation_summary": aggregation_summary,
    "union_by_name": union_by_name,
    "duplicate_column_audit": duplicate_column_audit,
    "duplicate_column_totals": duplicate_column_totals,
    "duplicate_column_merge": duplicate_column_merge,
    "numeric_coercion": numeric_coercion,
    "numeric_coercion_audit": numeric_coercion_audit,
    "date_coercion": date_coercion,
    "date_coercion_audit": date_coercion_audit,
    "strict_cast": strict_cast,
    "clean_string": clean_string,
    "standardize_dimensions": standardize_dimensions,
    "agent_name_fallback": agent_name_fallback,
    "missing_summary": missing_summary,
    "high_missing": high_missing,
    "numeric_summary": numeric_summary,
    "numeric_summary_listings": numeric_summary_listings,
    "outlier_summary": outlier_summary,
    "histogram": histogram,
    "box_stats": box_stats,
    "monthly_rates": monthly_rate_table,
    "rate_series": rate_series,
    "rate_enrichment": rate_enrichment,
    "join_key_check": join_key_check,
    "unmatched_months": unmatched_months,
    "join_quality": join_quality,
    "numeric_flags": numeric_flags,
    "numeric_flags_listings": numeric_flags_listings,
    "date_flags": date_flags,
    "geo_flags": geo_flags,
    "clean_rows": clean_sold_rows,
    "clean_rows_listings": clean_listing_rows,
    "flag_counts": flag_counts,
    "cleaning_summary": cleaning_summary,
    "price_metrics": price_metrics,
    "calendar_fields": calendar_fields,
    "timeline_days": timeline_days,
    "eligibility_flags": eligibility_flags,
    "metric_coverage": metric_coverage,
    "county_summary": county_summary,
    "complete_sample": complete_sample,
    "iqr_summary": iqr_summary,
    "iqr_flags": iqr_flags,
    "iqr_filtered": iqr_filtered,
    "dataset_comparison": dataset_comparison,
    "ratio_bounds": ratio_bounds,
    "ratio_quality": ratio_quality,
    "event_id": event_id,
    "event_dedupe": event_dedupe,
    "indexed_quartiles": indexed_quartiles,
    "dedupe_counts": dedupe_counts,
    "market_events": market_events,
    "republished_events": republished_events,
    "competitive_sales": competitive_sales,
    "publish_extract": publish_extract,
    "monthly_summary": monthly_summary,
    "low_volume_months": low_volume_months,
    **{name: partial(measure, name) for name in market.MEASURES},
    "measure_filtered": measure_filtered,
    "measure_window": measure_window,
    "new_identities": new_identities,
    "slicer_lattice": slicer_lattice,
    "top_agents": partial(top_sellers, "ListAgentFullName"),
    "top_offices": partial(top_sellers, "ListOfficeName"),
    "publication_audit": publication_audit,
    "gate_category": gate_category,
    "gate_clean": gate_clean,
    "gate_event_date": gate_event_date,
    "reconciliation": reconciliation,
    "stream_ingest": stream_ingest,
    "stream_dedupe": stream_dedupe,
    "stream_first_events": stream_first_events,
    "stream_flags": stream_flags,
    "stream_refreshed_flags": stream_refreshed_flags,
    "stream_monthly_summary": stream_monthly_summary,
    "stream_state_summary": stream_state_summary,
}
