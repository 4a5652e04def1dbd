"""The whole batch run: monthly files in, stored stage tables and reports out."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks import fixed
from parcelworks.functions.casts import coerce, coercion_audit
from parcelworks.operators import checks, clean, combine, duplicates, enrich, events, market, metrics, outliers, profile
from parcelworks.plans import stages
from parcelworks.sources import identities, versions
from parcelworks.sources.csv_files import monthly_paths, read_files
from parcelworks.sources.rates import observations, weekly_rates
from parcelworks.sources.sinks import publishable, write_observed, write_table
from parcelworks.sources.split_csv import records_per_file

ARRIVAL = ["SourceFile", "row_hash"]


def run(
    spark: SparkSession,
    folder: str,
    rates_path: str,
    out: str,
    sold_prefix: str = "Sold",
    listing_prefix: str = "Listing",
    first_month: str = fixed.FIRST_MONTH,
    *,
    category: str = fixed.CATEGORY,
    date_formats: Sequence[str] = fixed.DATE_FORMATS,
    latitudes: tuple[float, float] = fixed.LATITUDE_RANGE,
    longitudes: tuple[float, float] = fixed.LONGITUDE_RANGE,
    iqr_multiplier: float = fixed.IQR_MULTIPLIER,
    slicers: Mapping[str, Sequence[str]] = {},
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Run every stage over the monthly files of ``folder`` and return its tables and reports.

    Three full-width tables are stored per dataset at most, below ``out``: the combined files, the
    typed records and, for sales, the flagged ones. What only filters them or adds columns
    (``..._clean``, ``sold_engineered``) is returned without being stored. Reports are stored.
    Published events and their extract are versions below ``out/published``: a run over files of
    which one month has changed writes that month alone, and readers keep the version before until
    all gates have passed. Gates are enforced between the stages; a failed one ends the run. Their
    numbers are observed while the tables are written, so that no gate reads one again, but for the
    rules on clean listings, which no stage stores. ``slicers`` restrict the five
    measures; ``date_formats`` may have times of day; ``multi_line`` is for files whose quoted
    cells hold line breaks.
    """
    tables: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        tables[name] = write_table(df, f"{out}/{name}", partition_by)
        return tables[name]

    def keep_checked(
        name: str, df: DataFrame, gates: checks.Checks = {}, partition_by: str | None = None, **totals: str
    ) -> dict[str, int | None]:
        """Keep a table, enforce checks of its rows as seen in the write, and return the totals."""
        asked = {f"{side}{place}": text for place, pair in enumerate(gates.values()) for side, text in zip("oe", pair)}
        tables[name], seen = write_observed(df, f"{out}/{name}", {**asked, **totals}, partition_by)
        checks.enforce_observed({gate: (seen[f"o{place}"], seen[f"e{place}"]) for place, gate in enumerate(gates)})
        return {total: seen[total] for total in totals}

    monthly = keep("monthly_rates", enrich.monthly_rates(observations(weekly_rates(spark, rates_path))))
    checks.enforce(enrich.rate_keys_unique(monthly))

    boxed = {"latitudes": latitudes, "longitudes": longitudes}
    sources = {
        "sold": (sold_prefix, True, "CloseDate", stages.typed_sold, clean.sold_rules(**boxed)),
        "listings": (listing_prefix, False, "ListingContractDate", stages.typed_listings, clean.listing_rules(**boxed)),
    }
    for name, (prefix, prefer_filled, date_column, typed, rules) in sources.items():
        paths = monthly_paths(spark, folder, prefix, prefer_filled, first_month)
        files = read_files(spark, paths, multi_line)
        copies = duplicates.audit_files(files, name)
        if copies is not None:
            copies = keep(f"{name}_duplicate_columns", copies)
            keep(f"{name}_duplicate_totals", duplicates.audit_totals(copies))
        in_table = keep_checked(f"{name}_combined", duplicates.merged_files(files), rows="count(*)")
        combined = tables[f"{name}_combined"]
        # records are counted in the files, by their quotes and line ends, and held against the table made of them
        counted = combine.file_manifest(records_per_file(spark, paths), combined, name)
        in_files = keep_checked(f"{name}_manifest", counted, rows="sum(rows_read)")
        manifest = tables[f"{name}_manifest"]
        keep(f"{name}_categories", combine.category_distribution(combined, name))
        residential = combine.keep_category(combined, value=category)
        keep(f"{name}_aggregation", combine.aggregation_summary(manifest, combined, residential, name))
        checks.enforce_observed({f"{name} combined rows equal the files' rows": (in_table["rows"], in_files["rows"])})
        keep(f"{name}_missing", profile.missing_summary(residential))
        keep(f"{name}_high_missing", profile.high_missing(tables[f"{name}_missing"]))
        profiled = [column for column in fixed.PROFILE_COLUMNS if column in residential.columns]
        numbers = coerce(residential, profiled).select(*profiled)
        keep(f"{name}_numeric", profile.numeric_summary(numbers))
        keep(f"{name}_outliers", profile.outlier_summary(numbers))
        keep(f"{name}_histogram", profile.histogram(numbers))
        keep(f"{name}_box", profile.box_stats(numbers))
        keep(f"{name}_join_quality", enrich.join_quality(residential, date_column, monthly, name, date_formats))
        enriched = enrich.with_rates(residential, date_column, monthly, date_formats)
        audited = (
            (fixed.SOLD_NUMERIC_COLUMNS, fixed.SOLD_DATE_COLUMNS)
            if name == "sold"
            else (fixed.LISTING_NUMERIC_COLUMNS, fixed.LISTING_DATE_COLUMNS)
        )
        keep(f"{name}_number_audit", coercion_audit(enriched, name, audited[0]))
        keep(f"{name}_date_audit", coercion_audit(enriched, name, audited[1], "date", date_formats))
        clean_row = f"NOT ({clean.breaks_rules(rules)})"
        gates = checks.category_checks(name, value=category)
        if name == "listings":
            # of the rows that will be published
            gates |= checks.date_checks(name, date_column, clean_row)
            gates |= checks.category_checks(f"clean {name}", value=category, trimmed=True, among=clean_row)
        matched = keep_checked(
            f"{name}_typed", typed(enriched, date_formats), gates, unmatched=f"count_if({fixed.RATE_COLUMN} IS NULL)"
        )
        records = tables[f"{name}_typed"]
        if matched["unmatched"]:
            # names the months
            checks.enforce(enrich.all_matched(records, name))
        keep(f"{name}_flag_counts", clean.flag_counts(records, name, rules))
        keep(f"{name}_cleaning_summary", clean.cleaning_summary(records, name, rules))
        tables[f"{name}_clean"] = clean.clean_rows(records, rules)
        if name == "listings":
            # sold rows are judged when they are stored with their flags
            checks.enforce(clean.stays_clean(tables["listings_clean"], name, rules))

    engineered = tables["sold_engineered"] = stages.engineered_sold(tables["sold_clean"])
    keep("metric_coverage", metrics.metric_coverage(engineered))
    keep("county_summary", metrics.county_summary(engineered))
    order = ["SourceMonth", "ListingKey", "CloseDate", *ARRIVAL]
    keep("complete_sample", metrics.complete_sample(with_row_hash(engineered), order))

    bounds = outliers.as_bounds(outliers.bounds_table(engineered, multiplier=iqr_multiplier))
    outliers.store_bounds(bounds, spark, f"{out}/bounds")
    keep("iqr_summary", outliers.iqr_summary(engineered, multiplier=iqr_multiplier))
    kept_row = "NOT analysis_exclude_flag"
    of_flagged = keep_checked(
        "sold_flagged",
        outliers.with_outlier_flags(engineered, bounds),
        checks.rule_checks("sold", clean.removing(sources["sold"][-1]))
        | checks.date_checks("sold", "CloseDate", kept_row)
        | checks.category_checks("kept sold", value=category, trimmed=True, among=kept_row),
        "YrMo",
        rows="count(*)",
        kept=f"count_if({kept_row})",
    )
    flagged = tables["sold_flagged"]
    of_sets = keep_checked(
        "dataset_comparison",
        outliers.dataset_comparison(flagged),
        kept="coalesce(sum(CASE WHEN dataset = 'clean_filtered' THEN row_count END), 0)",
    )
    kept = outliers.filtered(flagged)
    # one row
    cleaned = tables["sold_cleaning_summary"].first().rows_after
    checks.enforce_observed(
        {
            "flagged rows equal engineered rows": (of_flagged["rows"], cleaned),
            "filtered rows equal the summary": (of_flagged["kept"], of_sets["kept"]),
        }
    )

    listings = tables["listings_clean"]
    ratio_bounds = stages.ratio_bounds(kept, iqr_multiplier)
    found = stages.all_events(with_row_hash(kept), with_row_hash(listings), ratio_bounds, ARRIVAL)
    of_events = keep_checked(
        "market_events",
        stages.market_events(found, ARRIVAL),
        partition_by="YrMo",
        sales=f"count_if(EventType = '{fixed.CLOSED_SALE}')",
    )
    of_sales = keep_checked(
        "competitive_sales",
        stages.sales_table(with_row_hash(kept), ratio_bounds, ARRIVAL),
        partition_by="YrMo",
        rows="count(*)",
    )
    published, sales = tables["market_events"], tables["competitive_sales"]
    checks.enforce_observed({"market sales equal competitive sales": (of_events["sales"], of_sales["rows"])})
    summary = keep("monthly_summary", market.monthly_summary(published))
    for measure, (column, aggregation, closed_only) in market.MEASURES.items():
        keep(measure, market.measure_series(published, column, aggregation, closed_only, slicers))
    keep("top_agents", market.top_sellers(sales, "ListAgentFullName"))
    keep("top_offices", market.top_sellers(sales, "ListOfficeName"))
    keep(
        "publication_audit",
        market.publication_audit(events.dedupe_counts(found), published, summary, sales, ratio_bounds),
    )
    extract = keep("market_extract", publishable(published))
    publish_events(spark, published, extract, f"{out}/published", keep)
    return tables


def publish_events(spark: SparkSession, events_table: DataFrame, extract: DataFrame, root: str, keep: Callable) -> None:
    """Publish events and extract as versions, and report which events no version before had.

    Only months whose rows have changed are written, and only they are compared, by identity, with
    the events ever published; events without one count as new whenever their month has changed.
    Each run first stores the identities of the version it finds, so one that stops after its
    version is out loses none.
    """
    table, stored = f"{root}/market_events", f"{root}/identities"
    known = versions.versions(spark, table)
    if known:
        first = identities.known(spark, stored).isEmpty()
        latest = versions.read_version(spark, table, known[-1], None if first else _written(spark, table, known[-1]))
        identities.add(latest, stored)
    number = versions.publish(events_table, table, "YrMo")
    versions.publish(extract, f"{root}/market_extract", "YrMo")
    changed = [] if known and number == known[-1] else _written(spark, table, number)
    fresh = identities.fresh(versions.read_version(spark, table, number, changed), stored)
    keep("newly_published", fresh.groupBy("YrMo", "SourceDataset").agg(F.expr("count(*) AS new_events")))


def _written(spark: SparkSession, root: str, version: int) -> list[str | None]:
    """The months that a version wrote itself."""
    return [row["month"] for row in versions.manifest(spark, root, version).filter(f"version = {version}").collect()]


def with_row_hash(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Adds a hash of the row, the last tie-breaker among rows of one file."""
    return df.selectExpr("*", f"xxhash64({', '.join(f'`{name}`' for name in columns or df.columns)}) AS row_hash")
