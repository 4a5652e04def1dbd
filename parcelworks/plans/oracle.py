"""Independent SQL for every registered query, written for DuckDB over the same tables."""

from parcelworks import fixed

# ---- shared table expressions -------------------------------------------------------------


def _file_month(date: str) -> str:
    return f"strftime({date} + INTERVAL 29 YEAR, '%Y%m')"


def _coordinates(key: str) -> str:
    return f"""
    CASE WHEN {key} % 19 = 0 THEN NULL WHEN {key} % 23 = 0 THEN 0.0
         ELSE 33.0 + ({key} % 90) / 10.0 END AS "Latitude",
    CASE WHEN {key} % 29 = 0 THEN 118.0 WHEN {key} % 31 = 0 THEN -200.0
         ELSE -124.0 + ({key} % 90) / 10.0 END AS "Longitude","""


POSTAL = """lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0')
    || CASE WHEN o_custkey % 5 = 0 THEN '.0' ELSE '' END AS "PostalCode","""
CATEGORY = """CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Land' ELSE 'Residential' END
    AS "PropertyType","""
COUNTY = """CASE WHEN o_custkey % 37 <> 0 THEN cn.n_name END AS "CountyOrParish","""

SOLD = f"""
sold_dates AS (
  SELECT *, CAST(o_orderdate AS DATE) AS listed,
    CASE WHEN l_partkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(l_quantity AS INTEGER)
      - CASE WHEN l_partkey % 89 = 0 THEN 60 ELSE 0 END END AS contracted,
    CASE WHEN l_partkey % 83 = 0 THEN CAST(l_shipdate AS DATE)
      ELSE CAST(o_orderdate AS DATE) + CAST(l_quantity + 10 + l_partkey % 40 AS INTEGER) END AS closed
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
),
sold AS (
  SELECT CASE WHEN l_partkey % 211 <> 0 THEN l_orderkey || '-' || l_linenumber END AS "ListingKey",
    {CATEGORY}
    p_type AS "PropertySubType", p_brand AS "City", {COUNTY}
    r_name AS "MLSAreaMajor", 'CA' AS "StateOrProvince", {POSTAL}
    listed AS "ListingContractDate", contracted AS "PurchaseContractDate", closed AS "CloseDate",
    closed AS "ContractStatusChangeDate",
    CASE WHEN l_partkey % 71 = 0 THEN NULL WHEN l_partkey % 73 = 0 THEN 0.0
      ELSE l_extendedprice * (1 - l_discount + l_tax) * CASE WHEN l_partkey % 47 = 0 THEN 12 ELSE 1 END
      END AS "ClosePrice",
    l_extendedprice AS "ListPrice",
    CASE WHEN l_partkey % 61 = 0 THEN 0.0 WHEN l_partkey % 51 = 0 THEN l_extendedprice / 4
      ELSE l_extendedprice END AS "OriginalListPrice",
    CAST(CASE WHEN l_partkey % 67 = 0 THEN NULL WHEN l_partkey % 79 = 0 THEN -p_size
      WHEN l_partkey % 53 = 0 THEN p_size * 6000 ELSE p_size * 100 END AS DOUBLE) AS "LivingArea",
    CASE WHEN l_partkey % 59 = 0 THEN -l_quantity WHEN l_partkey % 43 = 0 THEN l_quantity * 20
      ELSE l_quantity END AS "DaysOnMarket",
    CAST(CASE WHEN l_partkey % 101 = 0 THEN -1 ELSE p_size % 6 END AS DOUBLE) AS "BedroomsTotal",
    CAST(CASE WHEN l_partkey % 103 = 0 THEN -1 ELSE p_size % 4 END AS DOUBLE) AS "BathroomsTotalInteger",
    {_coordinates("l_suppkey")}
    CASE WHEN l_partkey % 20 = 0 THEN l_quantity / 8 END AS "LotSizeAcres",
    CAST(1950 + l_suppkey % 70 AS DOUBLE) AS "YearBuilt",
    CASE WHEN l_partkey % 71 = 0 THEN 'Seller without prices' WHEN l_suppkey % 7 = 0 THEN NULL
      WHEN l_suppkey % 11 = 0 THEN '  ' ELSE s_name || ' ' || (l_partkey % 4) END AS "ListAgentFullName",
    'Agent' AS "ListAgentFirstName", CAST(l_suppkey AS VARCHAR) AS "ListAgentLastName",
    sn.n_name AS "ListOfficeName", cn.n_name AS "BuyerOfficeName",
    {_file_month("closed")} AS "SourceMonth",
    'Sold' || {_file_month("closed")} || '.csv' AS "SourceFile",
    l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_orderkey,
    CAST(trunc(l_extendedprice) AS BIGINT) AS whole
  FROM sold_dates
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    LEFT JOIN region ON cn.n_regionkey = r_regionkey
),
res_sold AS (SELECT * FROM sold WHERE "PropertyType" = 'Residential')"""

LISTINGS = f"""
listings AS (
  SELECT CASE WHEN o_orderkey % 199 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 'home'
      ELSE CAST(o_orderkey AS VARCHAR) END AS "ListingKey", {CATEGORY}
    o_orderpriority AS "PropertySubType", 'City ' || (o_custkey % 50) AS "City", {COUNTY}
    r_name AS "MLSAreaMajor", 'CA' AS "StateOrProvince", {POSTAL}
    CASE WHEN o_orderkey % 107 <> 0 THEN CAST(o_orderdate AS DATE) END AS "ListingContractDate",
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS "ContractStatusChangeDate",
    CASE WHEN o_orderkey % 71 = 0 THEN NULL WHEN o_orderkey % 73 = 0 THEN 0.0 ELSE o_totalprice END
      AS "ListPrice",
    CASE WHEN o_orderkey % 61 = 0 THEN 0.0 ELSE o_totalprice END AS "OriginalListPrice",
    CAST(CASE WHEN o_orderkey % 67 = 0 THEN NULL WHEN o_orderkey % 79 = 0 THEN -1
      ELSE (o_orderkey % 50 + 1) * 100 END AS DOUBLE) AS "LivingArea",
    CAST(CASE WHEN o_orderkey % 59 = 0 THEN -(o_orderkey % 120) ELSE o_orderkey % 120 END AS DOUBLE)
      AS "DaysOnMarket",
    CAST(CASE WHEN o_orderkey % 101 = 0 THEN -1 ELSE o_orderkey % 6 END AS DOUBLE) AS "BedroomsTotal",
    CAST(CASE WHEN o_orderkey % 103 = 0 THEN -1 ELSE o_orderkey % 4 END AS DOUBLE)
      AS "BathroomsTotalInteger",
    {_coordinates("o_custkey")}
    CASE WHEN o_orderkey % 20 = 0 THEN (o_custkey % 80) / 8.0 END AS "LotSizeAcres",
    CAST(1950 + o_orderkey % 70 AS DOUBLE) AS "YearBuilt",
    {_file_month("CAST(o_orderdate AS DATE)")} AS "SourceMonth",
    'Listing' || {_file_month("CAST(o_orderdate AS DATE)")} || '.csv' AS "SourceFile",
    o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS whole
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
    LEFT JOIN region ON cn.n_regionkey = r_regionkey
),
res_listings AS (SELECT * FROM listings WHERE "PropertyType" = 'Residential'),
copies AS (
  SELECT "ListingKey", "SourceMonth", "SourceFile",
    CASE WHEN o_orderkey % 19 <> 0 THEN CAST(whole AS VARCHAR) END AS price,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN CAST(whole + 1 AS VARCHAR)
      ELSE whole || '.00' END AS price1,
    CASE WHEN o_orderkey % 11 = 0 THEN ' ' || whole END AS price2,
    CASE WHEN o_orderkey % 23 <> 0 THEN 'City ' || (o_orderkey % 50) END AS city,
    CASE WHEN o_orderkey % 29 = 0 THEN 'elsewhere' WHEN o_orderkey % 31 = 0 THEN NULL
      ELSE 'City ' || (o_orderkey % 50) || ' ' END AS city1
  FROM listings
)"""

RATES = """
weekly AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS date, avg(o_totalprice) / 20000 AS rate
  FROM orders GROUP BY 1
),
monthly AS (
  SELECT strftime(date, '%Y-%m') AS year_month, avg(rate) AS rate_30yr_fixed,
    count(*) AS weekly_observation_count
  FROM weekly WHERE date IS NOT NULL AND rate IS NOT NULL GROUP BY 1
)"""


def _flag(name: str, predicate: str) -> tuple[str, str]:
    return name, f"coalesce({predicate}, false)"


GEO = dict(
    [
        _flag("missing_coordinate_flag", '"Latitude" IS NULL OR "Longitude" IS NULL'),
        ("zero_coordinate_flag", 'coalesce("Latitude" = 0, false) OR coalesce("Longitude" = 0, false)'),
        _flag("positive_longitude_flag", '"Longitude" > 0'),
        _flag("invalid_latitude_range_flag", '"Latitude" < -90 OR "Latitude" > 90'),
        _flag("invalid_longitude_range_flag", '"Longitude" < -180 OR "Longitude" > 180'),
        _flag(
            "out_of_california_flag",
            '"Latitude" IS NOT NULL AND "Longitude" IS NOT NULL AND ("Latitude" < 32.0 '
            'OR "Latitude" > 42.5 OR "Longitude" < -125.0 OR "Longitude" > -114.0)',
        ),
    ]
)
DATES = dict(
    [
        _flag("listing_after_close_flag", '"ListingContractDate" > "CloseDate"'),
        _flag("purchase_after_close_flag", '"PurchaseContractDate" > "CloseDate"'),
        _flag("negative_timeline_flag", '"ListingContractDate" > "PurchaseContractDate"'),
    ]
)


def _numeric(price: str, label: str) -> dict[str, str]:
    return dict(
        [
            _flag(f"missing_{label}_flag", f'"{price}" IS NULL'),
            _flag("missing_living_area_flag", '"LivingArea" IS NULL'),
            _flag(f"invalid_{label}_flag", f'"{price}" <= 0'),
            _flag("invalid_living_area_flag", '"LivingArea" <= 0'),
            _flag("negative_days_on_market_flag", '"DaysOnMarket" < 0'),
            _flag("negative_bedrooms_flag", '"BedroomsTotal" < 0'),
            _flag("negative_bathrooms_flag", '"BathroomsTotalInteger" < 0'),
        ]
    )


SOLD_NUMERIC = _numeric("ClosePrice", "close_price")
LISTING_NUMERIC = _numeric("ListPrice", "list_price")
SOLD_FLAGS = {**SOLD_NUMERIC, **DATES, **GEO}
LISTING_FLAGS = {**LISTING_NUMERIC, **GEO}


def _select(flags: dict[str, str]) -> str:
    return ", ".join(f"{predicate} AS {name}" for name, predicate in flags.items())


def _removes(flags: dict[str, str]) -> str:
    return " OR ".join(f"({p})" for name, p in flags.items() if not name.startswith("missing"))


CLEAN = f"""
clean_sold AS (
  SELECT *, {_select(SOLD_FLAGS)}, strftime("CloseDate", '%Y-%m') AS year_month
  FROM res_sold WHERE "CloseDate" IS NOT NULL AND NOT ({_removes(SOLD_FLAGS)})
),
clean_listings AS (
  SELECT *, {_select(LISTING_FLAGS)}, strftime("ListingContractDate", '%Y-%m') AS year_month
  FROM res_listings WHERE "ListingContractDate" IS NOT NULL AND NOT ({_removes(LISTING_FLAGS)})
)"""

ENGINEERED = """
engineered AS (
  SELECT *,
    CASE WHEN "OriginalListPrice" > 0 THEN "ClosePrice" / "OriginalListPrice" END AS "PriceRatio",
    CASE WHEN "OriginalListPrice" > 0 THEN "ClosePrice" / "OriginalListPrice" END
      AS "CloseToOriginalListRatio",
    CASE WHEN "LivingArea" > 0 THEN "ClosePrice" / "LivingArea" END AS "PricePerSqFt",
    CAST(year("CloseDate") AS INTEGER) AS "Year", CAST(month("CloseDate") AS INTEGER) AS "Month",
    strftime("CloseDate", '%Y-%m') AS "YrMo",
    CAST("PurchaseContractDate" - "ListingContractDate" AS INTEGER) AS "ListingToContractDays",
    CAST("CloseDate" - "PurchaseContractDate" AS INTEGER) AS "ContractToCloseDays"
  FROM clean_sold
)"""


def _quartiles(field: str, source: str) -> str:
    return f"""SELECT '{field}' AS field, quantile_cont("{field}", 0.25) AS q1,
    quantile_cont("{field}", 0.5) AS median, quantile_cont("{field}", 0.75) AS q3,
    CAST(count(*) AS BIGINT) AS rows_total, CAST(count("{field}") AS BIGINT) AS rows_non_null
    FROM {source}"""


def _bounds(fields, source: str) -> str:
    union = " UNION ALL ".join(_quartiles(field, source) for field in fields)
    return f"""SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound,
    q3 + 1.5 * (q3 - q1) AS upper_bound FROM ({union})"""


def _beyond(field: str, table: str = "bounds") -> str:
    low = f"(SELECT lower_bound FROM {table} WHERE field = '{field}')"
    high = f"(SELECT upper_bound FROM {table} WHERE field = '{field}')"
    return f'coalesce("{field}" < {low} OR "{field}" > {high}, false)'


FIELDS = fixed.OUTLIER_FIELDS
RATIO = fixed.RATIO_COLUMN
FLAGGED = f"""
bounds AS MATERIALIZED ({_bounds(FIELDS, "engineered")}),
outlier_marks AS (
  SELECT *, {", ".join(f'{_beyond(field)} AS "{field}_outlier_flag"' for field in FIELDS)},
    coalesce("ClosePrice" <= 0, false) AS "ClosePrice_invalid_flag",
    coalesce("LivingArea" <= 0, false) AS "LivingArea_invalid_flag",
    coalesce("DaysOnMarket" < 0, false) AS "DaysOnMarket_invalid_flag"
  FROM engineered
),
any_marks AS (
  SELECT *, {" OR ".join(f'"{field}_outlier_flag"' for field in FIELDS)} AS any_outlier_flag,
    {" OR ".join(f'"{field}_invalid_flag"' for field in FIELDS)} AS business_rule_invalid_flag
  FROM outlier_marks
),
flagged AS (
  SELECT *, any_outlier_flag OR business_rule_invalid_flag AS analysis_exclude_flag FROM any_marks
),
kept AS (SELECT * FROM flagged WHERE NOT analysis_exclude_flag),
ratio_bounds AS MATERIALIZED ({_bounds([RATIO], "kept")}),
rated AS (
  SELECT kept.* EXCLUDE ("{RATIO}"), {_beyond(RATIO, "ratio_bounds")} AS outlier,
    "{RATIO}" IS NOT NULL AND NOT {_beyond(RATIO, "ratio_bounds")} AS eligible, "{RATIO}" AS raw_ratio,
    rate_30yr_fixed
  FROM kept LEFT JOIN monthly USING (year_month)
)"""


def _trim(column: str) -> str:
    return f"""nullif(regexp_replace({column}, '^\\s+|\\s+$', '', 'g'), '')"""


DIMENSIONS = ", ".join(
    f'{_trim(chr(34) + name + chr(34))} AS "{name}"'
    if name != "PostalCode"
    else f"""regexp_replace({_trim('"PostalCode"')}, '\\.0$', '') AS "PostalCode\""""
    for name in fixed.DIMENSION_COLUMNS
)
AGENT = f"""coalesce({_trim('"ListAgentFullName"')},
    nullif(trim(coalesce({_trim('"ListAgentFirstName"')}, '') || ' '
      || coalesce({_trim('"ListAgentLastName"')}, '')), ''))"""
SALE_ID = """'Closed Sale|' || "ListingKey" || '|' || strftime("CloseDate", '%Y-%m-%d')"""
TIES = '"SourceMonth", l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_orderkey'

EVENTS = f"""
sale_events AS (
  SELECT {SALE_ID} AS "EventId", 'Closed Sale' AS "EventType", "CloseDate" AS "EventDate",
    "Year", "Month", "YrMo", "ListingKey", {DIMENSIONS},
    "ListPrice", "OriginalListPrice", "ClosePrice", "LivingArea", "DaysOnMarket",
    CASE WHEN eligible THEN raw_ratio END AS "{RATIO}", outlier AS "{RATIO}OutlierFlag",
    eligible AS "{RATIO}Eligible", "PricePerSqFt", rate_30yr_fixed,
    0 AS "NewListings", 1 AS "ClosedSales", 1 AS "RecordCount",
    'Week 7 clean filtered sold' AS "SourceDataset",
    row_number() OVER (PARTITION BY {SALE_ID} ORDER BY {TIES}) AS place
  FROM rated
),
new_events AS (
  SELECT 'New Listing|' || "ListingKey" || '|' || strftime("ListingContractDate", '%Y-%m-%d')
      AS "EventId",
    'New Listing' AS "EventType", "ListingContractDate" AS "EventDate",
    CAST(year("ListingContractDate") AS INTEGER) AS "Year",
    CAST(month("ListingContractDate") AS INTEGER) AS "Month",
    year_month AS "YrMo", "ListingKey", {DIMENSIONS},
    "ListPrice", "OriginalListPrice", CAST(NULL AS DOUBLE) AS "ClosePrice", "LivingArea",
    CAST(NULL AS DOUBLE) AS "DaysOnMarket", CAST(NULL AS DOUBLE) AS "{RATIO}",
    false AS "{RATIO}OutlierFlag", false AS "{RATIO}Eligible", CAST(NULL AS DOUBLE) AS "PricePerSqFt",
    rate_30yr_fixed, 1 AS "NewListings", 0 AS "ClosedSales", 1 AS "RecordCount",
    'Weeks 4-5 clean listings' AS "SourceDataset",
    row_number() OVER (
      PARTITION BY 'New Listing|' || "ListingKey" || '|' || strftime("ListingContractDate", '%Y-%m-%d')
      ORDER BY "SourceMonth", o_orderkey) AS place
  FROM clean_listings LEFT JOIN monthly USING (year_month)
),
all_events AS (SELECT * FROM sale_events UNION ALL SELECT * FROM new_events),
events_kept AS (SELECT * EXCLUDE (place) FROM all_events WHERE place = 1),
sales AS (
  SELECT {SALE_ID} AS "EventId", "CloseDate", "Year", "Month", "YrMo", "ListingKey",
    {AGENT} AS "ListAgentFullName", {_trim('"ListOfficeName"')} AS "ListOfficeName",
    {_trim('"BuyerOfficeName"')} AS "BuyerOfficeName", {DIMENSIONS}, "ClosePrice",
    "ClosePrice" AS "SalesVolume", 1 AS "UnitsSold", "DaysOnMarket",
    CASE WHEN eligible THEN raw_ratio END AS "{RATIO}", outlier AS "{RATIO}OutlierFlag",
    eligible AS "{RATIO}Eligible", "PricePerSqFt", rate_30yr_fixed
  FROM rated
  QUALIFY row_number() OVER (PARTITION BY {SALE_ID} ORDER BY {TIES}) = 1
),
summary AS (
  SELECT "YrMo", CAST(sum("NewListings") AS BIGINT) AS "NewListings",
    CAST(sum("ClosedSales") AS BIGINT) AS "ClosedSales",
    quantile_cont("ClosePrice", 0.5) AS "MedianClosePrice",
    avg("DaysOnMarket") AS "AverageDaysOnMarket",
    avg("{RATIO}") AS "AverageCloseToOriginalListRatio"
  FROM events_kept GROUP BY 1
),
summary_flags AS (
  SELECT *,
    "NewListings" < (SELECT quantile_cont("NewListings", 0.5) FROM summary) * 0.5
      AS "NewListingsLowVolumeFlag",
    "ClosedSales" < (SELECT quantile_cont("ClosedSales", 0.5) FROM summary) * 0.5
      AS "ClosedSalesLowVolumeFlag"
  FROM summary
)"""

STAGES = {
    "sold": [SOLD],
    "listings": [LISTINGS],
    "rates": [RATES],
    "sold+rates": [SOLD, RATES],
    "both+rates": [SOLD, LISTINGS, RATES],
    "both": [SOLD, LISTINGS],
    "clean": [SOLD, LISTINGS, CLEAN],
    "engineered": [SOLD, LISTINGS, CLEAN, ENGINEERED],
    "flagged": [SOLD, LISTINGS, RATES, CLEAN, ENGINEERED, FLAGGED],
    "events": [SOLD, LISTINGS, RATES, CLEAN, ENGINEERED, FLAGGED, EVENTS],
}


def _over(stage: str, select: str, *more: str) -> str:
    return "WITH " + ",".join([*STAGES[stage], *more]) + "\n" + select


def _round(*columns: str) -> str:
    return ", ".join(f'round("{name}", 6) AS "{name}"' for name in columns)


# ---- one statement per query --------------------------------------------------------------

FILES = """
last_orders AS (
  SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last FROM orders GROUP BY 1
),
paths AS (
  SELECT DISTINCT strftime(last + INTERVAL 29 YEAR, '%Y%m') AS source_month,
    CASE WHEN o_custkey % 2 = 0 THEN 'filled' ELSE 'raw' END AS source_version
  FROM last_orders
),
files AS (
  SELECT *, 'Sold' || source_month || CASE source_version WHEN 'filled' THEN '_filled' ELSE '' END
      || '.csv' AS source_file
  FROM paths
)"""


def _missing(columns: dict[str, str]) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", CAST(count(*) FILTER (WHERE {test}) AS BIGINT) AS "Missing Count",
        round_even(count(*) FILTER (WHERE {test}) / CAST(count(*) AS DOUBLE) * 100, 2) AS "Missing %"
        FROM res_sold"""
        for name, test in columns.items()
    )
    return rows


MISSING = _missing(
    {
        name: f'"{name}" IS NULL'
        for name in [
            "PropertyType",
            "ListingKey",
            "CountyOrParish",
            "ListAgentFullName",
            "PurchaseContractDate",
            "CloseDate",
            *fixed.PROFILE_COLUMNS,
            "Latitude",
            "Longitude",
        ]
    }
)


def _profile(source: str, columns) -> str:
    percentiles = ", ".join(
        f'round(quantile_cont(v, {p}), 6) AS "{label}"' for label, p in fixed.PROFILE_PERCENTILES.items()
    )
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", CAST(count(v) AS BIGINT) AS "count", round(avg(v), 6) AS mean,
        round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min, {percentiles}, round(max(v), 6) AS max
        FROM (SELECT "{name}" AS v FROM {source})"""
        for name in columns
    )


def _long(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS field, "{name}" AS v FROM {source} WHERE "{name}" IS NOT NULL"""
        for name in columns
    )


SHOWN = f"""
long AS ({_long("res_sold", fixed.PROFILE_COLUMNS)}),
ends AS (
  SELECT field, quantile_cont(v, 0.01) AS low, quantile_cont(v, 0.99) AS high FROM long GROUP BY field
),
shown AS (
  SELECT long.field, v FROM long JOIN ends USING (field) WHERE (v >= low AND v <= high) OR low = high
)"""

HISTOGRAM = """
spans AS (
  SELECT field, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS low,
    CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS high
  FROM shown GROUP BY field
),
widths AS (SELECT *, (high - low) / 50 AS width FROM spans),
bins AS (
  SELECT field, CAST(bin AS INTEGER) AS bin, low + bin * width AS bin_start,
    CASE WHEN bin = 49 THEN high ELSE low + (bin + 1) * width END AS bin_end
  FROM widths, range(50) AS r(bin)
)"""

COERCED_NUMBER = """CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN NULL
    WHEN l_partkey % 19 = 0 THEN CAST(whole AS DOUBLE) WHEN l_partkey % 23 = 0 THEN NULL
    WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN CAST(whole AS DOUBLE) * 10
    WHEN l_partkey % 37 = 0 THEN NULL ELSE CAST(whole AS DOUBLE) END"""
NUMBER_TEXT = """CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN '1,' || whole
    WHEN l_partkey % 19 = 0 THEN ' ' || chr(9) || whole || ' ' WHEN l_partkey % 23 = 0 THEN whole || 'd'
    WHEN l_partkey % 29 = 0 THEN 'NaN' WHEN l_partkey % 31 = 0 THEN whole || 'e1'
    WHEN l_partkey % 37 = 0 THEN '0x1F' ELSE CAST(whole AS VARCHAR) END"""
COERCED_DATE = """CASE WHEN l_partkey % 13 = 0 OR l_partkey % 17 = 0 THEN NULL
    WHEN l_partkey % 19 = 0 THEN "CloseDate" WHEN l_partkey % 23 = 0 OR l_partkey % 29 = 0 THEN NULL
    ELSE "CloseDate" END"""
DATE_TEXT = """CASE WHEN l_partkey % 13 = 0 THEN NULL
    WHEN l_partkey % 17 = 0 THEN strftime("CloseDate", '%m/%d/%Y')
    WHEN l_partkey % 19 = 0 THEN strftime("CloseDate", '%Y-%-m-%-d')
    WHEN l_partkey % 23 = 0 THEN strftime("CloseDate", '%Y') WHEN l_partkey % 29 = 0 THEN '2001-02-30'
    ELSE strftime("CloseDate", '%Y-%m-%d') END"""


def _audit(rows: list[tuple[str, str, str]], label: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'sold' AS dataset, '{name}' AS "column",
        CAST(count(*) FILTER (WHERE {before}) AS BIGINT) AS missing_before,
        CAST(count(*) FILTER (WHERE {after}) AS BIGINT) AS missing_after,
        CAST(count(*) FILTER (WHERE {after}) - count(*) FILTER (WHERE {before}) AS BIGINT) AS {label}
        FROM sold"""
        for name, before, after in rows
    )


def _distribution(dataset: str, source: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, coalesce("PropertyType", '<missing>') AS "PropertyType",
    CAST(count(*) AS BIGINT) AS row_count,
    round(round_even(count(*) / CAST((SELECT count(*) FROM {source}) AS DOUBLE) * 100, 4), 6)
      AS percent_of_dataset
    FROM {source} GROUP BY 2"""


def _manifest(dataset: str, source: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, "SourceMonth" AS source_month, "SourceFile" AS source_file,
    'raw' AS source_version, CAST(count(*) AS BIGINT) AS rows_read,
    CAST(count(*) FILTER (WHERE "PropertyType" = 'Residential') AS BIGINT) AS residential_rows
    FROM {source} GROUP BY 2, 3"""


MANIFEST = f'{_manifest("sold", "sold")} UNION ALL {_manifest("listing", "listings")}'


def _number(text: str) -> str:
    return f"TRY_CAST(trim({text}) AS DOUBLE)"


def _pair(original: str, copy: str, left: str, right: str, numeric: bool) -> str:
    equal = f"coalesce(trim({left}) = trim({right}), false)"
    if numeric:
        equal = f"({equal} OR coalesce({_number(left)} = {_number(right)}, false))"
    classes = {
        "equivalent_rows": f"(({left}) IS NULL AND ({right}) IS NULL) OR {equal}",
        "canonical_only_rows": f"({left}) IS NOT NULL AND ({right}) IS NULL",
        "duplicate_only_rows_recovered": f"({left}) IS NULL AND ({right}) IS NOT NULL",
        "conflicting_non_null_rows_kept_canonical": f"({left}) IS NOT NULL AND ({right}) IS NOT NULL "
        f"AND NOT {equal}",
    }
    counts = ", ".join(
        f"CAST(count(*) FILTER (WHERE {test}) AS BIGINT) AS {name}" for name, test in classes.items()
    )
    return f"""SELECT 'listing' AS dataset, "SourceMonth" AS source_month, "SourceFile" AS source_file,
    '{original}' AS original_column, '{copy}' AS duplicate_column,
    CAST(count(*) AS BIGINT) AS rows_checked, {counts} FROM copies GROUP BY 2, 3"""


COPY_AUDIT = " UNION ALL ".join(
    [
        _pair("ListPrice", "ListPrice.1", "price", "price1", True),
        _pair("ListPrice", "ListPrice.2", "coalesce(price, price1)", "price2", True),
        _pair("City", "City.1", "city", "city1", False),
    ]
)


def _flag_counts(dataset: str, source: str, flags: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{name}' AS flag,
        CAST(count(*) FILTER (WHERE {test}) AS BIGINT) AS flagged_rows FROM {source}"""
        for name, test in flags.items()
    )


def _cleaning(dataset: str, source: str, flags: dict[str, str]) -> str:
    removed = f"count(*) FILTER (WHERE {_removes(flags)})"
    return f"""SELECT '{dataset}' AS dataset, CAST(count(*) AS BIGINT) AS rows_before,
    CAST({removed} AS BIGINT) AS rows_removed, CAST(count(*) - {removed} AS BIGINT) AS rows_after,
    round(round_even({removed} / CAST(count(*) AS DOUBLE) * 100, 4), 6) AS percent_removed FROM {source}"""


def _join_quality(dataset: str, source: str, date: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, '{date}' AS date_column,
    CAST(count(*) AS BIGINT) AS rows_before_date_validation,
    CAST(count(*) FILTER (WHERE "{date}" IS NULL) AS BIGINT) AS invalid_or_missing_date_rows_removed,
    CAST(count("{date}") AS BIGINT) AS rows_after_date_validation,
    CAST(count("{date}") FILTER (WHERE rate_30yr_fixed IS NULL) AS BIGINT) AS rows_without_mortgage_rate
    FROM {source} LEFT JOIN monthly ON strftime("{date}", '%Y-%m') = year_month"""


def _coverage(metric: str, label: str) -> str:
    return f"""SELECT '{label}' AS metric, CAST(count("{metric}") AS BIGINT) AS rows_populated,
    CAST(count(*) - count("{metric}") AS BIGINT) AS rows_missing FROM engineered"""


def _medians(dataset: str, source: str) -> str:
    medians = ", ".join(f'round(quantile_cont("{f}", 0.5), 6) AS "median_{f}"' for f in FIELDS)
    return f"SELECT '{dataset}' AS dataset, CAST(count(*) AS BIGINT) AS row_count, {medians} FROM {source}"


def _check(name: str, observed: str, expected: str) -> str:
    return f"""SELECT '{name}' AS "check", CAST(({observed}) AS BIGINT) AS observed,
    CAST(({expected}) AS BIGINT) AS expected,
    (CAST(({observed}) AS BIGINT) IS NOT DISTINCT FROM CAST(({expected}) AS BIGINT)) AS passed"""


def _measure(expression: str, name: str, closed: bool, extra: str = "") -> str:
    where = " AND ".join(filter(None, ["\"EventType\" = 'Closed Sale'" if closed else "true", extra]))
    return _over(
        "events",
        f"""SELECT CAST(date_trunc('month', "EventDate") AS DATE) AS "EventMonth", {expression} AS "{name}"
        FROM events_kept WHERE {where} GROUP BY 1""",
    )


def _ranking(name: str) -> str:
    return _over(
        "events",
        f"""SELECT "{name}", round(coalesce(sum("SalesVolume"), 0), 2) AS "SalesVolume",
        CAST(sum("UnitsSold") AS BIGINT) AS "UnitsSold" FROM sales WHERE "{name}" IS NOT NULL
        GROUP BY 1 ORDER BY coalesce(sum("SalesVolume"), 0) DESC, 3 DESC, 1 LIMIT 100""",
    )


EVENT_LIST = ", ".join(
    _round(name) if name == fixed.RATE_COLUMN else f'"{name}"'
    for name, kind in fixed.EVENT_SCHEMA.items()
)
PUBLISHED_LIST = ", ".join(
    f'CAST("{name}" AS BIGINT) AS "{name}"'
    if kind == "integer"
    else (_round(name) if name == fixed.RATE_COLUMN else f'"{name}"')
    for name, kind in fixed.EVENT_SCHEMA.items()
    if name not in fixed.DIRECT_IDENTIFIERS
)
SALE_LIST = ", ".join(
    _round(name) if name == fixed.RATE_COLUMN else f'"{name}"' for name in fixed.SALE_COLUMNS
)
LISTING_PROFILE = [name for name in fixed.PROFILE_COLUMNS if name != "ClosePrice"]

ORACLE: dict[str, str] = {
    "file_selection": "WITH "
    + FILES
    + """
    SELECT '/data/' || source_file AS path, source_file, source_month, source_version FROM files
    WHERE source_month >= '202401'
    QUALIFY row_number() OVER (PARTITION BY source_month ORDER BY source_version = 'raw' DESC) = 1""",
    "month_gaps": "WITH "
    + FILES
    + """,
    latest AS (SELECT max(source_month) AS m FROM files),
    expected AS (
      SELECT strftime(unnest(generate_series(DATE '2024-01-01', CAST(strptime(m || '01', '%Y%m%d') AS DATE),
        INTERVAL 1 MONTH)), '%Y%m') AS source_month FROM latest
    )
    SELECT source_month FROM expected WHERE source_month NOT IN (SELECT source_month FROM files)""",
    "source_lineage": _over(
        "sold", """SELECT "ListingKey", "SourceMonth", "SourceFile", 'raw' AS source_version FROM sold"""
    ),
    "category_filter": _over("sold", 'SELECT "ListingKey", "PropertyType" FROM res_sold'),
    "category_distribution": _over(
        "both", f'{_distribution("sold", "sold")} UNION ALL {_distribution("listing", "listings")}'
    ),
    "source_manifest": _over("both", MANIFEST),
    "aggregation_summary": _over(
        "both",
        f"""SELECT dataset, min(source_month) AS first_month, max(source_month) AS last_month,
        CAST(count(*) AS BIGINT) AS monthly_files_used, CAST(sum(rows_read) AS BIGINT) AS rows_before_concat,
        CAST(CASE dataset WHEN 'sold' THEN (SELECT count(*) FROM sold) ELSE (SELECT count(*) FROM listings) END
          AS BIGINT) AS rows_after_concat,
        CAST(CASE dataset WHEN 'sold' THEN (SELECT count(*) FROM sold) ELSE (SELECT count(*) FROM listings) END
          AS BIGINT) AS rows_before_residential_filter,
        CAST(CASE dataset WHEN 'sold' THEN (SELECT count(*) FROM res_sold)
          ELSE (SELECT count(*) FROM res_listings) END AS BIGINT) AS rows_after_residential_filter
        FROM ({MANIFEST}) GROUP BY dataset""",
    ),
    "union_by_name": _over(
        "both",
        """SELECT "ListingKey", "PropertyType", "ListPrice", "ClosePrice",
          CAST(NULL AS VARCHAR) AS "PropertySubType" FROM sold
        UNION ALL
        SELECT "ListingKey", "PropertyType", "ListPrice", CAST(NULL AS DOUBLE),
          "PropertySubType" FROM listings""",
    ),
    "duplicate_column_audit": _over("listings", COPY_AUDIT),
    "duplicate_column_totals": _over(
        "listings",
        f"""SELECT CAST(count(DISTINCT original_column || '/' || duplicate_column) AS BIGINT) AS duplicate_pairs,
        CAST(sum(conflicting_non_null_rows_kept_canonical) AS BIGINT) AS conflicts_kept,
        CAST(sum(duplicate_only_rows_recovered) AS BIGINT) AS values_recovered FROM ({COPY_AUDIT})""",
    ),
    "duplicate_column_merge": _over(
        "listings",
        """SELECT "ListingKey", coalesce(price, price1, price2) AS "ListPrice",
        coalesce(city, city1) AS "City" FROM copies""",
    ),
    "numeric_coercion": _over(
        "sold",
        f"""SELECT "ListingKey", {NUMBER_TEXT} AS "ClosePriceText", {COERCED_NUMBER} AS "ClosePrice" FROM sold""",
    ),
    "numeric_coercion_audit": _over(
        "sold",
        _audit(
            [
                ("ClosePrice", f"({NUMBER_TEXT}) IS NULL", f"({COERCED_NUMBER}) IS NULL"),
                ("ListPrice", '"ListPrice" IS NULL', '"ListPrice" IS NULL'),
            ],
            "new_invalid_numeric_values",
        ),
    ),
    "date_coercion": _over(
        "sold",
        f"""SELECT "ListingKey", {DATE_TEXT} AS "CloseDateText", {COERCED_DATE} AS "CloseDate" FROM sold""",
    ),
    "date_coercion_audit": _over(
        "sold",
        _audit(
            [
                ("CloseDate", f"({DATE_TEXT}) IS NULL", f"({COERCED_DATE}) IS NULL"),
                (
                    "PurchaseContractDate",
                    '"PurchaseContractDate" IS NULL',
                    '"PurchaseContractDate" IS NULL',
                ),
            ],
            "new_invalid_dates",
        ),
    ),
    "strict_cast": """SELECT CAST(o_orderkey AS VARCHAR) AS key,
        CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, o_custkey AS customer,
        trunc(o_totalprice) AS price, o_orderstatus = 'F' AS finished FROM orders""",
    "clean_string": _over(
        "sold",
        f"""SELECT "ListingKey", {_trim('"ListAgentFullName"')} AS "ListAgentFullName" FROM sold""",
    ),
    "standardize_dimensions": _over("sold", f'SELECT "ListingKey", {DIMENSIONS} FROM sold'),
    "agent_name_fallback": _over("sold", f'SELECT "ListingKey", {AGENT} AS "ListAgentFullName" FROM sold'),
    "missing_summary": _over("sold", MISSING),
    "high_missing": _over("sold", f'SELECT * FROM ({MISSING}) WHERE "Missing %" > 90'),
    "numeric_summary": _over("sold", _profile("res_sold", fixed.PROFILE_COLUMNS)),
    "numeric_summary_listings": _over("listings", _profile("res_listings", LISTING_PROFILE)),
    "outlier_summary": _over(
        "sold",
        f"""SELECT b.field AS "Column", rows_non_null AS "Count", round(q1, 6) AS "Q1",
        round(median, 6) AS "Median", round(q3, 6) AS "Q3", round(iqr, 6) AS "IQR",
        round(lower_bound, 6) AS "Lower Bound", round(upper_bound, 6) AS "Upper Bound",
        CAST(count(*) FILTER (WHERE v < lower_bound OR v > upper_bound) AS BIGINT) AS "Outlier Count",
        round(round_even(count(*) FILTER (WHERE v < lower_bound OR v > upper_bound)
          / CAST(rows_non_null AS DOUBLE) * 100, 2), 6) AS "Outlier %"
        FROM b JOIN long USING (field)
        GROUP BY b.field, rows_non_null, q1, median, q3, iqr, lower_bound, upper_bound""",
        f"b AS ({_bounds(fixed.PROFILE_COLUMNS, 'res_sold')})",
        f"long AS ({_long('res_sold', fixed.PROFILE_COLUMNS)})",
    ),
    "histogram": _over(
        "sold",
        f"""SELECT bins.field, bin, round(bin_start, 6) AS bin_start, round(bin_end, 6) AS bin_end,
        CAST(count(v) AS BIGINT) AS rows
        FROM bins LEFT JOIN shown ON shown.field = bins.field AND v >= bin_start
          AND (v < bin_end OR (bin = 49 AND v = bin_end))
        GROUP BY ALL""",
        SHOWN,
        HISTOGRAM,
    ),
    "box_stats": _over(
        "sold",
        """SELECT field, CAST(count(*) AS BIGINT) AS rows, round(q1, 6) AS q1, round(median, 6) AS median,
        round(q3, 6) AS q3, round(least(min(v) FILTER (WHERE v >= low AND v <= high), q1), 6) AS whisker_low,
        round(greatest(max(v) FILTER (WHERE v >= low AND v <= high), q3), 6) AS whisker_high,
        CAST(count(*) FILTER (WHERE v < low OR v > high) AS BIGINT) AS fliers
        FROM shown JOIN fences USING (field) GROUP BY field, q1, median, q3""",
        SHOWN,
        """fences AS (
          SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
            SELECT field, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
              quantile_cont(v, 0.75) AS q3 FROM shown GROUP BY field))""",
    ),
    "monthly_rates": _over(
        "rates",
        f'SELECT year_month, {_round("rate_30yr_fixed")}, weekly_observation_count FROM monthly',
    ),
    "rate_series": _over(
        "rates",
        f"""SELECT year_month, {_round("rate_30yr_fixed")}, weekly_observation_count,
        CAST(year_month || '-01' AS DATE) AS date FROM monthly
        WHERE year_month BETWEEN '1996-02' AND '1999-06'""",
    ),
    "rate_enrichment": _over(
        "sold+rates",
        f"""SELECT "PropertyType", "ListingKey", "CloseDate", strftime("CloseDate", '%Y-%m') AS year_month,
        {_round("rate_30yr_fixed")}, weekly_observation_count
        FROM res_sold LEFT JOIN monthly ON strftime("CloseDate", '%Y-%m') = year_month
        WHERE "CloseDate" IS NOT NULL""",
    ),
    "join_key_check": _over(
        "rates",
        _check(
            "months repeated in the rate table",
            "SELECT count(*) FROM (SELECT year_month FROM monthly GROUP BY 1 HAVING count(*) > 1)",
            "0",
        ),
    ),
    "unmatched_months": _over(
        "sold+rates",
        """SELECT strftime("CloseDate", '%Y-%m') AS year_month, CAST(count(*) AS BIGINT) AS rows
        FROM res_sold WHERE "CloseDate" IS NOT NULL AND strftime("CloseDate", '%Y-%m') NOT IN
          (SELECT year_month FROM monthly WHERE rate_30yr_fixed IS NOT NULL) GROUP BY 1""",
    ),
    "join_quality": _over(
        "both+rates",
        _join_quality("sold", "res_sold", "CloseDate")
        + " UNION ALL "
        + _join_quality("listings", "res_listings", "ListingContractDate"),
    ),
    "numeric_flags": _over("sold", f'SELECT "ListingKey", {_select(SOLD_NUMERIC)} FROM res_sold'),
    "numeric_flags_listings": _over(
        "listings", f'SELECT "ListingKey", {_select(LISTING_NUMERIC)} FROM res_listings'
    ),
    "date_flags": _over("sold", f'SELECT "ListingKey", {_select(DATES)} FROM res_sold'),
    "geo_flags": _over("sold", f'SELECT "ListingKey", {_select(GEO)} FROM res_sold'),
    "clean_rows": _over(
        "clean",
        """SELECT "ListingKey", "LivingArea", "DaysOnMarket", "Latitude", "Longitude",
        missing_close_price_flag, missing_living_area_flag, missing_coordinate_flag FROM clean_sold""",
    ),
    "clean_rows_listings": _over(
        "clean",
        """SELECT "ListingKey", "LivingArea", "DaysOnMarket", "Latitude", "Longitude",
        missing_list_price_flag, missing_living_area_flag, missing_coordinate_flag FROM clean_listings""",
    ),
    "flag_counts": _over(
        "both",
        _flag_counts("sold", "res_sold", SOLD_FLAGS)
        + " UNION ALL "
        + _flag_counts("listings", "res_listings", LISTING_FLAGS),
    ),
    "cleaning_summary": _over(
        "both",
        _cleaning("sold", "res_sold", SOLD_FLAGS)
        + " UNION ALL "
        + _cleaning("listings", "res_listings", LISTING_FLAGS),
    ),
    "price_metrics": _over(
        "sold",
        """SELECT "ListingKey",
        CASE WHEN "OriginalListPrice" > 0 THEN "ClosePrice" / "OriginalListPrice" END AS "PriceRatio",
        CASE WHEN "OriginalListPrice" > 0 THEN "ClosePrice" / "OriginalListPrice" END
          AS "CloseToOriginalListRatio",
        CASE WHEN "LivingArea" > 0 THEN "ClosePrice" / "LivingArea" END AS "PricePerSqFt"
        FROM res_sold""",
    ),
    "calendar_fields": _over(
        "sold",
        """SELECT "ListingKey", "CloseDate", CAST(year("CloseDate") AS INTEGER) AS "Year",
        CAST(month("CloseDate") AS INTEGER) AS "Month", strftime("CloseDate", '%Y-%m') AS "YrMo"
        FROM res_sold""",
    ),
    "timeline_days": _over(
        "sold",
        """SELECT "ListingKey",
        CAST(date_diff('day', "ListingContractDate", "PurchaseContractDate") AS INTEGER)
          AS "ListingToContractDays",
        CAST(date_diff('day', "PurchaseContractDate", "CloseDate") AS INTEGER) AS "ContractToCloseDays"
        FROM res_sold""",
    ),
    "eligibility_flags": _over(
        "engineered",
        """SELECT "ListingKey", "PriceRatio" IS NOT NULL AS price_ratio_eligible_flag,
        "PricePerSqFt" IS NOT NULL AS ppsf_eligible_flag,
        "ListingToContractDays" IS NOT NULL AS listing_to_contract_eligible_flag,
        "ContractToCloseDays" IS NOT NULL AS contract_to_close_eligible_flag FROM engineered""",
    ),
    "metric_coverage": _over(
        "engineered",
        " UNION ALL ".join(
            _coverage(metric, label)
            for metric, label in {
                "PriceRatio": "PriceRatio / CloseToOriginalListRatio",
                "PricePerSqFt": "PricePerSqFt",
                "ListingToContractDays": "ListingToContractDays",
                "ContractToCloseDays": "ContractToCloseDays",
            }.items()
        ),
    ),
    "county_summary": _over(
        "engineered",
        """SELECT "CountyOrParish", CAST(count(*) AS BIGINT) AS "Transactions",
        round(quantile_cont("ClosePrice", 0.5), 6) AS "MedianClosePrice",
        round(avg("PricePerSqFt"), 6) AS "AveragePricePerSqFt",
        round(avg("PriceRatio"), 6) AS "AveragePriceRatio",
        round(avg("DaysOnMarket"), 6) AS "AverageDaysOnMarket",
        round(avg("ListingToContractDays"), 6) AS "AverageListingToContractDays",
        round(avg("ContractToCloseDays"), 6) AS "AverageContractToCloseDays"
        FROM engineered GROUP BY 1""",
    ),
    "complete_sample": _over(
        "engineered",
        """SELECT "ListingKey", "CloseDate", "ClosePrice", "OriginalListPrice", "LivingArea",
        "PriceRatio", "CloseToOriginalListRatio", "PricePerSqFt", "DaysOnMarket", "Year", "Month", "YrMo",
        "ListingToContractDays", "ContractToCloseDays", "CountyOrParish" FROM engineered
        WHERE "PriceRatio" IS NOT NULL AND "PricePerSqFt" IS NOT NULL
          AND "ListingToContractDays" IS NOT NULL AND "ContractToCloseDays" IS NOT NULL
        ORDER BY engineered."SourceMonth", engineered."ListingKey", engineered."CloseDate", l_partkey,
          l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_orderkey LIMIT 20""",
    ),
    "iqr_summary": _over(
        "flagged",
        f"""SELECT b.field, rows_total, rows_non_null, rows_total - rows_non_null AS rows_missing,
        {_round("q1", "q3", "iqr", "lower_bound", "upper_bound")},
        CAST(count(*) FILTER (WHERE v < lower_bound OR v > upper_bound) AS BIGINT) AS outlier_count,
        round(count(*) FILTER (WHERE v < lower_bound OR v > upper_bound)
          / CAST(rows_total AS DOUBLE) * 100, 6) AS outlier_pct
        FROM bounds b JOIN long USING (field)
        GROUP BY b.field, rows_total, rows_non_null, q1, q3, iqr, lower_bound, upper_bound""",
        f"long AS ({_long('engineered', FIELDS)})",
    ),
    "iqr_flags": _over(
        "flagged",
        f"""SELECT "ListingKey", {", ".join(f'"{f}_outlier_flag"' for f in FIELDS)}, any_outlier_flag,
        {", ".join(f'"{f}_invalid_flag"' for f in FIELDS)}, business_rule_invalid_flag,
        analysis_exclude_flag FROM flagged""",
    ),
    "iqr_filtered": _over(
        "flagged", 'SELECT "ListingKey", "ClosePrice", "LivingArea", "DaysOnMarket" FROM kept'
    ),
    "dataset_comparison": _over(
        "flagged", f'{_medians("full_flagged", "flagged")} UNION ALL {_medians("clean_filtered", "kept")}'
    ),
    "ratio_bounds": _over(
        "flagged", f'SELECT field, {_round("lower_bound", "upper_bound")} FROM ratio_bounds'
    ),
    "ratio_quality": _over(
        "flagged",
        f"""SELECT "ListingKey", CASE WHEN eligible THEN raw_ratio END AS "{RATIO}",
        outlier AS "{RATIO}OutlierFlag", eligible AS "{RATIO}Eligible" FROM rated""",
    ),
    "event_id": _over("sold", f'SELECT "ListingKey", {SALE_ID} AS "EventId" FROM res_sold'),
    "event_dedupe": _over(
        "sold",
        f"""SELECT {SALE_ID} AS "EventId", "ClosePrice" FROM res_sold
        QUALIFY row_number() OVER (PARTITION BY {SALE_ID} ORDER BY {TIES}) = 1""",
    ),
    "dedupe_counts": _over(
        "events",
        """SELECT "SourceDataset", CAST(count(*) AS BIGINT) AS rows_in,
        CAST(count(*) FILTER (WHERE place = 1) AS BIGINT) AS rows_kept,
        CAST(count(*) FILTER (WHERE place > 1) AS BIGINT) AS rows_removed,
        CAST(count(*) FILTER (WHERE "EventId" IS NULL) AS BIGINT) AS rows_without_id
        FROM all_events GROUP BY 1""",
    ),
    "market_events": _over("events", f"SELECT {EVENT_LIST} FROM events_kept"),
    "republished_events": _over("events", f"SELECT {EVENT_LIST} FROM events_kept"),
    "competitive_sales": _over("events", f"SELECT {SALE_LIST} FROM sales"),
    "publish_extract": _over("events", f"SELECT {PUBLISHED_LIST} FROM events_kept"),
    "monthly_summary": _over(
        "events",
        f"""SELECT "YrMo", "NewListings", "ClosedSales", {_round("MedianClosePrice", "AverageDaysOnMarket",
          "AverageCloseToOriginalListRatio")}, "NewListingsLowVolumeFlag", "ClosedSalesLowVolumeFlag"
        FROM summary_flags""",
    ),
    "low_volume_months": _over(
        "events",
        """SELECT "YrMo", "NewListings", "ClosedSales", "NewListingsLowVolumeFlag",
        "ClosedSalesLowVolumeFlag" FROM summary_flags""",
    ),
    "measure_median_close_price": _measure(
        'round(quantile_cont("ClosePrice", 0.5), 6)', "ClosePrice", True
    ),
    "measure_average_days_on_market": _measure('round(avg("DaysOnMarket"), 6)', "DaysOnMarket", True),
    "measure_average_ratio": _measure(f'round(avg("{RATIO}"), 6)', RATIO, True),
    "measure_new_listings": _measure('CAST(sum("NewListings") AS BIGINT)', "NewListings", False),
    "measure_closed_sales": _measure('CAST(sum("ClosedSales") AS BIGINT)', "ClosedSales", False),
    "measure_filtered": _measure(
        'round(quantile_cont("ClosePrice", 0.5), 6)',
        "ClosePrice",
        True,
        """"City" IN ('Brand#1', 'Brand#2', 'Brand#3') AND "PropertySubType" IN ('ECONOMY', 'SMALL')""",
    ),
    "measure_window": _measure(
        'round(quantile_cont("ClosePrice", 0.5), 6)',
        "ClosePrice",
        True,
        """"City" IN ('Brand#1', 'Brand#2', 'Brand#3') AND "PropertySubType" IN ('ECONOMY', 'SMALL')
        AND "EventDate" >= DATE '1995-03-01' AND "EventDate" < DATE '1995-07-01'""",
    ),
    "new_identities": _over(
        "events",
        """SELECT "SourceDataset", "EventId", "YrMo" FROM events_kept k
        WHERE NOT EXISTS (SELECT 1 FROM events_kept e WHERE e."SourceDataset" = k."SourceDataset"
          AND e."EventId" = k."EventId" AND day(e."EventDate") < 15)""",
    ),
    "top_agents": _ranking("ListAgentFullName"),
    "top_offices": _ranking("ListOfficeName"),
    "publication_audit": _over(
        "events",
        f"""SELECT
        CAST((SELECT count(*) FROM sale_events) AS BIGINT) AS sold_input_rows,
        CAST((SELECT count(*) FROM new_events) AS BIGINT) AS listing_input_rows,
        CAST((SELECT count(*) FROM sale_events WHERE place = 1) AS BIGINT) AS closed_sale_events,
        CAST((SELECT count(*) FROM new_events WHERE place = 1) AS BIGINT) AS new_listing_events,
        CAST((SELECT count(*) FROM sale_events WHERE place > 1) AS BIGINT) AS sold_exact_duplicates_removed,
        CAST((SELECT count(*) FROM new_events WHERE place > 1) AS BIGINT)
          AS listing_exact_duplicates_removed,
        CAST((SELECT count(*) FROM sales) AS BIGINT) AS competitive_sales_rows,
        CAST((SELECT count(*) FROM events_kept WHERE "{RATIO}OutlierFlag") AS BIGINT) AS ratio_outlier_rows,
        CAST((SELECT count(*) FROM events_kept WHERE "{RATIO}Eligible") AS BIGINT) AS ratio_eligible_rows,
        CAST((SELECT count(*) FROM events_kept) AS BIGINT) AS market_event_rows,
        CAST((SELECT count(*) FROM summary) AS BIGINT) AS calendar_months,
        (SELECT min("YrMo") FROM summary) AS first_month, (SELECT max("YrMo") FROM summary) AS latest_month,
        (SELECT round(lower_bound, 6) FROM ratio_bounds) AS ratio_iqr_lower_bound,
        (SELECT round(upper_bound, 6) FROM ratio_bounds) AS ratio_iqr_upper_bound,
        coalesce((SELECT string_agg("YrMo", ';' ORDER BY "YrMo") FROM summary_flags
          WHERE "NewListingsLowVolumeFlag"), '') AS low_new_listing_months,
        coalesce((SELECT string_agg("YrMo", ';' ORDER BY "YrMo") FROM summary_flags
          WHERE "ClosedSalesLowVolumeFlag"), '') AS low_closed_sales_months""",
    ),
    "gate_category": _over(
        "both",
        " UNION ALL ".join(
            _check(
                f"{dataset} rows of another PropertyType",
                f"""SELECT count(*) FROM {source} WHERE "PropertyType" <> 'Residential'""",
                "0",
            )
            + " UNION ALL "
            + _check(
                f"{dataset} has a Residential row",
                f"""SELECT CAST(count(*) > 0 AS BIGINT) FROM {source} WHERE "PropertyType" = 'Residential'""",
                "1",
            )
            for dataset, source in {"sold": "sold", "listings": "res_listings"}.items()
        ),
    ),
    "gate_clean": _over(
        "clean",
        " UNION ALL ".join(
            _check(
                f"{dataset} rows breaking a rule",
                f"SELECT count(*) FROM {source} WHERE {_removes(flags)}",
                "0",
            )
            for dataset, source, flags in [
                ("sold", "(SELECT * EXCLUDE (" + ", ".join(SOLD_FLAGS) + ") FROM clean_sold)", SOLD_FLAGS),
                (
                    "listings",
                    "(SELECT * EXCLUDE (" + ", ".join(LISTING_FLAGS) + ") FROM clean_listings)",
                    LISTING_FLAGS,
                ),
            ]
        ),
    ),
    "gate_event_date": _over(
        "both",
        " UNION ALL ".join(
            _check(
                f"{dataset} rows without {date}",
                f'SELECT count(*) FROM {source} WHERE "{date}" IS NULL',
                "0",
            )
            for dataset, source, date in [
                ("listings", "res_listings", "ListingContractDate"),
                ("sold", "res_sold", "CloseDate"),
            ]
        ),
    ),
    "reconciliation": _over(
        "flagged",
        " UNION ALL ".join(
            [
                _check(
                    "sold combined rows equal the files'' rows",
                    "SELECT count(*) FROM sold",
                    f'SELECT sum(rows_read) FROM ({_manifest("sold", "sold")})',
                ),
                _check(
                    "flagged rows equal engineered rows",
                    "SELECT count(*) FROM flagged",
                    "SELECT count(*) FROM engineered",
                ),
                _check(
                    "filtered rows equal the summary",
                    "SELECT count(*) FROM kept",
                    "SELECT count(*) FROM flagged WHERE NOT analysis_exclude_flag",
                ),
                _check(
                    "market sales equal competitive sales",
                    f"SELECT count(*) FROM (SELECT 1 FROM kept QUALIFY row_number() OVER "
                    f"(PARTITION BY {SALE_ID} ORDER BY {TIES}) = 1)",
                    # a missing identity is one identity, so it counts once
                    f"SELECT count(*) FROM (SELECT DISTINCT {SALE_ID} FROM kept)",
                ),
            ]
        ),
    ),
    "stream_ingest": _over(
        "sold", 'SELECT "PropertyType", "ListingKey", "SourceMonth", "SourceFile" FROM res_sold'
    ),
    "stream_dedupe": _over("sold", f'SELECT DISTINCT {SALE_ID} AS "EventId" FROM res_sold'),
    "stream_flags": _over(
        "sold",
        """SELECT "ListingKey", price_out OR area_out OR days_out AS any_outlier_flag,
        price_out OR area_out OR days_out OR invalid AS analysis_exclude_flag FROM marked""",
        f"bounds AS MATERIALIZED ({_bounds(FIELDS, 'res_sold')})",
        f"""marked AS (
          SELECT "ListingKey", {_beyond("ClosePrice")} AS price_out, {_beyond("LivingArea")} AS area_out,
            {_beyond("DaysOnMarket")} AS days_out,
            coalesce("ClosePrice" <= 0, false) OR coalesce("LivingArea" <= 0, false)
              OR coalesce("DaysOnMarket" < 0, false) AS invalid
          FROM res_sold)""",
    ),
    "stream_monthly_summary": _over(
        "sold",
        f"""SELECT "YrMo", "NewListings", "ClosedSales", {_round("AverageDaysOnMarket",
          "AverageCloseToOriginalListRatio", "MedianClosePrice")},
          "NewListings" < (SELECT quantile_cont("NewListings", 0.5) FROM totals) * 0.5
            AS "NewListingsLowVolumeFlag",
          "ClosedSales" < (SELECT quantile_cont("ClosedSales", 0.5) FROM totals) * 0.5
            AS "ClosedSalesLowVolumeFlag" FROM totals""",
        """totals AS (
          SELECT strftime("CloseDate", '%Y-%m') AS "YrMo", CAST(0 AS BIGINT) AS "NewListings",
            CAST(count(*) AS BIGINT) AS "ClosedSales", avg("DaysOnMarket") AS "AverageDaysOnMarket",
            avg(CASE WHEN "OriginalListPrice" > 0 THEN "ClosePrice" / "OriginalListPrice" END)
              AS "AverageCloseToOriginalListRatio",
            quantile_cont("ClosePrice", 0.5) AS "MedianClosePrice"
          FROM res_sold GROUP BY 1)""",
    ),
}

ORACLE["stream_first_events"] = ORACLE["event_dedupe"]
ORACLE["indexed_quartiles"] = _over(
    "sold",
    " UNION ALL ".join(
        f"""SELECT '{field}' AS field, CAST(count("{field}") AS BIGINT) AS n, round(quantile_cont("{field}", 0.25), 6) AS q1,
        round(quantile_cont("{field}", 0.5), 6) AS median, round(quantile_cont("{field}", 0.75), 6) AS q3 FROM res_sold"""
        for field in FIELDS
    ),
)
ORACLE["stream_state_summary"] = ORACLE["stream_monthly_summary"]


def _flagged_by(bounds: str, rows: str) -> str:
    out = " OR ".join(_beyond(field, bounds) for field in FIELDS)
    return f"""SELECT "ListingKey", {out} AS any_outlier_flag, {out} OR coalesce("ClosePrice" <= 0, false)
      OR coalesce("LivingArea" <= 0, false) OR coalesce("DaysOnMarket" < 0, false) AS analysis_exclude_flag FROM {rows}"""


ORACLE["stream_refreshed_flags"] = _over(
    "sold",
    f"{_flagged_by('early_bounds', 'early')} UNION ALL {_flagged_by('bounds', 'late')}",
    """early AS (SELECT * FROM res_sold WHERE "SourceMonth" < '202407')""",
    """late AS (SELECT * FROM res_sold WHERE NOT coalesce("SourceMonth" < '202407', false))""",
    f"early_bounds AS MATERIALIZED ({_bounds(FIELDS, 'early')})",
    f"bounds AS MATERIALIZED ({_bounds(FIELDS, 'res_sold')})",
)

_MEASURED = {
    "measure_median_close_price": ('quantile_cont("ClosePrice", 0.5)', True),
    "measure_average_days_on_market": ('avg("DaysOnMarket")', True),
    "measure_average_ratio": (f'avg("{RATIO}")', True),
    "measure_new_listings": ('CAST(sum("NewListings") AS DOUBLE)', False),
    "measure_closed_sales": ('CAST(sum("ClosedSales") AS DOUBLE)', False),
}
_BRANDS = """"City" IN ('Brand#1', 'Brand#2', 'Brand#3')"""
ORACLE["slicer_lattice"] = _over(
    "events",
    " UNION ALL ".join(
        f"""SELECT '{label}' AS choice, '{name}' AS measure, CAST(date_trunc('month', "EventDate") AS DATE) AS "EventMonth",
        round({expression}, 6) AS "value" FROM events_kept
        WHERE {where} AND {"\"EventType\" = 'Closed Sale'" if closed else "true"} GROUP BY 3"""
        for label, where in {
            "all": "true",
            "city": _BRANDS,
            "city and kind": f"""{_BRANDS} AND "PropertySubType" IN ('ECONOMY', 'SMALL')""",
        }.items()
        for name, (expression, closed) in _MEASURED.items()
    ),
)
