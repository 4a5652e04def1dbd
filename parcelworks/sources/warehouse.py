"""Domain-shaped inputs derived from the star-schema tables of a warehouse folder.

``sold`` has one row per order line, ``listings`` one per order. Dimensions are looked up with
left joins on their keys, so every line is kept, and only the lookups the requested columns need
are joined. Join strategies are left to Spark, which knows the table sizes.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks.functions.logic import quoted


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _file_month(date: str) -> str:
    """``yyyyMM`` of a date 29 years on, so that months read like those of recent files."""
    return f"date_format(add_months({date}, 348), 'yyyyMM')"


CATEGORY = "CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Land' ELSE 'Residential' END"
COUNTY = "CASE WHEN o_custkey % 37 <> 0 THEN customer_nation END"
POSTAL_CODE = (
    "concat(lpad(string(o_custkey % 100000), 5, '0'), CASE WHEN o_custkey % 5 = 0 THEN '.0' ELSE '' END)"
)


def _latitude(key: str) -> str:
    return f"CASE WHEN {key} % 19 = 0 THEN NULL WHEN {key} % 23 = 0 THEN 0D ELSE 33D + ({key} % 90) / 10D END"


def _longitude(key: str) -> str:
    return f"CASE WHEN {key} % 29 = 0 THEN 118D WHEN {key} % 31 = 0 THEN -200D ELSE -124D + ({key} % 90) / 10D END"


LISTED = "date(o_orderdate)"
CONTRACTED = (
    f"CASE WHEN l_partkey % 97 <> 0 THEN date_add({LISTED}, "
    "int(l_quantity) - CASE WHEN l_partkey % 89 = 0 THEN 60 ELSE 0 END) END"
)
CLOSED = (
    "CASE WHEN l_partkey % 83 = 0 THEN date(l_shipdate) "
    f"ELSE date_add({LISTED}, int(l_quantity + 10 + l_partkey % 40)) END"
)
PRICE_TEXT = """CASE
    WHEN l_partkey % 13 = 0 THEN NULL
    WHEN l_partkey % 17 = 0 THEN concat('1,', bigint(l_extendedprice))
    WHEN l_partkey % 19 = 0 THEN concat(' \\t', bigint(l_extendedprice), ' ')
    WHEN l_partkey % 23 = 0 THEN concat(bigint(l_extendedprice), 'd')
    WHEN l_partkey % 29 = 0 THEN 'NaN'
    WHEN l_partkey % 31 = 0 THEN concat(bigint(l_extendedprice), 'e1')
    WHEN l_partkey % 37 = 0 THEN '0x1F'
    ELSE string(bigint(l_extendedprice)) END"""
DATE_TEXT = """CASE
    WHEN l_partkey % 13 = 0 THEN NULL
    WHEN l_partkey % 17 = 0 THEN date_format(closed, 'MM/dd/yyyy')
    WHEN l_partkey % 19 = 0 THEN date_format(closed, 'yyyy-M-d')
    WHEN l_partkey % 23 = 0 THEN date_format(closed, 'yyyy')
    WHEN l_partkey % 29 = 0 THEN '2001-02-30'
    ELSE date_format(closed, 'yyyy-MM-dd') END"""

# column: (expression, lookups it needs)
SOLD_COLUMNS = {
    "ListingKey": ("CASE WHEN l_partkey % 211 <> 0 THEN concat(l_orderkey, '-', l_linenumber) END", ""),
    "PropertyType": (CATEGORY, "orders customer"),
    "PropertySubType": ("p_type", "part"),
    "City": ("p_brand", "part"),
    "CountyOrParish": (COUNTY, "orders customer customer_nation"),
    "MLSAreaMajor": ("r_name", "orders customer customer_nation region"),
    "StateOrProvince": ("'CA'", ""),
    "PostalCode": (POSTAL_CODE, "orders"),
    "ListingContractDate": (LISTED, "orders"),
    "PurchaseContractDate": ("contracted", "orders"),
    "CloseDate": ("closed", "orders"),
    "ContractStatusChangeDate": ("closed", "orders"),
    "ClosePrice": (
        "CASE WHEN l_partkey % 71 = 0 THEN NULL WHEN l_partkey % 73 = 0 THEN 0D "
        "ELSE l_extendedprice * (1 - l_discount + l_tax) * CASE WHEN l_partkey % 47 = 0 THEN 12 ELSE 1 END END",
        "",
    ),
    "ListPrice": ("l_extendedprice", ""),
    "OriginalListPrice": (
        "CASE WHEN l_partkey % 61 = 0 THEN 0D WHEN l_partkey % 51 = 0 THEN l_extendedprice / 4 "
        "ELSE l_extendedprice END",
        "",
    ),
    "LivingArea": (
        "double(CASE WHEN l_partkey % 67 = 0 THEN NULL WHEN l_partkey % 79 = 0 THEN -p_size "
        "WHEN l_partkey % 53 = 0 THEN p_size * 6000 ELSE p_size * 100 END)",
        "part",
    ),
    "DaysOnMarket": (
        "CASE WHEN l_partkey % 59 = 0 THEN -l_quantity WHEN l_partkey % 43 = 0 THEN l_quantity * 20 "
        "ELSE l_quantity END",
        "",
    ),
    "BedroomsTotal": ("double(CASE WHEN l_partkey % 101 = 0 THEN -1 ELSE p_size % 6 END)", "part"),
    "BathroomsTotalInteger": ("double(CASE WHEN l_partkey % 103 = 0 THEN -1 ELSE p_size % 4 END)", "part"),
    "Latitude": (_latitude("l_suppkey"), ""),
    "Longitude": (_longitude("l_suppkey"), ""),
    "LotSizeAcres": ("CASE WHEN l_partkey % 20 = 0 THEN l_quantity / 8 END", ""),
    "YearBuilt": ("double(1950 + l_suppkey % 70)", ""),
    "ListAgentFullName": (
        "CASE WHEN l_partkey % 71 = 0 THEN 'Seller without prices' WHEN l_suppkey % 7 = 0 THEN NULL "
        "WHEN l_suppkey % 11 = 0 THEN '  ' ELSE concat(s_name, ' ', l_partkey % 4) END",
        "supplier",
    ),
    "ListAgentFirstName": ("'Agent'", ""),
    "ListAgentLastName": ("string(l_suppkey)", ""),
    "ListOfficeName": ("supplier_nation", "supplier supplier_nation"),
    "BuyerOfficeName": ("customer_nation", "orders customer customer_nation"),
    "SourceMonth": (_file_month("closed"), "orders"),
    "SourceFile": (f"concat('Sold', {_file_month('closed')}, '.csv')", "orders"),
    # tie-breakers for rows that share an event identity
    "l_partkey": ("l_partkey", ""),
    "l_suppkey": ("l_suppkey", ""),
    "l_quantity": ("l_quantity", ""),
    "l_extendedprice": ("l_extendedprice", ""),
    "l_discount": ("l_discount", ""),
    "l_tax": ("l_tax", ""),
    "o_orderkey": ("l_orderkey", ""),
    # text as a monthly file would carry it, with the faults a lenient cast meets
    "ClosePriceText": (PRICE_TEXT, ""),
    "CloseDateText": (DATE_TEXT, "orders"),
}
SOLD_TIE_BREAKERS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_orderkey"]

LISTING_COLUMNS = {
    # some orders list the same home again, some have no key
    "ListingKey": (
        "CASE WHEN o_orderkey % 199 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 'home' "
        "ELSE string(o_orderkey) END",
        "",
    ),
    "PropertyType": (CATEGORY, "customer"),
    "PropertySubType": ("o_orderpriority", ""),
    "City": ("concat('City ', o_custkey % 50)", ""),
    "CountyOrParish": (COUNTY, "customer customer_nation"),
    "MLSAreaMajor": ("r_name", "customer customer_nation region"),
    "StateOrProvince": ("'CA'", ""),
    "PostalCode": (POSTAL_CODE, ""),
    "ListingContractDate": (f"CASE WHEN o_orderkey % 107 <> 0 THEN {LISTED} END", ""),
    "ContractStatusChangeDate": (f"date_add({LISTED}, int(o_orderkey % 30))", ""),
    "ListPrice": (
        "CASE WHEN o_orderkey % 71 = 0 THEN NULL WHEN o_orderkey % 73 = 0 THEN 0D ELSE o_totalprice END",
        "",
    ),
    "OriginalListPrice": ("CASE WHEN o_orderkey % 61 = 0 THEN 0D ELSE o_totalprice END", ""),
    "LivingArea": (
        "double(CASE WHEN o_orderkey % 67 = 0 THEN NULL WHEN o_orderkey % 79 = 0 THEN -1 "
        "ELSE (o_orderkey % 50 + 1) * 100 END)",
        "",
    ),
    "DaysOnMarket": (
        "double(CASE WHEN o_orderkey % 59 = 0 THEN -(o_orderkey % 120) ELSE o_orderkey % 120 END)",
        "",
    ),
    "BedroomsTotal": ("double(CASE WHEN o_orderkey % 101 = 0 THEN -1 ELSE o_orderkey % 6 END)", ""),
    "BathroomsTotalInteger": ("double(CASE WHEN o_orderkey % 103 = 0 THEN -1 ELSE o_orderkey % 4 END)", ""),
    "Latitude": (_latitude("o_custkey"), ""),
    "Longitude": (_longitude("o_custkey"), ""),
    "LotSizeAcres": ("CASE WHEN o_orderkey % 20 = 0 THEN (o_custkey % 80) / 8D END", ""),
    "YearBuilt": ("double(1950 + o_orderkey % 70)", ""),
    "SourceMonth": (_file_month(LISTED), ""),
    "SourceFile": (f"concat('Listing', {_file_month(LISTED)}, '.csv')", ""),
    "o_orderkey": ("o_orderkey", ""),
    # headers repeated in the file: a price and a city as text, and copies with typical faults
    "ListPriceText": ("CASE WHEN o_orderkey % 19 <> 0 THEN string(bigint(o_totalprice)) END", ""),
    "ListPriceText.1": (
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 "
        "THEN string(bigint(o_totalprice) + 1) ELSE concat(bigint(o_totalprice), '.00') END",
        "",
    ),
    "ListPriceText.2": ("CASE WHEN o_orderkey % 11 = 0 THEN concat(' ', bigint(o_totalprice)) END", ""),
    "CityText": ("CASE WHEN o_orderkey % 23 <> 0 THEN concat('City ', o_orderkey % 50) END", ""),
    "CityText.1": (
        "CASE WHEN o_orderkey % 29 = 0 THEN 'elsewhere' WHEN o_orderkey % 31 = 0 THEN NULL "
        "ELSE concat('City ', o_orderkey % 50, ' ') END",
        "",
    ),
}


def _lookup(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, str]:
    """A dimension and the condition that joins it."""
    side, _, kind = name.partition("_")
    if kind == "nation":
        nations = table(spark, folder, "nation").selectExpr(
            f"n_nationkey AS {side}_nationkey", f"n_regionkey AS {side}_regionkey", f"n_name AS {side}_nation"
        )
        return nations, f"{side[0]}_nationkey = {side}_nationkey"
    on = {
        "orders": "l_orderkey = o_orderkey",
        "customer": "o_custkey = c_custkey",
        "part": "l_partkey = p_partkey",
        "supplier": "l_suppkey = s_suppkey",
        "region": "customer_regionkey = r_regionkey",
    }
    return table(spark, folder, name), on[name]


LOOKUP_ORDER = ["orders", "customer", "part", "supplier", "customer_nation", "supplier_nation", "region"]


def _shaped(base: DataFrame, folder: str, columns, wanted) -> DataFrame:
    names = wanted or list(columns)
    needed = {lookup for name in names for lookup in columns[name][1].split()}
    for name in LOOKUP_ORDER:
        if name in needed:
            other, condition = _lookup(base.sparkSession, folder, name)
            base = base.join(other, F.expr(condition), "left")
        if name == "orders" and name in needed:
            # used by several columns, so computed once below them
            base = base.selectExpr("*", f"{CLOSED} AS closed", f"{CONTRACTED} AS contracted")
    return base.selectExpr(*[f"{columns[name][0]} AS {quoted(name)}" for name in names])


def sold(spark: SparkSession, folder: str, *wanted: str) -> DataFrame:
    """Sold records; only the named columns, or all of them."""
    return _shaped(table(spark, folder, "lineitem"), folder, SOLD_COLUMNS, wanted)


def sold_from(lines: DataFrame, folder: str, *wanted: str) -> DataFrame:
    """``sold`` over other order lines, such as a stream of them."""
    return _shaped(lines, folder, SOLD_COLUMNS, wanted)


def listings(spark: SparkSession, folder: str, *wanted: str) -> DataFrame:
    """Listing records; only the named columns, or all of them."""
    return _shaped(table(spark, folder, "orders"), folder, LISTING_COLUMNS, wanted)


def weekly_rates(spark: SparkSession, folder: str) -> DataFrame:
    """A weekly rate series: the mean order total of each week, scaled."""
    weeks = table(spark, folder, "orders").selectExpr(
        "date(date_trunc('week', o_orderdate)) AS observation_date", "o_totalprice"
    )
    means = weeks.groupBy("observation_date").avg("o_totalprice")
    return means.selectExpr("observation_date", "`avg(o_totalprice)` / 20000 AS MORTGAGE30US")


def file_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly file names, from the month (29 years on) of each customer's last order.

    Even customers stand for filled files. Months in which no customer ordered last have no file.
    """
    last = table(spark, folder, "orders").groupBy("o_custkey").agg(F.expr(f"max({LISTED}) AS last"))
    months = last.selectExpr(f"{_file_month('last')} AS month", "o_custkey % 2 = 0 AS filled").distinct()
    return months.selectExpr("concat('/data/Sold', month, CASE WHEN filled THEN '_filled' ELSE '' END, '.csv') AS path")
