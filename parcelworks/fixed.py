"""Column lists, labels and thresholds the operators use by default.

Every operator takes these as parameters; nothing else in the package repeats them.
"""

# ---- fixed values: names, labels, patterns and thresholds that decide the results ----

CATEGORY_COLUMN = "PropertyType"
CATEGORY = "Residential"
MISSING_LABEL = "<missing>"

MONTH_PATTERN = r"(20\d{4})"
FILLED_MARK = "_filled"
FIRST_MONTH = "202401"

NUMERIC_DUPLICATE_COLUMNS = [
    "DaysOnMarket",
    "Latitude",
    "ListPrice",
    "LivingArea",
    "Longitude",
]

PROFILE_COLUMNS = [
    "ClosePrice",
    "ListPrice",
    "OriginalListPrice",
    "LivingArea",
    "LotSizeAcres",
    "BedroomsTotal",
    "BathroomsTotalInteger",
    "DaysOnMarket",
    "YearBuilt",
]
PROFILE_PERCENTILES = {
    "1%": 0.01,
    "5%": 0.05,
    "25%": 0.25,
    "median": 0.50,
    "75%": 0.75,
    "95%": 0.95,
    "99%": 0.99,
}
HIGH_MISSING_PERCENT = 90
DISPLAY_RANGE = (0.01, 0.99)
HISTOGRAM_BINS = 50

RATE_DATE_COLUMN = "observation_date"
RATE_VALUE_COLUMN = "MORTGAGE30US"
RATE_COLUMN = "rate_30yr_fixed"
FIRST_RATE_MONTH = "2024-01"

SOLD_DATE_COLUMNS = [
    "CloseDate",
    "PurchaseContractDate",
    "ListingContractDate",
    "ContractStatusChangeDate",
]
LISTING_DATE_COLUMNS = [
    "ListingContractDate",
    "ContractStatusChangeDate",
]
SOLD_NUMERIC_COLUMNS = [
    "ClosePrice",
    "ListPrice",
    "OriginalListPrice",
    "LivingArea",
    "DaysOnMarket",
    "BedroomsTotal",
    "BathroomsTotalInteger",
    "Latitude",
    "Longitude",
    "rate_30yr_fixed",
]
LISTING_NUMERIC_COLUMNS = [
    "ListPrice",
    "OriginalListPrice",
    "LivingArea",
    "DaysOnMarket",
    "BedroomsTotal",
    "BathroomsTotalInteger",
    "Latitude",
    "Longitude",
    "rate_30yr_fixed",
]
REQUIRED_SOLD_COLUMNS = [
    "CloseDate",
    "PurchaseContractDate",
    "ListingContractDate",
    "ContractStatusChangeDate",
    "ClosePrice",
    "LivingArea",
    "DaysOnMarket",
    "BedroomsTotal",
    "BathroomsTotalInteger",
    "Latitude",
    "Longitude",
]
REQUIRED_LISTING_COLUMNS = [
    "ListingContractDate",
    "ContractStatusChangeDate",
    "ListPrice",
    "LivingArea",
    "DaysOnMarket",
    "BedroomsTotal",
    "BathroomsTotalInteger",
    "Latitude",
    "Longitude",
]

LATITUDE_RANGE = (32.0, 42.5)
LONGITUDE_RANGE = (-125.0, -114.0)

IQR_MULTIPLIER = 1.5
OUTLIER_FIELDS = ["ClosePrice", "LivingArea", "DaysOnMarket"]
RATIO_COLUMN = "CloseToOriginalListRatio"
SAMPLE_ROWS = 20
SAMPLE_COLUMNS = [
    "ListingKey",
    "CloseDate",
    "ClosePrice",
    "OriginalListPrice",
    "LivingArea",
    "PriceRatio",
    "CloseToOriginalListRatio",
    "PricePerSqFt",
    "DaysOnMarket",
    "Year",
    "Month",
    "YrMo",
    "ListingToContractDays",
    "ContractToCloseDays",
    "CountyOrParish",
]

DIMENSION_COLUMNS = [
    "PropertyType",
    "PropertySubType",
    "City",
    "CountyOrParish",
    "PostalCode",
    "MLSAreaMajor",
    "StateOrProvince",
]
SLICER_COLUMNS = ["City", "CountyOrParish", "PostalCode", "PropertySubType"]
EVENT_SCHEMA = {
    "EventId": "string",
    "EventType": "string",
    "EventDate": "date",
    "Year": "integer",
    "Month": "integer",
    "YrMo": "string",
    "ListingKey": "string",
    "PropertyType": "string",
    "PropertySubType": "string",
    "City": "string",
    "CountyOrParish": "string",
    "PostalCode": "string",
    "MLSAreaMajor": "string",
    "StateOrProvince": "string",
    "ListPrice": "real",
    "OriginalListPrice": "real",
    "ClosePrice": "real",
    "LivingArea": "real",
    "DaysOnMarket": "integer",
    "CloseToOriginalListRatio": "real",
    "CloseToOriginalListRatioOutlierFlag": "boolean",
    "CloseToOriginalListRatioEligible": "boolean",
    "PricePerSqFt": "real",
    "rate_30yr_fixed": "real",
    "NewListings": "integer",
    "ClosedSales": "integer",
    "RecordCount": "integer",
    "SourceDataset": "string",
}
DIRECT_IDENTIFIERS = ["EventId", "ListingKey"]
SALE_COLUMNS = [
    "EventId",
    "CloseDate",
    "Year",
    "Month",
    "YrMo",
    "ListingKey",
    "ListAgentFullName",
    "ListOfficeName",
    "BuyerOfficeName",
    *DIMENSION_COLUMNS,
    "ClosePrice",
    "SalesVolume",
    "UnitsSold",
    "DaysOnMarket",
    "CloseToOriginalListRatio",
    "CloseToOriginalListRatioOutlierFlag",
    "CloseToOriginalListRatioEligible",
    "PricePerSqFt",
    "rate_30yr_fixed",
]
CLOSED_SALE = "Closed Sale"
NEW_LISTING = "New Listing"
SOLD_SOURCE = "Week 7 clean filtered sold"
LISTING_SOURCE = "Weeks 4-5 clean listings"
EVENT_ID_SEPARATOR = "|"

LOW_VOLUME_SHARE = 0.5
TOP_SELLERS = 100
SLICERS = ["City", "CountyOrParish", "PostalCode", "PropertySubType"]

# text that a CSV reader following the pandas documentation takes as missing
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# characters Python's str.strip removes
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

NUMBER_PATTERN = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"
DATE_FORMATS = ("yyyy-M-d",)
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
INTEGER_PATTERN = r"^[+-]?\d+$"
