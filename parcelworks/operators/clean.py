"""Rule flags on every row and removal of the rows that break a removing rule."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from parcelworks import fixed
from parcelworks.functions.logic import any_of, holds, literal, percent, rows_of, with_exprs
from parcelworks.operators.checks import no_rule_broken


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate; rows where it holds are flagged and, if it ``removes``, removed."""

    flag: str
    predicate: str
    removes: bool = True

    @property
    def holds(self) -> str:
        return holds(self.predicate)


def numeric_rules(price: str, label: str) -> list[Rule]:
    """Missing core values (kept) and impossible numbers (removed)."""
    return [
        Rule(f"missing_{label}_flag", f"{price} IS NULL", removes=False),
        Rule("missing_living_area_flag", "LivingArea IS NULL", removes=False),
        Rule(f"invalid_{label}_flag", f"{price} <= 0"),
        Rule("invalid_living_area_flag", "LivingArea <= 0"),
        Rule("negative_days_on_market_flag", "DaysOnMarket < 0"),
        Rule("negative_bedrooms_flag", "BedroomsTotal < 0"),
        Rule("negative_bathrooms_flag", "BathroomsTotalInteger < 0"),
    ]


def date_rules() -> list[Rule]:
    """Dates in the wrong order; equal dates and missing dates pass."""
    return [
        Rule("listing_after_close_flag", "ListingContractDate > CloseDate"),
        Rule("purchase_after_close_flag", "PurchaseContractDate > CloseDate"),
        Rule("negative_timeline_flag", "ListingContractDate > PurchaseContractDate"),
    ]


def geographic_rules(
    latitudes: tuple[float, float] = fixed.LATITUDE_RANGE,
    longitudes: tuple[float, float] = fixed.LONGITUDE_RANGE,
) -> list[Rule]:
    """Impossible coordinates, and coordinates outside a box whose edges count as inside."""
    (south, north), (west, east) = latitudes, longitudes
    in_box = f"Latitude BETWEEN {south}D AND {north}D AND Longitude BETWEEN {west}D AND {east}D"
    both = "Latitude IS NOT NULL AND Longitude IS NOT NULL"
    return [
        Rule("missing_coordinate_flag", f"NOT ({both})", removes=False),
        Rule("zero_coordinate_flag", f"{holds('Latitude = 0')} OR {holds('Longitude = 0')}"),
        Rule("positive_longitude_flag", "Longitude > 0"),
        Rule("invalid_latitude_range_flag", "Latitude NOT BETWEEN -90 AND 90"),
        Rule("invalid_longitude_range_flag", "Longitude NOT BETWEEN -180 AND 180"),
        Rule("out_of_california_flag", f"{both} AND NOT ({in_box})"),
    ]


def sold_rules(latitudes=fixed.LATITUDE_RANGE, longitudes=fixed.LONGITUDE_RANGE) -> list[Rule]:
    return [*numeric_rules("ClosePrice", "close_price"), *date_rules(), *geographic_rules(latitudes, longitudes)]


def listing_rules(latitudes=fixed.LATITUDE_RANGE, longitudes=fixed.LONGITUDE_RANGE) -> list[Rule]:
    return [*numeric_rules("ListPrice", "list_price"), *geographic_rules(latitudes, longitudes)]


def with_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A never-null boolean column per rule."""
    return with_exprs(df, {rule.flag: rule.holds for rule in rules})


def breaks_rules(rules: Sequence[Rule]) -> str:
    return any_of(rule.holds for rule in rules if rule.removes)


def clean_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Flagged rows without those that break a removing rule."""
    return with_flags(df.filter(f"NOT ({breaks_rules(rules)})"), rules)


def flag_counts(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """Flagged rows per rule, all rules in one pass."""
    counts = df.selectExpr(*[f"count_if({rule.predicate}) AS {rule.flag}" for rule in rules])
    rows = [(literal(dataset), literal(rule.flag), rule.flag) for rule in rules]
    return rows_of(counts, rows, ["dataset", "flag", "flagged_rows"])


def cleaning_summary(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """Rows before, removed and after, with the percent removed."""
    totals = df.selectExpr("count(*) AS rows_before", f"count_if({breaks_rules(rules)}) AS rows_removed")
    return totals.selectExpr(
        f"{literal(dataset)} AS dataset",
        "rows_before",
        "rows_removed",
        "rows_before - rows_removed AS rows_after",
        f"{percent('rows_removed', 'rows_before', 4)} AS percent_removed",
    )


def removing(rules: Sequence[Rule]) -> list[str]:
    """The flags of the removing rules."""
    return [rule.flag for rule in rules if rule.removes]


def stays_clean(cleaned: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """Check that no removing rule is broken any more."""
    return no_rule_broken(cleaned, dataset, [rule.holds for rule in rules if rule.removes])
