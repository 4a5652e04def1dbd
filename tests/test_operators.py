"""Hand-written edge rows per operator."""

import datetime as dt
import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from parcelworks import fixed
from parcelworks.functions import casts, logic
from parcelworks.operators import checks, clean, combine, duplicates, enrich, events, market, outliers, profile
from parcelworks.operators import quantiles as quantile_operators
from parcelworks.operators.quantiles import every_group_median, long_values, quantiles
from parcelworks.plans import stages
from parcelworks.sources import manifest, sinks

D = dt.date


def one(df, expression):
    return [row[0] for row in df.selectExpr(expression).collect()]


def test_numeric_cast(spark):
    texts = ["1,200", " 12 ", "1e3", "12d", "0x1F", "NaN", "inf", ".5", "7.", "1_000", "", None, "\t3 "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    expected = [None, 12.0, 1000.0, None, None, None, math.inf, 0.5, 7.0, None, None, None, 3.0]
    assert one(df, casts.parse_number("t")) == expected


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert one(df, casts.number_of(df, "x")) == [None, 1.0]


def test_date_cast(spark):
    texts = ["2024-01-05", "2024-1-6", "2024-02-30", "01/07/2024", "2024", "2024-01-05 10:00:00", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert one(df, casts.parse_date("t")) == [D(2024, 1, 5), D(2024, 1, 6), *[None] * 5]


def test_text_cleaning(spark):
    df = spark.createDataFrame([("  ",), ("\t a\n",), ("x",), (None,), ("　y ",)], "t string")
    assert one(df, casts.clean_text("t")) == [None, "a", "x", None, "y"]


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("", "integer", None),
        (" 18 ", "integer", 18),
        ("2024-01-05", "date", D(2024, 1, 5)),
        ("TRUE ", "boolean", True),
        ("1e3", "real", 1000.0),
        ("a", "string", "a"),
    ],
)
def test_strict_cast(spark, text, kind, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert one(df, casts.strict("t", kind)) == [value]


@pytest.mark.parametrize(
    "text, kind", [("18.0", "integer"), ("yes", "boolean"), ("2024", "date"), ("2024-02-30", "date"), ("x", "real")]
)
def test_strict_cast_fails(spark, text, kind):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match=f"not a valid {kind}"):
        df.selectExpr(casts.strict("t", kind)).collect()


def test_elapsed_days_round_down(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 23:00:00' AS a, timestamp_ntz'2024-01-02 01:00:00' AS b, "
        "date'2024-01-03' AS c, date'2024-01-01' AS d"
    )
    assert one(df, casts.elapsed_days(df, "a", "b")) == [0]
    assert one(df, casts.elapsed_days(df, "b", "a")) == [-1]
    assert one(df, casts.elapsed_days(df, "c", "d")) == [-2]


def test_percent_rounds_half_even(spark):
    df = spark.sql("SELECT 1 AS part, 800 AS whole")
    assert one(df, logic.percent("part", "whole", 2)) == [0.12]


def test_coercion_audit(spark):
    df = spark.createDataFrame([("1", "x"), ("a", "y"), (None, "z")], "ClosePrice string, other string")
    rows = casts.coercion_audit(df, "sold", ["ClosePrice", "absent"]).collect()
    assert [tuple(row) for row in rows] == [("sold", "ClosePrice", 1, 2, 1)]


# ---- quantiles ----------------------------------------------------------------------------

SAMPLES = {
    "four": [1.0, 2.0, 3.0, 4.0, None],
    "single": [7.5],
    "equal": [3.0] * 9,
    "signs": [-1e9, -2.5, -0.0, 0.0, 1e-12, 3.25, 1e12],
    "third": [0.0] * 400 + [float(i) * 1.37 for i in range(800)],
    "close": [1.0 + i * 1e-13 for i in range(50)],
    "closest": [1.0 + i * 2.0**-52 for i in range(300)],
    "tiny": [i * 1e-12 for i in range(3000)],
    "epoch": [1.7e9 + i * 1e-3 for i in range(3000)],
    "subnormal": [5e-324 * i for i in range(9)] + [2.3e-308, -1e-310],
    "infinite": [float("-inf"), -1.0, 2.0, 2.0, float("inf")],
    "powers": [2.0**e for e in range(-1074, 1024, 7)] + [-(2.0**e) for e in range(-1022, 1024, 9)],
    "random": np.random.default_rng(3).lognormal(12, 1, 3000).tolist(),
}


@pytest.mark.parametrize("name", list(SAMPLES))
def test_quantiles_match_numpy(spark, name):
    values = SAMPLES[name]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    wanted = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.99, "f": 1.0}
    row = quantiles(long_values(df, ["x"]), wanted).first()
    present = [v for v in values if v is not None]
    assert row.n == len(present)
    ordered = sorted(present)
    for label, p in wanted.items():
        place = p * (len(ordered) - 1)
        low, high = ordered[int(np.floor(place))], ordered[int(np.ceil(place))]
        expected = low if low == high else low + (high - low) * (place - np.floor(place))
        assert row[label] == pytest.approx(expected, rel=1e-15, abs=0, nan_ok=True)


def test_quantiles_match_percentile(spark):
    df = spark.range(5000).selectExpr("id % 7 AS g", "pmod(hash(id), 100000) / 7 AS x", "double(id % 5) AS y")
    found = quantiles(long_values(df, ["x", "y"], ["g"]), {"m": 0.5, "u": 0.9}, ["g"])
    ours = {(r.g, r.field): (r.m, r.u) for r in found.collect()}
    for row in df.groupBy("g").agg(
        *[F.expr(f"percentile({c}, array(0.5, 0.9)) AS {c}") for c in "xy"]
    ).collect():
        for field in "xy":
            assert ours[(row.g, field)] == pytest.approx(row[field], rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b")], "x double, g string")
    assert quantiles(long_values(df, ["x"]), {"m": 0.5}).count() == 0
    medians = every_group_median(df.union(spark.sql("SELECT 4D, string(NULL)")), "x", ["g"], "m")
    assert {row.g: row.m for row in medians.collect()} == {"a": None, "b": None, None: 4.0}


@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=200))
@settings(max_examples=5, deadline=None)
def test_bits_grow_with_the_value(spark, values):
    df = spark.createDataFrame([("x", v, 1) for v in values], "field string, value double, rows long")
    text = quantile_operators._with_bits("{df}", "field")
    for row in spark.sql(text, df=df).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(row.value)))[0]
        assert row.bits == (-bits if row.value < 0 else bits)


def test_no_value_is_shuffled_and_every_step_is_bounded(spark):
    """Values next to each other share all bins but the last, which counts whole values."""
    df = spark.range(20000).selectExpr("id * 1e-12 AS x", "1.7e9 + id / 1000 AS y")
    found = quantiles(long_values(df, ["x", "y"]), {"m": 0.5})
    rows = {row.field: row.m for row in found.collect()}
    assert rows["x"] == pytest.approx(9999.5e-12, rel=1e-12) and rows["y"] == pytest.approx(1.7e9 + 9.9995)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan
    # what is dealt out are partial counts of bins, never rows of the table
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "value" not in line
    assert quantile_operators.SHIFTS[-1] == 0
    hidden = (64, *quantile_operators.SHIFTS)
    assert max(a - b for a, b in zip(hidden, hidden[1:])) <= 22


# ---- cleaning -----------------------------------------------------------------------------

SOLD = "ClosePrice double, LivingArea double, DaysOnMarket double, BedroomsTotal double, BathroomsTotalInteger double"


def flags_of(spark, rules, schema, row):
    flagged = clean.with_flags(spark.createDataFrame([row], schema), rules).first().asDict()
    return {name for name, value in flagged.items() if value is True}


def test_numeric_flags(spark):
    rules = clean.numeric_rules("ClosePrice", "close_price")
    assert flags_of(spark, rules, SOLD, (None, 5.0, 1.0, 1.0, 1.0)) == {"missing_close_price_flag"}
    assert flags_of(spark, rules, SOLD, (0.0, None, -1.0, -1.0, -1.0)) == {
        "invalid_close_price_flag",
        "missing_living_area_flag",
        "negative_days_on_market_flag",
        "negative_bedrooms_flag",
        "negative_bathrooms_flag",
    }


def test_rows_with_missing_values_stay(spark):
    rules = clean.numeric_rules("ClosePrice", "close_price")
    df = spark.createDataFrame([(None,) * 5, (0.0, 1.0, 1.0, 1.0, 1.0), (1.0,) * 5], SOLD)
    assert clean.clean_rows(df, rules).count() == 2
    assert tuple(clean.cleaning_summary(df, "sold", rules).first()) == ("sold", 3, 1, 2, 33.3333)
    assert clean.stays_clean(clean.clean_rows(df, rules), "sold", rules).first().passed
    with pytest.raises(checks.CheckFailed, match="observed 1, expected 0"):
        checks.enforce(clean.stays_clean(df, "sold", rules))


def test_date_flags(spark):
    schema = "ListingContractDate date, PurchaseContractDate date, CloseDate date"
    a, b = D(2024, 1, 1), D(2024, 1, 2)
    assert flags_of(spark, clean.date_rules(), schema, (a, a, a)) == set()
    assert flags_of(spark, clean.date_rules(), schema, (b, None, a)) == {"listing_after_close_flag"}
    assert flags_of(spark, clean.date_rules(), schema, (None, b, a)) == {"purchase_after_close_flag"}
    assert flags_of(spark, clean.date_rules(), schema, (b, a, None)) == {"negative_timeline_flag"}


@pytest.mark.parametrize(
    "place, expected",
    [
        ((32.0, -125.0), set()),
        ((42.5, -114.0), set()),
        ((None, -120.0), {"missing_coordinate_flag"}),
        ((None, 0.0), {"missing_coordinate_flag", "zero_coordinate_flag"}),
        ((0.0, 0.0), {"zero_coordinate_flag", "out_of_california_flag"}),
        ((35.0, 118.0), {"positive_longitude_flag", "out_of_california_flag"}),
        ((91.0, -120.0), {"invalid_latitude_range_flag", "out_of_california_flag"}),
        ((35.0, -181.0), {"invalid_longitude_range_flag", "out_of_california_flag"}),
    ],
)
def test_geographic_flags(spark, place, expected):
    assert flags_of(spark, clean.geographic_rules(), "Latitude double, Longitude double", place) == expected


# ---- metrics and outliers -----------------------------------------------------------------


def test_ratio_needs_positive_divisor(spark):
    df = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (6.0, -1.0), (6.0, None), (None, 2.0)], "a double, b double")
    assert one(df, logic.guarded_ratio("a", "b")) == [2.0, None, None, None, None]


def test_value_on_a_bound_is_no_outlier(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.1,), (None,)], "ClosePrice double").selectExpr(
        "*", "1D AS LivingArea", "1D AS DaysOnMarket"
    )
    flagged = outliers.with_outlier_flags(df, {"ClosePrice": (1.0, 2.0)})
    assert one(flagged, "ClosePrice_outlier_flag") == [False, False, True, False]
    assert outliers.filtered(flagged).count() == 3


def test_bounds_of_empty_field_flag_nothing(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0)], "ClosePrice double, LivingArea double, DaysOnMarket double")
    bounds = outliers.as_bounds(outliers.bounds_table(df))
    assert bounds["ClosePrice"] == (None, None) and bounds["LivingArea"] == (1.0, 1.0)
    assert outliers.filtered(outliers.with_outlier_flags(df, bounds)).count() == 1


def test_ratio_quality_keeps_the_row(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (None,)], "CloseToOriginalListRatio double")
    rows = outliers.with_ratio_quality(df, (0.9, 1.1)).collect()
    assert [tuple(row) for row in rows] == [(None, False, True), (1.0, True, False), (None, False, False)]


def test_stored_bounds(spark, tmp_path):
    bounds = {"ClosePrice": (1.0, 2.0), "LivingArea": (None, None)}
    outliers.store_bounds(bounds, spark, str(tmp_path / "b"))
    assert outliers.stored_bounds(spark, str(tmp_path / "b"), list(bounds)) == bounds


def test_histogram_matches_numpy(spark):
    values = [float(v) for v in np.random.default_rng(5).integers(0, 5000, 4000)]
    df = spark.createDataFrame([(v, 4.0) for v in values], "ClosePrice double, LivingArea double")
    rows = profile.histogram(df, ["ClosePrice", "LivingArea"]).orderBy("field", "bin").collect()
    low, high = np.quantile(values, [0.01, 0.99])
    counts, edges = np.histogram([v for v in values if low <= v <= high], bins=50)
    assert [row.rows for row in rows[:50]] == counts.tolist()
    assert [row.bin_start for row in rows[:50]] == pytest.approx(edges[:50].tolist())
    flat = {row.bin: row.rows for row in rows[50:] if row.rows}
    assert flat == {25: 4000}


# ---- events -------------------------------------------------------------------------------


def test_postal_code_and_names(spark):
    df = spark.createDataFrame([("90210.0", " a "), ("02134", "")], "PostalCode string, City string")
    rows = events.standardize_dimensions(df, ["PostalCode", "City"]).collect()
    assert [tuple(row) for row in rows] == [("90210", "a"), ("02134", None)]
    names = spark.createDataFrame(
        [(" ", "Ann", None), (None, " ", ""), (None, "Ann", "Lee"), ("Full", "Ann", "Lee")],
        "f string, a string, b string",
    )
    assert one(names, events.agent_name("f", "a", "b")) == ["Ann", None, "Ann Lee", "Full"]


def test_first_of_each(spark):
    df = spark.createDataFrame(
        [("s", "k1", 2), ("s", "k1", 1), ("s", "k2", 3), ("s", None, 5), ("s", None, 4), ("t", None, 6)],
        "SourceDataset string, EventId string, n int",
    )
    kept = events.first_of_each(df, events.DEDUPE_KEY, ["n"])
    assert sorted(row.n for row in kept.collect()) == [1, 3, 4, 6]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    counts = {row.SourceDataset: row for row in events.dedupe_counts(df).collect()}
    assert (counts["s"].rows_in, counts["s"].rows_kept, counts["s"].rows_removed) == (5, 3, 2)
    assert counts["s"].rows_without_id == 2
    published = df.filter("EventId = 'k1'")
    assert events.not_yet_published(df, published).count() == 4


def test_half_the_median_is_not_low(spark):
    df = spark.createDataFrame([("a", 4, 4), ("b", 2, 4), ("c", 1, 9)], "YrMo string, NewListings bigint, ClosedSales bigint")
    flags = {r.YrMo: r.NewListingsLowVolumeFlag for r in market.with_low_volume(df).collect()}
    assert flags == {"a": False, "b": False, "c": False}
    df = df.union(spark.sql("SELECT 'd', 8, 1")).union(spark.sql("SELECT 'e', 8, 4"))
    flags = {r.YrMo: (r.NewListingsLowVolumeFlag, r.ClosedSalesLowVolumeFlag) for r in market.with_low_volume(df).collect()}
    assert flags["b"] == (False, False) and flags["c"] == (True, False) and flags["d"] == (False, True)


def test_publish_refuses_a_fraction(spark):
    schema = ", ".join(
        f"{name} " + {"string": "string", "date": "date", "boolean": "boolean"}.get(kind, "double")
        for name, kind in fixed.EVENT_SCHEMA.items()
    )
    empty = [None] * len(fixed.EVENT_SCHEMA)
    place = list(fixed.EVENT_SCHEMA).index("DaysOnMarket")
    good, bad = list(empty), list(empty)
    good[place], bad[place] = 18.0, 18.5
    assert sinks.publishable(spark.createDataFrame([good], schema)).first().DaysOnMarket == 18
    assert not set(fixed.DIRECT_IDENTIFIERS) & set(sinks.publishable(spark.createDataFrame([good], schema)).columns)
    with pytest.raises(Exception, match="not a whole number"):
        sinks.publishable(spark.createDataFrame([bad], schema)).collect()


# ---- combining and checks -----------------------------------------------------------------


def test_file_selection_and_gaps(spark):
    names = ["Sold202312.csv", "Sold202401.csv", "Sold202401_filled.csv", "Sold202402_filled.csv", "Sold202404.csv"]
    paths = spark.createDataFrame([(f"/d/{name}",) for name in names], "path string")
    chosen = {r.source_month: r.source_version for r in manifest.select_files(paths, True).collect()}
    assert chosen == {"202401": "filled", "202402": "filled", "202404": "raw"}
    chosen = {r.source_month: r.source_version for r in manifest.select_files(paths, False).collect()}
    assert chosen == {"202401": "raw", "202402": "filled", "202404": "raw"}
    assert [r.source_month for r in manifest.missing_months(paths).collect()] == ["202403"]
    with pytest.raises(Exception, match="no YYYYMM"):
        manifest.described(spark.createDataFrame([("/d/Sold.csv",)], "path string")).collect()


def test_duplicate_columns(spark):
    df = spark.createDataFrame(
        [
            ("1", " 1 ", None, "10", "m", "f"),
            ("10", "10.0", "x", "10.0", "m", "f"),
            (None, "5", "6", None, "m", "f"),
            ("7", None, None, None, "m", "f"),
            ("8", "9", "8", None, "m", "f"),
            (None, None, "4", None, "m", "f"),
        ],
        "ListPrice string, `ListPrice.1` string, `ListPrice.2` string, `Other` string, SourceMonth string, SourceFile string",
    )
    rows = {r.duplicate_column: tuple(r)[5:] for r in duplicates.audit(df, "listing").collect()}
    assert rows["ListPrice.1"] == (6, 3, 1, 1, 1)
    # the second copy is compared with values the first one filled in
    assert rows["ListPrice.2"] == (6, 1, 2, 1, 2)
    assert [r.ListPrice for r in duplicates.merged(df).collect()] == ["1", "10", "5", "7", "8", "4"]
    text = df.selectExpr("ListPrice AS City", "`ListPrice.1` AS `City.1`", "SourceMonth", "SourceFile")
    assert duplicates.audit(text, "listing").first().conflicting_non_null_rows_kept_canonical == 2


def test_category_checks(spark):
    good = spark.createDataFrame([("Residential",), (None,)], "PropertyType string")
    checks.enforce(checks.only_category(good, "sold"))
    for rows in ([("Land",), ("Residential",)], [(None,)], [(" Residential",)]):
        with pytest.raises(checks.CheckFailed):
            checks.enforce(checks.only_category(spark.createDataFrame(rows, "PropertyType string"), "sold"))
    padded = spark.createDataFrame([(" Residential",)], "PropertyType string")
    checks.enforce(checks.only_category(padded, "sold", trimmed=True))


def test_missing_columns_are_listed(spark):
    with pytest.raises(checks.CheckFailed, match=r"\['b', 'c'\]"):
        checks.require_columns(spark.sql("SELECT 1 AS a"), ["c", "a", "b"], "sold")


def test_rate_join(spark):
    monthly = spark.createDataFrame([("2024-01", 6.5, 4)], "year_month string, rate_30yr_fixed double, weekly_observation_count bigint")
    df = spark.createDataFrame([("2024-01-31",), ("2024-02-01",), ("bad",)], "CloseDate string")
    joined = enrich.with_rates(df, "CloseDate", monthly)
    assert {r.year_month: r.rate_30yr_fixed for r in joined.collect()} == {"2024-01": 6.5, "2024-02": None}
    assert [r.year_month for r in enrich.unmatched_months(df, "CloseDate", monthly).collect()] == ["2024-02"]
    assert tuple(enrich.join_quality(df, "CloseDate", monthly, "sold").first())[2:] == (3, 1, 2, 1)
    with pytest.raises(checks.CheckFailed):
        checks.enforce(enrich.all_matched(joined, "sold"))
    with pytest.raises(checks.CheckFailed):
        checks.enforce(enrich.rate_keys_unique(monthly.union(monthly)))


# ---- reconciliations ----------------------------------------------------------------------


def failing(*rows):
    with pytest.raises(checks.CheckFailed):
        checks.enforce(*rows)


def test_every_reconciliation_can_fail(spark):
    rows = [("Residential", "202401", "Sold202401.csv"), ("Land", "202401", "Sold202401.csv"), (None, "202402", "Sold202402.csv")]
    combined = spark.createDataFrame(rows, "PropertyType string, SourceMonth string, SourceFile string")
    manifest = combine.source_manifest(combined, "sold")
    checks.enforce(combine.parts_reconcile(combined, manifest, "sold"))
    failing(combine.parts_reconcile(combined.limit(2), manifest, "sold"))
    failing(checks.only_category(combined, "sold"))
    failing(events.typed_dimensions(combined, "sold"))
    trimmed = spark.createDataFrame([(" Residential ",)], "PropertyType string")
    checks.enforce(events.typed_dimensions(trimmed, "sold"))
    failing(checks.only_category(trimmed, "sold"))
    comparison = spark.createDataFrame([("full_flagged", 9), ("clean_filtered", 3)], "dataset string, row_count long")
    checks.enforce(stages.filtered_reconcile(combined, comparison))
    failing(stages.filtered_reconcile(combined.limit(2), comparison))
    failing(checks.same_row_count("n", combined, combined.limit(1)))
    totals = combine.aggregation_summary(manifest, combined.limit(2), combine.keep_category(combined), "sold").first()
    assert (totals.rows_before_concat, totals.rows_after_concat, totals.rows_after_residential_filter) == (3, 2, 1)


@pytest.mark.parametrize("broadcast", [100, 1])
def test_first_of_each_with_few_and_many_repeats(spark, broadcast):
    rows = [("a", 2), ("a", 1), ("b", 5), (None, 9), (None, 3), ("c", 4), ("c", 7)]
    df = spark.createDataFrame(rows, "k string, n int")
    found = events.first_of_each(df, ["k"], ["n"], broadcast).collect()
    assert sorted((r.k or "", r.n) for r in found) == [("", 3), ("a", 1), ("b", 5), ("c", 4)]
    alone = df.filter("k = 'b'")
    assert [tuple(r) for r in events.first_of_each(alone, ["k"], ["n"], broadcast).collect()] == [("b", 5)]


def test_a_seller_without_prices_has_no_volume_but_units(spark):
    df = spark.createDataFrame([("x", None, 1), ("y", 5.0, 1), ("x", None, 1)], "name string, SalesVolume double, UnitsSold int")
    assert [tuple(r) for r in market.top_sellers(df, "name").collect()] == [("y", 5.0, 1), ("x", 0.0, 2)]
