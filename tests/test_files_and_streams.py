"""CSV sources, the batch run over files, and streams that must equal the batch."""

import csv
import datetime as dt

import pytest

from parcelworks.operators import checks, duplicates, enrich, events
from parcelworks.plans import monthly_run
from parcelworks.sources import csv_files, versions
from parcelworks.streaming import jobs

SOLD_HEADER = (
    "ListingKey PropertyType PropertySubType City CountyOrParish PostalCode MLSAreaMajor StateOrProvince "
    "CloseDate PurchaseContractDate ListingContractDate ContractStatusChangeDate ClosePrice ListPrice "
    "OriginalListPrice LivingArea DaysOnMarket BedroomsTotal BathroomsTotalInteger Latitude Longitude "
    "ListAgentFullName ListAgentFirstName ListAgentLastName ListOfficeName BuyerOfficeName"
).split()
LISTING_HEADER = [
    *(
        "ListingKey PropertyType PropertySubType City CountyOrParish PostalCode MLSAreaMajor StateOrProvince "
        "ListingContractDate ContractStatusChangeDate ListPrice OriginalListPrice LivingArea DaysOnMarket "
        "BedroomsTotal BathroomsTotalInteger Latitude Longitude"
    ).split(),
    "ListPrice",
]


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as sink:
        writer = csv.writer(sink)
        writer.writerow(header)
        writer.writerows(rows)


def sold_row(month, number, **changes):
    listed = dt.date(2024, month, 1)
    price = 100_000 + 1_000 * number
    row = dict.fromkeys(SOLD_HEADER, "") | {
        "ListingKey": f"{month}-{number}",
        "PropertyType": "Residential",
        "City": " Town ",
        "CountyOrParish": "North" if number % 2 else "",
        "PostalCode": "02134.0",
        "CloseDate": listed + dt.timedelta(20),
        "PurchaseContractDate": listed + dt.timedelta(5),
        "ListingContractDate": listed,
        "ClosePrice": price,
        "ListPrice": price,
        "OriginalListPrice": price - 1_000,
        "LivingArea": 1_000 + number,
        "DaysOnMarket": 5 + number % 3,
        "BedroomsTotal": 3,
        "BathroomsTotalInteger": 2,
        "Latitude": 34.5,
        "Longitude": -118.5,
        "ListAgentFirstName": "Ann",
        "ListAgentLastName": f"Lee {number % 4}",
        "ListOfficeName": "Office, \"One\"\nSuite 2",
    }
    return [str((row | changes)[name]) for name in SOLD_HEADER]


def listing_row(month, number, copy=None):
    price = 200_000 + number
    row = dict.fromkeys(LISTING_HEADER, "") | {
        "ListingKey": f"L{month}-{number}",
        "PropertyType": "Residential" if number else "Land",
        "City": "Town",
        "ListingContractDate": dt.date(2024, month, 3),
        "OriginalListPrice": price,
        "LivingArea": 900,
        "DaysOnMarket": 4,
        "Latitude": 34.5,
        "Longitude": -118.5,
    }
    cells = [str(row[name]) for name in LISTING_HEADER]
    cells[LISTING_HEADER.index("ListPrice")] = str(price) if number != 2 else "NA"
    cells[-1] = f"{price}.00" if copy is None else copy
    return cells


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("monthly")
    for month in (1, 2, 3):
        rows = [sold_row(month, number) for number in range(20)]
        rows.append(sold_row(month, 0))
        rows.append(sold_row(month, 50, ClosePrice="0"))
        rows.append(sold_row(month, 51, PropertyType="Land"))
        rows.append(sold_row(month, 52, ClosePrice="99000000"))
        write(root / f"Sold2024{month:02d}.csv", SOLD_HEADER, rows)
        write(root / f"Listing2024{month:02d}.csv", LISTING_HEADER, [listing_row(month, n) for n in range(9)])
    # replaces the raw file of its month
    write(root / "Sold202402_filled.csv", SOLD_HEADER, [sold_row(2, number) for number in range(10)])
    weeks = [dt.date(2024, 1, 4) + dt.timedelta(7 * week) for week in range(14)]
    write(root / "rates.csv", ["observation_date", "MORTGAGE30US"], [[w, 6 + i / 10] for i, w in enumerate(weeks)] + [["2024-01-02", "."]])
    return str(root)


def test_repeated_headers_get_numbers():
    assert csv_files.distinct_names(["X", "X", "X.1", "X", None]) == ["X", "X.2", "X.1", "X.3", "Unnamed: 4"]


def test_quoted_cells_and_missing_tokens(spark, tmp_path):
    (tmp_path / "Sold202401.csv").write_text('A,B,A\n"1,5","x ""y""\nz",NA\n,NULL,007\n', encoding="utf-8")
    rows = csv_files.read_csv(spark, [str(tmp_path / "Sold202401.csv")]).collect()
    assert [tuple(row) for row in rows] == [
        ("1,5", 'x "y"\nz', None, "202401", "Sold202401.csv"),
        (None, None, "007", "202401", "Sold202401.csv"),
    ]


def test_strict_reader(spark, tmp_path):
    schema = {"a": "integer", "b": "boolean"}
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,true\n,FALSE\n", encoding="utf-8")
    assert [tuple(r) for r in csv_files.read_strict(spark, str(path), schema).collect()] == [(1, True), (None, False)]
    path.write_text("a,b\n1\n", encoding="utf-8")
    with pytest.raises(Exception):
        csv_files.read_strict(spark, str(path), schema).collect()
    with pytest.raises(checks.CheckFailed):
        csv_files.read_strict(spark, str(path), {"b": "boolean", "a": "integer"})


def test_missing_month_is_an_error(spark, folder):
    with pytest.raises(ValueError, match="202312"):
        csv_files.read_monthly(spark, folder, "Sold", True, first_month="202312")


def test_batch_run(spark, folder, tmp_path):
    stored = monthly_run.run(spark, folder, f"{folder}/rates.csv", str(tmp_path / "out"))
    manifest = {r.source_file: (r.rows_read, r.residential_rows) for r in stored["sold_manifest"].collect()}
    assert manifest == {
        "Sold202401.csv": (24, 23),
        "Sold202402_filled.csv": (10, 10),
        "Sold202403.csv": (24, 23),
    }
    assert "ListPrice.1" not in stored["listings_combined"].columns
    copies = stored["listings_duplicate_columns"].collect()
    assert [(r.equivalent_rows, r.duplicate_only_rows_recovered) for r in copies] == [(8, 1)] * 3
    assert stored["listings_combined"].filter("ListPrice IS NULL").count() == 0
    cleaning = stored["sold_cleaning_summary"].first()
    assert (cleaning.rows_before, cleaning.rows_removed) == (56, 2)
    audit = stored["publication_audit"].first()
    assert (audit.sold_input_rows, audit.closed_sale_events, audit.sold_exact_duplicates_removed) == (52, 50, 2)
    assert (audit.new_listing_events, audit.market_event_rows, audit.calendar_months) == (24, 74, 3)
    events_table = stored["market_events"]
    assert events_table.filter("PostalCode <> '02134' AND EventType = 'Closed Sale'").count() == 0
    assert events_table.select("City").distinct().collect()[0].City == "Town"
    assert stored["competitive_sales"].filter("ListOfficeName LIKE '%\n%'").count() == 50
    assert sum(r.UnitsSold for r in stored["top_agents"].collect()) == 50
    assert "EventId" not in stored["market_extract"].columns
    counties = {r.CountyOrParish: r.Transactions for r in stored["county_summary"].collect()}
    assert counties == {"North": 25, None: 29}


def test_a_redelivered_month_is_all_that_is_published_again(spark, tmp_path):
    root, stored = str(tmp_path), {}

    def published(*rows):
        table = spark.createDataFrame(rows, "EventId string, SourceDataset string, YrMo string, ClosePrice double")
        monthly_run.publish_events(spark, table, table.drop("EventId"), root, stored.__setitem__)
        latest = versions.read_version(spark, f"{root}/market_events")
        assert sorted(map(repr, latest.select(*table.columns).collect())) == sorted(map(repr, table.collect()))
        return sorted((r.YrMo, r.new_events) for r in stored["newly_published"].collect())

    first = [("a", "sold", "2024-01", 1.0), ("b", "sold", "2024-02", 2.0), (None, "sold", "2024-02", 3.0)]
    assert published(*first) == [("2024-01", 1), ("2024-02", 2)]
    assert published(*first[::-1]) == [] and versions.versions(spark, f"{root}/market_events") == [0]
    # b is the same event at another price; the event without identity counts again with its month
    assert published(first[0], ("b", "sold", "2024-02", 2.5), first[2], ("c", "sold", "2024-02", 4.0)) == [("2024-02", 2)]
    written = {r.month: r.version for r in versions.manifest(spark, f"{root}/market_events", 1).collect()}
    assert written == {"2024-01": 0, "2024-02": 1}


def test_a_lost_row_is_seen_by_the_run(spark, folder, tmp_path, monkeypatch):
    """Records are counted apart from the table, so a reader that drops one fails the gate."""
    monkeypatch.setattr(
        monthly_run, "read_files", lambda *given: [f.filter("NOT ListingKey <=> '1-3'") for f in csv_files.read_files(*given)]
    )
    with pytest.raises(checks.CheckFailed, match="sold combined rows equal the files' rows: observed 57, expected 58"):
        monthly_run.run(spark, folder, f"{folder}/rates.csv", str(tmp_path / "out"))
    manifest = spark.read.parquet(str(tmp_path / "out/sold_manifest"))
    totals = spark.read.parquet(str(tmp_path / "out/sold_aggregation")).first()
    assert manifest.filter("source_month = '202401'").first().rows_read == 24
    assert (totals.rows_before_concat, totals.rows_after_concat) == (58, 57)


def test_stream_lands_what_the_batch_reads(spark, tmp_path):
    """Headers in another order, repeated headers, and a filled file after the raw one of its month."""
    files, to = tmp_path / "in", str(tmp_path / "t")
    files.mkdir()
    write(files / "Sold202401.csv", ["A", "B"], [["a1", "b1"], ["a2", "b2"]])
    write(files / "Sold202402.csv", ["B", "A"], [["b3", "a3"]])
    write(files / "Sold202403.csv", ["A", "B", "A"], [["", "b4", "a4"]])

    def land():
        jobs.land_files(spark, str(files), "Sold", to, str(tmp_path / "c"), True).awaitTermination()
        batch = duplicates.merged_files(csv_files.read_monthly(spark, str(files), "Sold", True))
        columns = ["A", "B", "SourceMonth", "SourceFile"]
        left = sorted(map(tuple, jobs.landed_rows(spark, to).select(*columns).collect()))
        assert left == sorted(map(tuple, batch.select(*columns).collect()))
        return left

    assert land()[2:] == [("a3", "b3", "202402", "Sold202402.csv"), ("a4", "b4", "202403", "Sold202403.csv")]
    write(files / "Sold202402_filled.csv", ["A", "B"], [["a5", "b5"], ["a6", "b6"]])
    write(files / "Sold202404.csv", ["A", "B"], [["a7", "b7"]])
    assert [row[0] for row in land()] == ["a1", "a2", "a4", "a5", "a6", "a7"]
    land()


def test_headers_take_one_job_whatever_the_number_of_files(spark, tmp_path):
    paths = []
    for number in range(12):
        path = tmp_path / f"Sold2024{number + 1:02d}.csv"
        write(path, ["A", f"B {number}", 'C "x", y'], [[1, 2, 3]])
        paths.append(str(path))
    tracker = spark.sparkContext.statusTracker()

    def jobs_of(some):
        group = f"headers of {len(some)}"
        spark.sparkContext.setJobGroup(group, group)
        found = csv_files.headers_of(spark, some)
        return found, len(tracker.getJobIdsForGroup(group))

    few, many = jobs_of(paths[:2]), jobs_of(paths)
    spark.sparkContext.setJobGroup("tests", "tests")
    assert few[1] == many[1]
    assert many[0] == [["A", f"B {number}", 'C "x", y'] for number in range(12)]
    quoted = tmp_path / "Sold202512.csv"
    quoted.write_text('"A\nB",C\n1,2\n', encoding="utf-8")
    assert csv_files.headers_of(spark, [str(quoted)]) == [["A\nB", "C"]]


def test_duplicate_columns_are_audited_and_merged_file_by_file(spark, tmp_path):
    write(tmp_path / "Sold202401.csv", ["A", "B", "A"], [["1", "x", "1"], ["", "y", "2"]])
    write(tmp_path / "Sold202402.csv", ["A", "B"], [["3", "z"], ["4", "w"]])
    write(tmp_path / "Sold202403.csv", ["A.1", "B"], [["5", "v"]])
    files = csv_files.read_files(spark, [str(tmp_path / f"Sold20240{n}.csv") for n in (1, 2, 3)], multi_line=False)
    audited = duplicates.audit_files(files, "sold").collect()
    assert [(r.source_file, r.equivalent_rows, r.duplicate_only_rows_recovered) for r in audited] == [("Sold202401.csv", 1, 1)]
    rows = {r.B: (r.A, r["A.1"]) for r in duplicates.merged_files(files).collect()}
    assert rows == {"x": ("1", None), "y": ("2", None), "z": ("3", None), "w": ("4", None), "v": (None, "5")}


def test_stream_dedupe_over_several_runs(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "SourceDataset string, EventId string, n int"
    batches = [[("s", "a", 1), ("s", "b", 2), ("s", None, 3)], [("s", "a", 4), ("s", None, 5), ("t", "a", 6)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = jobs.deduped(spark.readStream.schema(schema).parquet(source))
        jobs.land(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "t"))
    batch = events.first_of_each(spark.read.parquet(source), events.DEDUPE_KEY, ["n"])
    columns = ["SourceDataset", "EventId"]
    assert sorted(map(str, streamed.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))


def test_running_summary_equals_batch(spark, tmp_path):
    from parcelworks.operators import market

    schema = (
        "YrMo string, ClosePrice double, DaysOnMarket double, CloseToOriginalListRatio double, "
        "NewListings int, ClosedSales int"
    )
    source = str(tmp_path / "in")
    for start in (0, 40):
        rows = [
            (f"2024-0{1 + n % 3}", float(n * n % 37) if n % 5 else None, float(n % 7), n / 10, n % 2, 1 - n % 2)
            for n in range(start, start + 40)
        ]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.count_into(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    batch = market.monthly_summary(spark.read.parquet(source)).collect()
    expected = jobs.running_summary(spark, str(tmp_path / "t")).select(*batch[0].asDict()).collect()
    jobs.fold(spark, str(tmp_path / "t"), 1)
    assert jobs._complete(spark, str(tmp_path / "t"), "upto") == [1]
    running = jobs.running_summary(spark, str(tmp_path / "t")).select(*batch[0].asDict()).collect()
    assert [r[0] for r in expected] == [r[0] for r in running]
    assert len(batch) == 3
    for left, right in zip(batch, running):
        for a, b in zip(left, right):
            assert a == (pytest.approx(b) if isinstance(b, float) else b)


REPORTS = (
    "manifest categories aggregation missing high_missing numeric outliers histogram box join_quality "
    "number_audit date_audit flag_counts cleaning_summary"
).split()


def test_batch_run_stores_every_report(spark, folder, tmp_path, monkeypatch):
    scanned, enforce = [], checks.enforce
    monkeypatch.setattr(checks, "enforce", lambda *given: (scanned.extend(given), enforce(*given)))
    stored = monthly_run.run(spark, folder, f"{folder}/rates.csv", str(tmp_path / "out"))
    # the keys of the rate table and the rules on clean listings; all other gates are observed in writes
    assert len(scanned) == 2
    for name in ("sold", "listings"):
        for report in REPORTS:
            assert stored[f"{name}_{report}"].count() > 0 or report == "high_missing", (name, report)
    for name in ("complete_sample", "dataset_comparison", "monthly_summary", "measure_median_close_price", "measure_new_listings"):
        assert stored[name].count() > 0
    totals = stored["sold_aggregation"].first()
    assert (totals.monthly_files_used, totals.rows_before_concat, totals.rows_after_concat) == (3, 58, 58)
    assert (totals.rows_before_residential_filter, totals.rows_after_residential_filter) == (58, 56)
    assert stored["listings_duplicate_totals"].first().values_recovered == 3
    # audited after enrichment: the rate is there
    assert "rate_30yr_fixed" in {r.column for r in stored["sold_number_audit"].collect()}
    wide = [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("sold_") and len(spark.read.parquet(str(p)).columns) > 26]
    assert sorted(wide) == ["sold_combined", "sold_flagged", "sold_typed"]


def test_times_of_day_are_kept(spark):
    from parcelworks.functions import casts

    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("2024-01-06",), ("x",)], "d string")
    formats = ("yyyy-M-d H:m:s", "yyyy-M-d")
    found = enrich.dated(df, "d", formats)
    assert sorted(str(r.d) for r in found.collect()) == ["2024-01-05 10:00:00", "2024-01-06 00:00:00"]
    assert {r.year_month for r in found.collect()} == {"2024-01"}
    assert not casts.has_time("yyyy-M-d") and casts.has_time("yyyy-M-d'T'H:m:s") and not casts.has_time("d'of'MM")


def test_the_run_names_months_without_a_rate(spark):
    rows = spark.createDataFrame([("2024-01", 6.0), ("2024-02", None), ("2024-02", None)], "year_month string, rate_30yr_fixed double")
    with pytest.raises(checks.CheckFailed, match="in 2024-02: observed 2"):
        checks.enforce(enrich.all_matched(rows, "sold"))


def test_csv_sink_can_be_read_back(spark, tmp_path):
    from parcelworks.sources import sinks

    rows = [("a,b", 'x "y"', 1.5), ("line\nbreak", None, None)]
    sinks.write_csv(spark.createDataFrame(rows, "a string, b string, c double").coalesce(1), str(tmp_path / "out"))
    path = next((tmp_path / "out").glob("part-*.csv"))
    named = tmp_path / "Sold202401.csv"
    named.write_bytes(path.read_bytes())
    found = csv_files.read_csv(spark, [str(named)]).select("a", "b", "c").collect()
    assert [tuple(r) for r in found] == [("a,b", 'x "y"', "1.5"), ("line\nbreak", None, None)]
