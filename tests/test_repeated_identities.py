"""Only rows of repeated identities are ordered and shuffled, and events are made with the columns that are read."""

import datetime

import pytest

from parcelworks import fixed
from parcelworks.operators import events
from parcelworks.plans import stages
from parcelworks.sources.staging import staged

DAY = datetime.date(2024, 3, 5)
SOLD = (
    "ListingKey string, CloseDate date, ClosePrice double, OriginalListPrice double, City string, SourceMonth string, "
    "tie bigint, CloseToOriginalListRatio double"
)
LISTED = "ListingKey string, ListingContractDate date, City string, SourceMonth string, tie bigint"
WANTED = ["SourceDataset", "EventId", "EventDate", "EventType", "City", "ClosePrice", "CloseToOriginalListRatio"]


@pytest.fixture
def inputs(spark, monkeypatch):
    monkeypatch.setattr(events, "ROWS_ORDERED_AT_ONCE", 0)
    sales = [
        ("a", DAY, 5.0, 5.0, " X ", "202403", 2, 1.0),
        ("a", DAY, 4.0, 5.0, "Y", "202403", 1, 0.8),
        ("a ", DAY, 3.0, 5.0, "Z", "202402", 9, 9.9),
        ("b", DAY, 2.0, 5.0, " ", "202403", 1, None),
        (None, DAY, 1.0, 5.0, "V", "202403", 3, 1.0),
        (None, DAY, 1.5, 5.0, "W", None, 7, 1.0),
        ("c", DAY, None, 5.0, None, "202403", 4, 1.0),
        ("c", DAY, None, 5.0, None, "202403", 4, 1.0),
    ]
    listings = [("a", DAY, "N", "202403", 1), ("a", DAY, "M", "202403", 0), ("e", DAY, "L", None, 0), (None, DAY, "K", "202403", 0)]
    return staged(spark.createDataFrame(sales, SOLD), "sales"), staged(spark.createDataFrame(listings, LISTED), "listings")


def test_events_are_made_with_the_columns_asked_for(inputs):
    kept, listings = inputs
    found = stages.all_events(kept, listings, (0.5, 1.5), ["tie"], WANTED)
    assert found.columns == [*WANTED, "SourceMonth", "tie"]
    chosen = stages.market_events(found, ["tie"])
    assert chosen.columns == [name for name in fixed.EVENT_SCHEMA if name in WANTED]
    rows = {(row.EventType, row.EventId): (row.City, row.ClosePrice, row.CloseToOriginalListRatio) for row in chosen.collect()}
    assert rows == {
        (fixed.CLOSED_SALE, "Closed Sale|a|2024-03-05"): ("Z", 3.0, None),
        (fixed.CLOSED_SALE, "Closed Sale|b|2024-03-05"): (None, 2.0, None),
        (fixed.CLOSED_SALE, "Closed Sale|c|2024-03-05"): (None, None, 1.0),
        (fixed.CLOSED_SALE, None): ("W", 1.5, 1.0),
        (fixed.NEW_LISTING, "New Listing|a|2024-03-05"): ("M", None, None),
        (fixed.NEW_LISTING, "New Listing|e|2024-03-05"): ("L", None, None),
        (fixed.NEW_LISTING, None): ("K", None, None),
    }


@pytest.mark.parametrize("limit", [0, 1, 100])
def test_rows_chosen_before_events_are_made_give_the_same(inputs, monkeypatch, limit):
    kept, listings = inputs
    among = stages.events_among(kept, listings, (0.5, 1.5), ["tie"], WANTED)
    found = stages.all_events(kept, listings, (0.5, 1.5), ["tie"], WANTED)
    plain = events.first_of_each(found, events.DEDUPE_KEY, ["SourceMonth", "tie"]).select(*WANTED)
    monkeypatch.setattr(stages, "REPEATED_TO_BROADCAST", limit)
    chosen = stages.market_events(found, ["tie"], among).select(*WANTED)
    assert sorted(map(str, chosen.collect())) == sorted(map(str, plain.collect())) and chosen.count() == 7


def test_rows_of_single_identities_are_not_shuffled(inputs):
    kept, listings = inputs
    found = stages.all_events(kept, listings, (0.5, 1.5), ["tie"], WANTED)
    plan = stages.market_events(found, ["tie"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
