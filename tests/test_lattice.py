"""Measures from the stored counts of slicers against scans of the events."""

import itertools

import pytest

from parcelworks import fixed
from parcelworks.operators import lattice, market

SCHEMA = (
    "EventDate date, EventType string, City string, CountyOrParish string, PostalCode string, PropertySubType string, "
    "NewListings int, ClosedSales int, ClosePrice double, DaysOnMarket int, CloseToOriginalListRatio double"
)


@pytest.fixture(scope="module")
def events(spark):
    rows = []
    for n in range(400):
        closed = n % 3 != 0
        rows.append(
            (
                None if n % 41 == 0 else f"2024-0{1 + n % 4}-{1 + n % 28:02d}",
                fixed.CLOSED_SALE if closed else fixed.NEW_LISTING,
                None if n % 11 == 0 else f"c{n % 5}",
                None if n % 13 == 0 else f"k{n % 3}",
                f"p{n % 7}",
                "s" if n % 2 else None,
                int(not closed),
                int(closed),
                # a month and city without any price, and prices that repeat
                None if not closed or n % 4 == 2 and n % 5 == 1 else float(n * n % 17),
                None if n % 9 == 0 else n % 23,
                None if n % 10 == 0 else n / 7,
            )
        )
    texts = [tuple(str(v) if i == 0 and v else v for i, v in enumerate(row)) for row in rows]
    frame = spark.createDataFrame(texts, SCHEMA.replace("EventDate date", "EventDate string"))
    return frame.selectExpr("* EXCEPT (EventDate)", "date(EventDate) AS EventDate").cache()


def rows_of(df, column):
    return {r.EventMonth: r[column] for r in df.collect()}


CHOICES = [
    {},
    {"City": ["c1"]},
    {"PropertySubType": ["s"]},
    {"City": ["c1", "c2"], "PostalCode": ["p1", "p3", "p5"]},
    {"City": ["c0", "c3", "c4"], "CountyOrParish": ["k0", "k1"], "PostalCode": ["p2", "p6", "p4"], "PropertySubType": ["s"]},
    {"City": ["nowhere"]},
]


@pytest.mark.parametrize("name", list(market.MEASURES))
def test_measures_of_any_choice_equal_a_scan(spark, events, tmp_path_factory, name):
    path = str(tmp_path_factory.mktemp("lattice") / "t")
    lattice.store_lattice(events, path)
    column = market.MEASURES[name][0]
    for chosen in CHOICES:
        found = rows_of(lattice.lattice_measure(spark, path, name, chosen), column)
        expected = rows_of(market.measure_series(events, *market.MEASURES[name], chosen), column)
        assert found == {k: v if v is None else pytest.approx(v) for k, v in expected.items()}, chosen


def test_only_the_smallest_fitting_set_is_read(spark, events, tmp_path):
    path = str(tmp_path / "t")
    lattice.store_lattice(events, path)
    plan = lattice.lattice_measure(spark, path, "measure_closed_sales", {"City": ["c1"]})._jdf.queryExecution().toString()
    # City alone: all but the first of four slicers are left out
    assert "(_set" in plan and "= 7)" in plan and "PartitionFilters" in plan
    every = [lattice.set_number(fixed.SLICER_COLUMNS, one) for one in lattice.default_sets(fixed.SLICER_COLUMNS)]
    for size in range(5):
        for wanted in itertools.combinations(fixed.SLICER_COLUMNS, size):
            number = lattice.covering(every, fixed.SLICER_COLUMNS, wanted)
            assert number == (lattice.set_number(fixed.SLICER_COLUMNS, wanted) if size < 2 else 0)


def test_sets_that_cannot_answer_are_refused(spark, events, tmp_path):
    path = str(tmp_path / "t")
    lattice.store_lattice(events, path, sets=[(), ("City",)])
    with pytest.raises(ValueError, match="no stored set"):
        lattice.lattice_measure(spark, path, "measure_closed_sales", {"PostalCode": ["p1"]})
    with pytest.raises(ValueError, match="no slicers"):
        lattice.lattice_measure(spark, path, "measure_closed_sales", {"ListPrice": ["1"]})


def test_no_events_no_months(spark, events, tmp_path):
    lattice.store_lattice(events.limit(0), str(tmp_path / "t"))
    for name in market.MEASURES:
        assert lattice.lattice_measure(spark, str(tmp_path / "t"), name, {"City": ["c1"]}).count() == 0
