"""The rank index against full passes, and first rows on a stream against the batch, in any order of arrival."""

import itertools
import random

import numpy as np
import pytest

from parcelworks.operators import events, rank_index
from parcelworks.operators.quantiles import long_values, quantiles
from parcelworks.streaming import firsts, jobs

# ---- rank index -----------------------------------------------------------------------------

SCHEMA = "month string, price double, days int, other string"
SHARES = {"low": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75}


def months_of(r, *months):
    odd = [0.0, -0.0, -5.5, 1e-300, 1e300, float("inf")]
    return [
        (month, None if r.random() < 0.1 else r.choice(odd) if r.random() < 0.1 else r.gauss(3e5, 1e5), r.choice([None, *range(40)]), "x")
        for month in months
        for _ in range(300)
    ]


def stored(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").partitionBy("month").parquet(path)
    return spark.read.parquet(path)


def test_any_months_give_the_quantiles_of_a_full_pass(spark, tmp_path):
    r = random.Random(1)
    table = stored(spark, str(tmp_path / "t"), months_of(r, "2024-01", "2024-02", "2024-03"))
    path = str(tmp_path / "index")
    rank_index.index_months(table, path, ["price", "days"], "month")
    for size in (1, 2, 3):
        for chosen in itertools.combinations(["2024-01", "2024-02", "2024-03"], size):
            rows = table.filter(table.month.isin(list(chosen)))
            index = rank_index.stored_index(spark, path, chosen)
            found = rank_index.indexed_quantiles(index, rows, ["price", "days"], SHARES, "month")
            expected = quantiles(long_values(rows, ["price", "days"]), SHARES)
            assert sorted(map(tuple, found.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))


def test_quantiles_per_month(spark, tmp_path):
    rows = months_of(random.Random(2), "2024-01", "2024-02")
    table, path = stored(spark, str(tmp_path / "t"), rows), str(tmp_path / "index")
    rank_index.index_months(table, path, ["days"], "month")
    found = rank_index.indexed_quantiles(rank_index.stored_index(spark, path), table, ["days"], {"median": 0.5}, "month", True)
    expected = {m: float(np.median([d for n, _, d, _ in rows if n == m and d is not None])) for m in ("2024-01", "2024-02")}
    assert {row.month: row.median for row in found.collect()} == expected


def test_a_new_month_reads_itself_and_the_bins_that_hold_ranks(spark, tmp_path):
    r = random.Random(3)
    table, path = stored(spark, str(tmp_path / "t"), months_of(r, "2024-01", "2024-02")), str(tmp_path / "index")
    rank_index.index_months(table, path, ["price"], "month", ["2024-01"])
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    rank_index.index_months(table, path, ["price"], "month", ["2024-02"])
    assert old and {p: p.stat().st_mtime_ns for p in old} == old
    plan = table.filter(table.month.isin(["2024-02"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [(month" in plan
    # the rows read again are those in a few bins, and the scan is told
    index = rank_index.stored_index(spark, path)
    bins = rank_index.added(index.drop("_month"))
    ranges = rank_index.holding(bins, {"median": 0.5})
    some = rank_index.in_ranges(table, ranges, ["price"])
    assert 0 < some.count() < 0.05 * table.count()
    assert "PushedFilters: [Or" in some._jdf.queryExecution().executedPlan().toString() or "PushedFilters: [IsNotNull(price)" in (
        some._jdf.queryExecution().executedPlan().toString()
    )
    # a month that is given again replaces its counts
    rank_index.index_months(table, path, ["price"], "month", ["2024-02"])
    assert sum(row.rows for row in rank_index.stored_index(spark, path).collect()) == table.count()


def test_an_index_of_nothing(spark, tmp_path):
    table = spark.createDataFrame([("2024-01", None, None, "x")], SCHEMA)
    rank_index.index_months(table, str(tmp_path / "index"), ["price"], "month")
    index = rank_index.stored_index(spark, str(tmp_path / "index"))
    assert rank_index.indexed_quantiles(index, table, ["price"], {"median": 0.5}, "month").collect() == []


# ---- first rows on a stream -----------------------------------------------------------------

EVENTS = "EventId string, SourceDataset string, SourceMonth string, price double, n bigint, day date, at timestamp, note string"
ORDER = ["SourceMonth", "price", "n", "day"]


def event_rows(r):
    import datetime as dt

    rows = []
    for i in range(60):
        rows.append(
            (r.choice(["a", "b", "c", "d", None]), r.choice(["sold", "listed"]), r.choice(["202401", "202402", None]),
             r.choice([None, -2.5, -1e-9, 0.0, 3.0, 1e20, 2.0]), r.choice([None, -(2**62), -1, 0, 9, 10, 2**53 + 1]),
             r.choice([None, dt.date(2024, 1, 5)]), r.choice([None, dt.datetime(2024, 1, 5, 1, 2, 3, 456789)]), f"r{i}")
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_files_in_any_order_give_the_batch(spark, tmp_path, seed):
    r = random.Random(seed)
    rows = event_rows(r)
    # a total order, so that one row is the first
    batch = events.first_of_each(spark.createDataFrame(rows, EVENTS), events.DEDUPE_KEY, [*ORDER, "note"])
    expected = sorted(map(repr, batch.collect()))
    r.shuffle(rows)
    source, path, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    for at in range(0, 60, 20):
        spark.createDataFrame(rows[at : at + 20], EVENTS).coalesce(1).write.mode("append").parquet(source)
        before = spark.conf.get(firsts.STATE_STORE, None)
        stream = spark.readStream.schema(EVENTS).parquet(source)
        jobs_done = firsts.land_first(stream, path, checkpoint, order=[*ORDER, "note"])
        jobs_done.awaitTermination()
        assert spark.conf.get(firsts.STATE_STORE, None) == before
    found = firsts.landed_first(spark, path, batch.schema)
    assert sorted(map(repr, found.select(*batch.columns).collect())) == expected
    corrections = spark.read.parquet(path).agg({"correction": "max"}).first()[0]
    assert corrections >= 1


def test_an_order_that_cannot_be_kept_is_refused(spark):
    table = spark.createDataFrame([], "k string, b binary")
    with pytest.raises(ValueError, match="binary"):
        firsts.place_in_order(table, ["b"])
    assert jobs.deduped(spark.createDataFrame([("a", "s"), ("a", "s")], "EventId string, SourceDataset string")).count() == 1
