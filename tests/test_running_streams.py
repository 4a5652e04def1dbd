"""Streams whose bounds change while they run, and measures kept in a stream's state."""

import pytest

from parcelworks.operators import market, outliers
from parcelworks.sources import versions
from parcelworks.streaming import flagging, running

EVENTS = (
    "YrMo string, ClosePrice double, DaysOnMarket double, CloseToOriginalListRatio double, NewListings int, ClosedSales int"
)


def arrive(spark, source, start, count=40):
    rows = [
        (
            None if n % 17 == 0 else f"2024-0{1 + n % 3}",
            float(n * n % 37) if n % 5 else None,
            float(n % 7) if n % 4 else None,
            n / 10 if n % 3 else None,
            n % 2,
            1 - n % 2,
        )
        for n in range(start, start + count)
    ]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)


def test_measures_in_state_equal_the_batch_after_every_restart(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    for start in (0, 40, 80):
        arrive(spark, source, start)
        running.run_counts(spark.readStream.schema(EVENTS).parquet(source), checkpoint).awaitTermination()
        found = running.running_measures(spark, checkpoint)
        batch = market.monthly_summary(spark.read.parquet(source))
        assert found.columns == batch.columns
        left, right = found.collect(), batch.collect()
        assert len(left) == 4 and len(left) == len(right)
        for a, b in zip(left, right):
            assert [x if x is None or isinstance(x, (str, bool)) else pytest.approx(x) for x in b] == list(a)


def test_state_does_not_grow_with_the_number_of_batches(spark, tmp_path):
    """The same prices again and again: as many rows of state, and files of a bounded number of batches."""
    source, checkpoint = tmp_path / "in", tmp_path / "c"
    before = spark.conf.get("spark.sql.streaming.minBatchesToRetain")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    sizes, files = [], []
    try:
        for _ in range(7):
            arrive(spark, str(source), 0)
            running.run_counts(spark.readStream.schema(EVENTS).parquet(str(source)), str(checkpoint)).awaitTermination()
            sizes.append(running.running_counts(spark, str(checkpoint)).count())
            files.append(len(list((checkpoint / "commits").glob("[0-9]*"))))
    finally:
        spark.conf.set("spark.sql.streaming.minBatchesToRetain", before)
    assert len(set(sizes)) == 1 and max(files) <= 4
    assert running.running_counts(spark, str(checkpoint)).selectExpr("sum(rows)").first()[0] == 280


SALES = "k long, ClosePrice double, LivingArea double, DaysOnMarket long"


def sales(spark, source, keys):
    rows = [(k, float(k) if k % 7 else None, 100.0, -1 if k % 10 == 0 else 5) for k in keys]
    spark.createDataFrame(rows, SALES).coalesce(1).write.mode("append").parquet(source)


def bounds(lower, upper):
    return {"ClosePrice": (lower, upper), "LivingArea": (1.0, 1000.0), "DaysOnMarket": (None, None)}


def test_a_running_stream_uses_bounds_stored_between_two_batches(spark, tmp_path):
    source, root, path = str(tmp_path / "in"), str(tmp_path / "bounds"), str(tmp_path / "t")
    assert flagging.publish_bounds(bounds(10.0, 20.0), spark, root) == 0
    sales(spark, source, range(1, 41))
    stream = flagging.flag_arriving(spark.readStream.schema(SALES).parquet(source), root, path, str(tmp_path / "c"), wait=True)
    try:
        stream.processAllAvailable()
        assert flagging.publish_bounds(bounds(10.0, 20.0), spark, root) == 0
        assert flagging.publish_bounds(bounds(0.0, 60.0), spark, root) == 1
        sales(spark, source, range(41, 81))
        stream.processAllAvailable()
    finally:
        stream.stop()
    found = flagging.flagged_rows(spark, path).collect()
    assert sorted(r.k for r in found) == list(range(1, 81))
    for r in found:
        lower, upper = (10, 20) if r.k <= 40 else (0, 60)
        assert r.bounds_version == (0 if r.k <= 40 else 1)
        assert r.ClosePrice_outlier_flag == (r.ClosePrice is not None and not lower <= r.ClosePrice <= upper)
        assert r.analysis_exclude_flag == (r.ClosePrice_outlier_flag or r.k % 10 == 0)


def test_a_batch_that_is_run_again_keeps_its_bounds(spark, tmp_path):
    """The checkpoint of the batch's end is lost, and new bounds have come, before it is run again."""
    source, root, path = str(tmp_path / "in"), str(tmp_path / "bounds"), str(tmp_path / "t")
    flagging.publish_bounds(bounds(10.0, 20.0), spark, root)
    sales(spark, source, range(1, 31))
    stream = spark.readStream.schema(SALES).parquet(source)
    flagging.flag_arriving(stream, root, path, str(tmp_path / "c")).awaitTermination()
    first = sorted(map(str, flagging.flagged_rows(spark, path).collect()))
    flagging.publish_bounds(bounds(0.0, 60.0), spark, root)
    for name in ("0", ".0.crc"):
        (tmp_path / "c/commits" / name).unlink(missing_ok=True)
    flagging.flag_arriving(stream, root, path, str(tmp_path / "c")).awaitTermination()
    assert sorted(map(str, flagging.flagged_rows(spark, path).collect())) == first
    assert versions.versions(spark, root) == [0, 1]


def test_flags_equal_the_batch_of_the_same_bounds(spark, tmp_path):
    source, root, path = str(tmp_path / "in"), str(tmp_path / "bounds"), str(tmp_path / "t")
    sales(spark, source, range(1, 61))
    table = spark.read.schema(SALES).parquet(source)
    pairs = outliers.as_bounds(outliers.bounds_table(table))
    flagging.publish_bounds(pairs, spark, root)
    flagging.flag_arriving(spark.readStream.schema(SALES).parquet(source), root, path, str(tmp_path / "c")).awaitTermination()
    found = flagging.flagged_rows(spark, path).drop("bounds_version")
    assert sorted(map(str, found.collect())) == sorted(map(str, outliers.with_outlier_flags(table, pairs).collect()))


def test_the_state_is_read_once_for_all_measures(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    arrive(spark, source, 0)
    running.run_counts(spark.readStream.schema(EVENTS).parquet(source), checkpoint).awaitTermination()
    measures = running.running_measures(spark, checkpoint)
    files = measures.inputFiles()
    assert files and all("/running-counts-" in one for one in files)
    whole = market.monthly_summary(spark.read.schema(EVENTS).parquet(source))
    assert [row.MedianClosePrice for row in measures.collect()] == [row.MedianClosePrice for row in whole.collect()]
