"""Running monthly measures kept in the state store of a stream.

The stream counts events by month and price, with sums beside; nothing but its state and its logs is
written, so storage grows with the distinct prices of the months, not with the number of batches.
The state of the last finished batch is the table that measures are read from: it changes with the
batch's commit, so no event counts twice when a batch is run again, and averages and exact medians
follow from it. A stream may go on meanwhile.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelworks.operators.market import with_low_volume
from parcelworks.operators.quantiles import quantiles
from parcelworks.sources.staging import staged
from parcelworks.streaming.firsts import state_on_disk

# name: (sum, type), in the order of the state's values
COUNTS = {
    "rows": ("count(1)", "bigint"),
    "NewListings": ("sum(bigint(NewListings))", "bigint"),
    "ClosedSales": ("sum(bigint(ClosedSales))", "bigint"),
    "days_sum": ("sum(double(DaysOnMarket))", "double"),
    "days_count": ("count(DaysOnMarket)", "bigint"),
    "ratio_sum": ("sum(double(CloseToOriginalListRatio))", "double"),
    "ratio_count": ("count(CloseToOriginalListRatio)", "bigint"),
}


def count_events(events: DataFrame) -> DataFrame:
    """Counts and sums of events by month and price; on a stream, its state."""
    keyed = events.selectExpr(
        "YrMo", "double(ClosePrice) AS value", "NewListings", "ClosedSales", "DaysOnMarket", "CloseToOriginalListRatio"
    )
    return keyed.groupBy("YrMo", "value").agg(*[F.expr(f"{text} AS {name}") for name, (text, _) in COUNTS.items()])


def run_counts(events: DataFrame, checkpoint: str) -> StreamingQuery:
    """Count everything that has arrived into the state at ``checkpoint``; then stop.

    State is on disk and spread over the shuffle partitions of the first run. The number of its
    versions that are kept is the session's ``spark.sql.streaming.minBatchesToRetain``.
    """
    with state_on_disk(events.sparkSession):
        return (
            count_events(events)
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def running_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(YrMo, value, counts...) as of the last finished batch."""
    kinds = ", ".join(f"{name}: {kind}" for name, (_, kind) in COUNTS.items())
    state = spark.read.format("statestore").load(checkpoint)
    # the state names its sums alike; the cast goes by their places
    named = state.selectExpr("key.*", f"CAST(value AS struct<{kinds}>) AS counts")
    return named.toDF("YrMo", "value", "counts").selectExpr("YrMo", "value", "counts.*")


def running_measures(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``market.monthly_summary`` of everything counted so far, medians exact.

    The state is read once and its counts are stored as a hand-off table: the four passes of the
    sums and the quantiles would each load all of it again.
    """
    counted = staged(running_counts(spark, checkpoint), "running-counts")
    sums = counted.groupBy("YrMo").agg(
        F.expr("coalesce(sum(NewListings), 0L) AS NewListings"),
        F.expr("coalesce(sum(ClosedSales), 0L) AS ClosedSales"),
        F.expr("sum(days_sum) / nullif(sum(days_count), 0) AS AverageDaysOnMarket"),
        F.expr("sum(ratio_sum) / nullif(sum(ratio_count), 0) AS AverageCloseToOriginalListRatio"),
    )
    prices = counted.selectExpr("YrMo", "'ClosePrice' AS field", "value", "rows")
    # a row per calendar month
    medians = quantiles(prices, {"MedianClosePrice": 0.5}, ["YrMo"], broadcast=True).select("YrMo", "MedianClosePrice")
    summary = sums.join(medians, sums.YrMo.eqNullSafe(medians.YrMo), "left").select(
        sums.YrMo,
        "NewListings",
        "ClosedSales",
        "MedianClosePrice",
        "AverageDaysOnMarket",
        "AverageCloseToOriginalListRatio",
    )
    return with_low_volume(summary).orderBy("YrMo")
