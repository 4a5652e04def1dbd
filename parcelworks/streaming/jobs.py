"""Monthly files as a stream: landing, deduplication, running measures and flagging.

The operators of the batch stages work unchanged on a streaming DataFrame where they keep no
state; here are the sources, the sinks and the two operators that do keep state.
"""

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelworks import fixed
from parcelworks.operators.duplicates import merged_files
from parcelworks.operators.events import DEDUPE_KEY
from parcelworks.operators.market import with_low_volume
from parcelworks.operators.quantiles import quantiles
from parcelworks.sources.csv_files import read_files
from parcelworks.sources.manifest import select_files
from parcelworks.streaming.firsts import state_on_disk


def land_files(
    spark: SparkSession,
    folder: str,
    prefix: str,
    path: str,
    checkpoint: str,
    prefer_filled: bool,
    first_month: str = fixed.FIRST_MONTH,
    multi_line: bool = True,
) -> StreamingQuery:
    """Land the monthly files that have arrived, by the rules of the batch; then stop.

    The stream is one of file names. A micro-batch reads its files by column name, whatever the
    order of their headers, merges repeated columns, and replaces the months whose chosen file
    has changed, so that a filled file takes the place of the raw one. A batch that is run again
    lands the same. ``landed_rows`` reads the result.
    """

    def add(batch: DataFrame, number: int) -> None:
        arrived = [row["path"] for row in batch.select("path").collect()]
        known = f"{path}/files"
        spark.createDataFrame([(one,) for one in arrived], "path string").write.mode("overwrite").parquet(
            f"{known}/batch={number}"
        )
        every = spark.read.schema("path string, batch long").parquet(known).filter(f"batch <= {number}")
        chosen = select_files(every.select("path").distinct(), prefer_filled, first_month)
        fresh = [row["path"] for row in chosen.select("path").collect() if row["path"] in set(arrived)]
        if fresh:
            rows = merged_files(read_files(spark, fresh, multi_line))
            rows.withColumn("month", F.col("SourceMonth")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("month").parquet(f"{path}/rows")

    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", f"{prefix}20*.csv")
        .load(folder)
        .select("path")
    )
    return (
        names.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landed_rows(spark: SparkSession, path: str) -> DataFrame:
    """What ``land_files`` has landed; a column that a month lacks is null in its rows."""
    return spark.read.option("mergeSchema", True).parquet(f"{path}/rows").drop("month")


def land(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet table, each row once; then stop.

    State that the stream keeps is kept on disk.
    """
    with state_on_disk(stream.sparkSession):
        return (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        )


def deduped(events: DataFrame, key: Sequence[str] = DEDUPE_KEY) -> DataFrame:
    """One event per identity over the whole stream, the first to arrive; see ``firsts`` for the batch's choice.

    Every identity seen is kept in state, spread over the shuffle partitions; start the stream with
    ``land`` or within ``state_on_disk``, as that state grows with it.
    """
    return events.dropDuplicates(list(key))


MEASURE_SUMS = [
    "count(*) AS rows",
    "sum(NewListings) AS NewListings",
    "sum(ClosedSales) AS ClosedSales",
    "sum(DaysOnMarket) AS days_sum",
    "count(DaysOnMarket) AS days_count",
    "sum(CloseToOriginalListRatio) AS ratio_sum",
    "count(CloseToOriginalListRatio) AS ratio_count",
]


COUNTED = "YrMo string, value double, " + ", ".join(
    f"{text.split(' AS ')[1]} {'double' if text.split(' AS ')[1].endswith('_sum') else 'long'}" for text in MEASURE_SUMS
)


def count_into(events: DataFrame, path: str, checkpoint: str, fold_every: int = 20) -> StreamingQuery:
    """Keep counted prices and sums per month, one folder per micro-batch.

    A batch that is run again overwrites its own folder, so nothing counts twice, and no
    aggregation state is held in the stream. Every so many batches all counts so far are folded
    into one table, which counts from when it is complete; what it holds is then not read again.
    """

    def add(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy("YrMo", F.col("ClosePrice").alias("value")).agg(
            *[F.expr(text) for text in MEASURE_SUMS]
        )
        counted.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if number and number % fold_every == 0:
            fold(batch.sparkSession, path, number)

    return (
        events.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _complete(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the folders of a kind whose write has been committed."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/_SUCCESS")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    found = [re.search(rf"{kind}=(\d+)/_SUCCESS$", file.getPath().toString()) for file in files or []]
    return sorted(int(one[1]) for one in found if one)


def counted_so_far(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The latest folded table and the batches after it, up to a batch number if one is given."""
    upto = [n for n in _complete(spark, path, "upto") if before is None or n < before]
    last = upto[-1] if upto else -1
    batches = [n for n in _complete(spark, path, "batch") if n > last and (before is None or n <= before)]
    paths = [f"{path}/upto={last}"] * bool(upto) + [f"{path}/batch={n}" for n in batches]
    return spark.read.schema(COUNTED).parquet(*paths) if paths else spark.createDataFrame([], COUNTED)


def fold(spark: SparkSession, path: str, number: int) -> None:
    """Counts up to and including a batch as one table; readers use it once its write is committed."""
    names = [text.split(" AS ")[1] for text in MEASURE_SUMS]
    folded = counted_so_far(spark, path, before=number).groupBy("YrMo", "value").agg(
        *[F.expr(f"sum({name}) AS {name}") for name in names]
    )
    folded.write.mode("overwrite").parquet(f"{path}/upto={number}")


def running_summary(spark: SparkSession, path: str) -> DataFrame:
    """The monthly summary of everything counted so far, medians exact."""
    counted = counted_so_far(spark, path)
    sums = counted.groupBy("YrMo").agg(
        F.expr("sum(NewListings) AS NewListings"),
        F.expr("sum(ClosedSales) AS ClosedSales"),
        F.expr("sum(days_sum) / nullif(sum(days_count), 0) AS AverageDaysOnMarket"),
        F.expr("sum(ratio_sum) / nullif(sum(ratio_count), 0) AS AverageCloseToOriginalListRatio"),
    )
    prices = (
        counted.groupBy("YrMo", F.lit("ClosePrice").alias("field"), "value").agg(F.expr("sum(rows) AS rows"))
    )
    medians = quantiles(prices, {"MedianClosePrice": 0.5}, ["YrMo"], broadcast=True).select("YrMo", "MedianClosePrice")
    summary = sums.join(medians, sums.YrMo.eqNullSafe(medians.YrMo), "left").drop(medians.YrMo)
    return with_low_volume(summary).orderBy("YrMo")
