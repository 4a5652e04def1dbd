"""Outlier flags on a running stream by bounds that may change while it runs.

Bounds are published as versions; every micro-batch reads the latest before its rows are flagged, a
few rows as literals in generated code, and each row says by which version it was judged. The
version that a batch uses is noted before its rows are written, so that a batch that is run again
flags as it did, even if new bounds have come meanwhile.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelworks import fixed
from parcelworks.operators.outliers import Bounds, as_bounds, with_outlier_flags
from parcelworks.sources import versions

BOUNDS = "field string, lower_bound double, upper_bound double"


def publish_bounds(bounds: Bounds, spark: SparkSession, root: str) -> int:
    """Publish bounds as the next version at ``root``; equal bounds make none. Returns the latest number."""
    rows = [(name, lower, upper) for name, (lower, upper) in bounds.items()]
    return versions.publish(spark.createDataFrame(rows, BOUNDS), root, "field")


def bounds_of_version(
    spark: SparkSession, root: str, version: int | None = None, fields: Sequence[str] = fixed.OUTLIER_FIELDS
) -> Bounds:
    """Published bounds, the latest by default; a field without any has open ones."""
    return as_bounds(versions.read_version(spark, root, version), fields)


def flag_arriving(
    stream: DataFrame,
    bounds_root: str,
    path: str,
    checkpoint: str,
    fields: Sequence[str] = fixed.OUTLIER_FIELDS,
    wait: bool = False,
) -> StreamingQuery:
    """Write flagged rows, with ``bounds_version``, to ``path``; stop at the end of what has arrived unless ``wait``.

    A micro-batch replaces its own rows, so each row is there once. Bounds must have been published
    before the first batch.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        used = _version_of(spark, path, number)
        if used is None:
            used = versions.versions(spark, bounds_root)[-1]
            spark.createDataFrame([(used,)], "bounds_version long").write.mode("overwrite").parquet(
                f"{path}/used/batch={number}"
            )
        flagged = with_outlier_flags(batch, bounds_of_version(spark, bounds_root, used, fields))
        flagged.withColumn("bounds_version", F.lit(used).cast("long")).write.mode("overwrite").parquet(
            f"{path}/rows/batch={number}"
        )

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer if wait else writer.trigger(availableNow=True)).start()


def _version_of(spark: SparkSession, path: str, number: int) -> int | None:
    """The version noted for a batch, if its note is complete."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/used/batch={number}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        return None
    return spark.read.schema("bounds_version long").parquet(f"{path}/used/batch={number}").first()[0]


def flagged_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows flagged so far."""
    return spark.read.parquet(f"{path}/rows").drop("batch")
