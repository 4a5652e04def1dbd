"""Hand-off tables: a stage's result written once and read back, column-pruned, by later stages.

The tables live in the shared folder of the session, so a lost executor costs a re-read of
finished files and never a recomputation of the whole lineage. ``clear`` deletes what the
application has left there.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from parcelworks.session import shared_folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder of the session."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/parcelworks/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete the application's hand-off tables; results that still read them cannot be computed again."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return the stored table."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
