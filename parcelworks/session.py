"""Session defaults for scripts and tests."""

from pyspark.sql import SparkSession


def local_session(
    shared: str, cores: str = "8", shuffle_partitions: str = "8", memory: str = "8g", **settings
) -> SparkSession:
    """A local session for tests and the bench, with ``shared`` for hand-off tables."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("parcelworks")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach for hand-off tables.

    It is the session's ``spark.checkpoint.dir``; a session without one keeps them below its
    warehouse, which its executors share too. Both are the caller's to set, on any master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")
