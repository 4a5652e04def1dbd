"""Identities of all events ever published, stored in buckets by identity, so that only new events are shuffled to meet them.

The store is a folder of Parquet files bucketed by the key. It is a set: adding identities again
changes nothing, and a run that stops while it adds leaves none or all of them. The number of
buckets is part of the folder's name, as files of another number cannot be read together.
"""

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from parcelworks.functions.logic import literal, quoted
from parcelworks.operators.events import DEDUPE_KEY, not_yet_published

#: each is read by one task, so choose more for more identities; a hundred million a bucket are a few gigabytes
BUCKETS = 64


def _table(spark: SparkSession, root: str, key: Sequence[str], buckets: int) -> str:
    """The store as a table of the session, under a name made of its folder."""
    folder = f"{root.rstrip('/')}/buckets-{buckets}"
    name = f"identities_{hashlib.md5(folder.encode()).hexdigest()}"
    columns, by = ", ".join(f"{quoted(one)} STRING" for one in key), ", ".join(map(quoted, key))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION {literal(folder)}"
    )
    # files that another session has added since
    spark.catalog.refreshTable(name)
    return name


def known(spark: SparkSession, root: str, key: Sequence[str] = DEDUPE_KEY, buckets: int = BUCKETS) -> DataFrame:
    """The stored identities, one row each; none are stored for a missing one."""
    return spark.table(_table(spark, root, key, buckets))


def fresh(events: DataFrame, root: str, key: Sequence[str] = DEDUPE_KEY, buckets: int = BUCKETS) -> DataFrame:
    """Events whose identity is not stored; those without identity stay.

    Events are shuffled to the buckets; the stored side is read bucket by bucket and not shuffled.
    """
    return not_yet_published(events, known(events.sparkSession, root, key, buckets), key)


def add(events: DataFrame, root: str, key: Sequence[str] = DEDUPE_KEY, buckets: int = BUCKETS) -> None:
    """Store the identities of ``events`` that are not stored yet, a file per bucket that gets any."""
    spark = events.sparkSession
    name = _table(spark, root, key, buckets)
    present = " AND ".join(f"{quoted(one)} IS NOT NULL" for one in key)
    new = fresh(events.filter(present).selectExpr(*[f"string({quoted(one)}) AS {quoted(one)}" for one in key]).distinct(), root, key, buckets)
    # rows go to the task of their bucket, so a task writes one file
    new.repartition(buckets, *key).write.insertInto(name)
