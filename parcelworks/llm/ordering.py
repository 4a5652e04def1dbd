"""A table in key order as numbered ranges of keys, each small enough for one task.

The cuts are a few numbers that come to the driver; rows are dealt by comparing their key with
the cuts, so a second run of a task, or of the whole plan, deals them alike.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.session import shared_folder


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that does not exist yet, below the one that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cuts(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending keys that split the table into ranges of similar size."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    row = df.select(
        F.percentile_approx(F.col(quoted(key)), shares, F.lit(max(1000, 20 * parts))).alias("at")
    ).first()
    return sorted(set(row["at"] or []))


def part_of(key: str, at: list[int]) -> Column:
    """Number of the range that a key lies in; a missing key lies in the first."""
    if not at:
        return F.lit(0)
    array = ", ".join(f"{cut}L" for cut in at)
    # keys up to and including a cut lie below it
    return F.expr(f"coalesce(size(filter(array({array}), cut -> cut < {quoted(key)})), 0)")
