"""Writers for stage tables and the published extract."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, functions as F

from parcelworks import fixed
from parcelworks.functions.casts import whole_number
from parcelworks.functions.logic import quoted


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Overwrite ``path`` with Parquet and return the stored table.

    With a partition column the rows are rebalanced on it first: one or few files per value,
    while a value holding much of the data is split over several tasks.
    """
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*map(quoted, df.columns))


def write_observed(
    df: DataFrame, path: str, totals: Mapping[str, str], partition_by: str | None = None
) -> tuple[DataFrame, dict[str, int | None]]:
    """``write_table`` that also returns aggregates of the rows, taken while they are written.

    They are observed in the tasks that write, each of which counts once however often it is tried.
    A plan that is found empty before it runs observes nothing; then the stored table is asked.
    """
    seen = Observation()
    chosen = [F.expr(f"bigint({text})").alias(name) for name, text in totals.items()]
    rows = df.hint("rebalance", partition_by) if partition_by else df
    writer = rows.observe(seen, *chosen).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path).select(*map(quoted, df.columns))
    found = seen.get
    if set(found) != set(totals):
        found = stored.select(*chosen).first().asDict()
    return stored, {name: found[name] for name in totals}


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with CSV part files, each with a header."""
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def publishable(events: DataFrame, identifiers=fixed.DIRECT_IDENTIFIERS) -> DataFrame:
    """The event table in its declared types, without the direct identifiers."""
    types = {"string": "string", "date": "date", "real": "double", "boolean": "boolean"}

    def typed(name: str, kind: str) -> str:
        value = whole_number(name) if kind == "integer" else f"CAST({name} AS {types[kind]})"
        return f"{value} AS {name}"

    return events.selectExpr(
        *[typed(name, kind) for name, kind in fixed.EVENT_SCHEMA.items() if name not in identifiers]
    )
