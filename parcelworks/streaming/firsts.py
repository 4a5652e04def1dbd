"""The first row of every identity on a stream, as the batch keeps it, whatever order rows arrive in.

State holds, per identity, the first row so far in the total order, as a streaming aggregation. A row
that comes before it takes its place and goes out as a correction, numbered above what it corrects;
all others go no further. The table of what went out has, per identity, its highest correction as
the row of the batch.
"""

import threading
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelworks.functions.logic import literal, quoted
from parcelworks.operators.events import DEDUPE_KEY

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ORDERED = ("tinyint", "smallint", "int", "bigint", "string", "date", "timestamp", "float", "double")
_setting = threading.Lock()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state on disk; the session's own setting comes back after."""
    with _setting:
        before = spark.conf.get(STATE_STORE, None)
        spark.conf.set(STATE_STORE, ROCKS_DB)
        try:
            yield
        finally:
            spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def place_in_order(df: DataFrame, order: Sequence[str]) -> str:
    """SQL text of a struct that sorts as the columns do, missing values first, as in the batch."""
    for name in order:
        kind = df.schema[name].dataType.simpleString()
        if kind not in ORDERED:
            raise ValueError(f"rows cannot be put in order by {name}, which is {kind}")
    return _struct({f"p{i}": quoted(name) for i, name in enumerate(order)})


def _struct(fields: Mapping[str, str]) -> str:
    return "named_struct(" + ", ".join(f"{literal(name)}, {value}" for name, value in fields.items()) + ")"


def first_on_stream(events: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(event, is_new) of each row that is the first of its identity when it arrives.

    ``event`` is the row as a struct, ``is_new`` says that its identity has not been seen before. A
    missing identity is one identity. A micro-batch sends one row per identity at most, and each task
    sends one row per identity to the state. A place ends with the time of its micro-batch, so a row
    has changed if that is the time of this one, and of equal places the one that came before stays.
    """
    groups = [f"k{i}" for i in range(len(key))]
    rest = [name for name in events.columns if name not in key and name not in order]
    placed = events.selectExpr(
        # rows are sorted by their identity, and hashes are faster to compare
        f"xxhash64({', '.join(map(quoted, key))}) AS h",
        *[f"{quoted(name)} AS k{i}" for i, name in enumerate(key)],
        f"named_struct('place', {place_in_order(events, order)}, 'arrived', current_timestamp()) AS place",
        f"{_struct({'r': 'true'} | {f'r{i}': quoted(name) for i, name in enumerate(rest)})} AS rest",
        "current_timestamp() AS arrived",
    )
    first = placed.groupBy("h", *groups).agg(
        F.expr("min(place) AS place"), F.expr("min_by(rest, place) AS rest"), F.expr("min(arrived) AS seen")
    )
    found = {name: f"k{i}" for i, name in enumerate(key)}
    found = {name: f"place.place.p{i}" for i, name in enumerate(order)} | found | {name: f"rest.r{i}" for i, name in enumerate(rest)}
    event = _struct({name: found[name] for name in events.columns})
    return first.filter("place.arrived = current_timestamp()").selectExpr(
        f"{event} AS event", "seen = current_timestamp() AS is_new"
    )


def land_first(
    events: DataFrame, path: str, checkpoint: str, key: Sequence[str] = DEDUPE_KEY, order: Sequence[str] = ("SourceMonth",)
) -> StreamingQuery:
    """Land the first rows of everything that has arrived; then stop. ``landed_first`` reads them.

    The first row of an identity is correction 0, each later one has the number of its batch. A batch
    that is run again overwrites its own folder with the same rows.
    """

    def add(batch: DataFrame, number: int) -> None:
        numbered = batch.selectExpr("event", f"CASE WHEN is_new THEN 0L ELSE {number}L END AS correction")
        numbered.write.mode("overwrite").parquet(f"{path}/batch={number}")

    with state_on_disk(events.sparkSession):
        return (
            first_on_stream(events, key, order)
            .writeStream.outputMode("update")
            .foreachBatch(add)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def landed_first(spark: SparkSession, path: str, schema, key: Sequence[str] = DEDUPE_KEY) -> DataFrame:
    """The first row of every identity so far, in the columns of ``schema``."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    stored = T.StructType().add("event", kinds).add("correction", "long").add("batch", "long")
    landed = spark.read.schema(stored).parquet(path)
    keys = [f"event.{quoted(name)}" for name in key]
    latest = landed.groupBy(F.expr(f"xxhash64({', '.join(keys)})").alias("h"), *[F.col(one).alias(f"k{i}") for i, one in enumerate(keys)]).agg(
        F.expr("max_by(event, correction) AS event")
    )
    return latest.select("event.*")
