"""Measures for any choice of slicers from one stored table of mergeable counts, without the events.

Events are gone through once: each counts towards every stored set of slicers (grouping sets), per
month of the event date and whether it is a closed sale. A set's table has sums, which add up over
the chosen values, and another has counted prices, from which medians of any union are exact. A
choice is answered by the smallest stored set that has the columns it names, and sets are folders,
so no other is read. By default no slicer, each one alone and all together are stored; a finest
row for every event at worst, so the tables are at most as many times the events as there are sets.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks import fixed
from parcelworks.functions.logic import literal, quoted
from parcelworks.operators.market import MEASURES, sliced
from parcelworks.operators.quantiles import quantiles

MONTH = "trunc(EventDate, 'month')"
KEYS = ["EventMonth", "closed"]
# name: (sum over events, type)
SUMS = {
    "NewListings": ("sum(NewListings)", "long"),
    "ClosedSales": ("sum(ClosedSales)", "long"),
    "DaysOnMarket_sum": ("sum(double(DaysOnMarket))", "double"),
    "DaysOnMarket_count": ("count(DaysOnMarket)", "long"),
    "CloseToOriginalListRatio_sum": ("sum(double(CloseToOriginalListRatio))", "double"),
    "CloseToOriginalListRatio_count": ("count(CloseToOriginalListRatio)", "long"),
}


def default_sets(slicers: Sequence[str]) -> list[tuple[str, ...]]:
    return [(), *[(name,) for name in slicers], tuple(slicers)]


def store_lattice(
    events: DataFrame,
    path: str,
    slicers: Sequence[str] = fixed.SLICER_COLUMNS,
    sets: Sequence[Sequence[str]] | None = None,
) -> None:
    """Write ``path/sums`` and ``path/prices`` of the sets, each one a folder.

    Missing slicer values are values of their own, told apart from a column that a set leaves out.
    """
    chosen = [tuple(one) for one in (default_sets(slicers) if sets is None else sets)]
    chosen = list(dict.fromkeys(tuple(name for name in slicers if name in one) for one in chosen))
    base = events.selectExpr(
        f"{MONTH} AS EventMonth",
        f"EventType <=> {literal(fixed.CLOSED_SALE)} AS closed",
        *map(quoted, slicers),
        *dict.fromkeys(column for column, _, _ in MEASURES.values()),
    )
    _write_sets(base, f"{path}/sums", slicers, chosen, [], {name: text for name, (text, _) in SUMS.items()})
    prices = base.filter("closed AND ClosePrice IS NOT NULL").withColumn("price", F.expr("double(ClosePrice)"))
    _write_sets(prices, f"{path}/prices", slicers, chosen, ["price"], {"rows": "count(*)"})


def _write_sets(
    base: DataFrame,
    path: str,
    slicers: Sequence[str],
    sets: Sequence[tuple[str, ...]],
    more: Sequence[str],
    sums: Mapping[str, str],
) -> None:
    always = [*KEYS, *more]
    listed = ", ".join("(" + ", ".join(map(quoted, [*always, *one])) + ")" for one in sets)
    totals = ", ".join(f"{text} AS {name}" for name, text in sums.items())
    columns = ", ".join(map(quoted, [*always, *slicers]))
    grouped = base.sparkSession.sql(
        f"""SELECT {columns}, {totals}, grouping_id() AS _set FROM {{base}}
        GROUP BY {columns} GROUPING SETS ({listed})""",
        base=base,
    )
    grouped.hint("rebalance", "_set").write.mode("overwrite").partitionBy("_set").parquet(path)


def set_number(slicers: Sequence[str], used: Sequence[str]) -> int:
    """``grouping_id`` of a set: a bit for each slicer that it leaves out, the first one highest."""
    return sum(1 << (len(slicers) - 1 - place) for place, name in enumerate(slicers) if name not in used)


def _stored(spark: SparkSession, path: str, slicers: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    named = ", ".join(f"{quoted(name)} {kind}" for name, kind in kinds.items())
    texts = ", ".join(f"{quoted(name)} string" for name in slicers)
    return spark.read.schema(f"EventMonth date, closed boolean, {texts}, {named}, _set long").parquet(path)


def covering(stored: Sequence[int], slicers: Sequence[str], wanted: Sequence[str]) -> int:
    """The stored set with the fewest columns among those that have all the wanted ones."""
    absent = sorted(set(wanted) - set(slicers))
    if absent:
        raise ValueError(f"no slicers: {absent}")
    needed = set_number(slicers, wanted)
    fitting = [one for one in stored if one & ~needed == 0]
    if not fitting:
        raise ValueError(f"no stored set of slicers has {list(wanted)}")
    return max(fitting, key=lambda one: (one.bit_count(), one))


def _sets_at(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the stored sets, from the names of their folders."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_set=*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(one.getPath().getName().split("=")[1]) for one in found or [])


def lattice_measure(
    spark: SparkSession,
    path: str,
    name: str,
    chosen: Mapping[str, Sequence[str]] = {},
    slicers: Sequence[str] = fixed.SLICER_COLUMNS,
) -> DataFrame:
    """``market.measure_series`` of one of ``MEASURES`` for a choice of slicer values, from the stored tables alone."""
    column, aggregation, closed_only = MEASURES[name]
    at = _sets_at(spark, f"{path}/sums")
    if not at:
        # no events: no months
        return spark.createDataFrame([], f"EventMonth date, {column} {'long' if aggregation == 'sum' else 'double'}")
    number = covering(at, slicers, list(chosen))

    def of(table: str, kinds: Mapping[str, str]) -> DataFrame:
        rows = _stored(spark, f"{path}/{table}", slicers, kinds).filter(f"_set = {number}")
        return sliced(rows.filter("closed") if closed_only else rows, chosen)

    sums = of("sums", {key: kind for key, (_, kind) in SUMS.items()})
    if aggregation == "sum":
        return sums.groupBy("EventMonth").agg(F.expr(f"coalesce(sum({column}), 0L) AS {column}"))
    if aggregation == "average":
        mean = f"sum({column}_sum) / nullif(sum({column}_count), 0) AS {column}"
        return sums.groupBy("EventMonth").agg(F.expr(mean))
    months = sums.select("EventMonth").distinct()
    if number not in _sets_at(spark, f"{path}/prices"):
        return months.selectExpr("EventMonth", f"double(NULL) AS {column}")
    prices = of("prices", {"price": "double", "rows": "long"})
    values = prices.groupBy("EventMonth", F.lit(column).alias("field"), F.col("price").alias("value")).agg(
        F.expr("sum(rows) AS rows")
    )
    medians = quantiles(values, {column: 0.5}, ["EventMonth"], broadcast=True)
    return months.alias("m").join(medians.alias("q"), F.expr("m.EventMonth <=> q.EventMonth"), "left").selectExpr(
        "m.EventMonth", f"q.{column}"
    )
