"""Steps that grow with the tables: what they send, sort and read, and that they give the rows of before."""

import numpy as np
from pyspark.sql import functions as F

from parcelworks import fixed
from parcelworks.functions.casts import clean_text
from parcelworks.operators import events
from parcelworks.operators.quantiles import long_values, quantiles, with_field
from parcelworks.plans import stages
from parcelworks.streaming import firsts

SALE_INPUTS = ["ListingKey", "ListAgentFullName", "ListOfficeName", "BuyerOfficeName", *fixed.DIMENSION_COLUMNS]
NUMBERS = ["ClosePrice", "DaysOnMarket", "CloseToOriginalListRatio", "PricePerSqFt", "rate_30yr_fixed"]
SALES = "EventId string, SourceMonth string, price double, note string"


def test_first_rows_on_a_stream_are_an_aggregation(spark, tmp_path):
    """One Python call per identity took longer than the limit at a gigabyte."""
    source = str(tmp_path / "in")
    deliveries = [
        [("a", "202402", 1.0, "late"), ("b", "202401", None, "only"), (None, "202401", 2.0, "none")],
        [("a", "202401", 9.0, "early"), ("b", "202403", 0.0, "later"), (None, "202401", 2.0, "none")],
    ]
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for rows in deliveries:
        spark.createDataFrame(rows, SALES).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SALES).parquet(source)
        plan = firsts.first_on_stream(stream, ["EventId"], ["SourceMonth", "price"])._jdf.queryExecution().toString()
        assert "Pandas" not in plan and "Python" not in plan
        firsts.land_first(stream, path, checkpoint, ["EventId"], ["SourceMonth", "price"]).awaitTermination()
    found = {row.EventId: row.note for row in firsts.landed_first(spark, path, SALES, ["EventId"]).collect()}
    assert found == {"a": "early", "b": "only", None: "none"}
    # rows that change nothing go no further, nor do equal ones
    sent = spark.read.parquet(path).filter("batch = 1").select(F.col("event.note"), "correction").collect()
    assert [tuple(row) for row in sent] == [("early", 1)]


def test_text_is_trimmed_as_before(spark):
    spaces = [chr(code) for code in (9, 10, 11, 12, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2029, 0x3000)]
    texts = [None, "", "a", "a b", "~", "é", "aé", "a\nb", "a\n", " a b　", *spaces, *[f"a{one}" for one in spaces], *[f"{one}a" for one in spaces]]
    table = spark.createDataFrame([(one,) for one in texts], "t string")
    found = [row[0] for row in table.selectExpr(clean_text("t")).collect()]
    assert found == [one.strip(fixed.WHITESPACE) or None if one is not None else None for one in texts]


def test_generated_code_of_wide_rows_is_compiled(spark):
    """A method of 8,000 bytes or more is interpreted by the JVM, several times slower."""
    columns = [*SALE_INPUTS, "ListAgentFirstName", "ListAgentLastName", *NUMBERS, "CloseDate", "SourceMonth"]
    kinds = {name: "double" for name in NUMBERS} | {"CloseDate": "date"}
    schema = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in dict.fromkeys(columns))
    kept = spark.range(10).selectExpr("id").crossJoin(spark.createDataFrame([], schema))
    plan = stages.sales_table(kept, (0.5, 2.0))._jdf.queryExecution().executedPlan().toString()
    # the names of sellers are made after the rows are chosen
    assert plan.index("ListOfficeName", 0) < plan.index("WindowGroupLimit")
    before = plan[plan.index("WindowGroupLimit") :]
    assert "RLIKE" in before and "concat_ws" not in before


def test_quartiles_look_bins_up_by_hash(spark, tmp_path):
    """All values met the located bins by their field's text before."""
    rows = [(float(n % 97) * 1.7 ** (n % 5), float(n)) for n in range(2000)] + [(None, -0.0), (-3.5, 1e300), (5e-324, 1e-7)]
    spark.createDataFrame(rows, "a double, b double").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    found = quantiles(long_values(table, ["a", "b"]), {"q1": 0.25, "q3": 0.75})
    for row in found.collect():
        values = [one for one in (r["ab".index(row.field)] for r in rows) if one is not None]
        assert row.n == len(values) and [row.q1, row.q3] == [float(np.quantile(values, p)) for p in (0.25, 0.75)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [xxhash64(field" in plan and "BroadcastHashJoin [coalesce(field" not in plan
    with_fields = long_values(table, ["a", "b"])
    ends = spark.createDataFrame([("a", 1.0)], "field string, low double")
    assert {row.low for row in with_field(with_fields, ends).collect()} == {1.0}
    assert {(row.field, row.low) for row in with_field(with_fields, ends, "LEFT").collect()} == {("a", 1.0), ("b", None)}


def test_first_rows_of_identities_are_sorted_by_hash(spark):
    rows = [("s", "x", 2), ("s", "x", 1), ("t", None, 5), ("t", None, 4), (None, None, 3)]
    table = spark.createDataFrame(rows, "k string, id string, n int")
    first = events.first_of_each(table, ["k", "id"], ["n"])
    assert {tuple(row) for row in first.collect()} == {("s", "x", 1), ("t", None, 4), (None, None, 3)}
    assert "xxhash64" in first._jdf.queryExecution().executedPlan().toString()
