"""Identities ever published meet new events without a shuffle of their own; months are read by folder."""

import pytest

from parcelworks.operators import market
from parcelworks.plans import monthly_run
from parcelworks.sources import identities, versions

SCHEMA = "EventId string, SourceDataset string, YrMo string, ClosePrice double"


def table(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, root, buckets=4):
    return sorted(map(tuple, identities.known(spark, root, buckets=buckets).collect()))


def test_the_store_is_a_set_without_missing_identities(spark, tmp_path):
    root = str(tmp_path / "it's")
    rows = [("a", "sold", "m", 1.0), ("a", "sold", "m", 2.0), ("a", "listing", "m", 1.0), (None, "sold", "m", 1.0)]
    identities.add(table(spark), root, buckets=4)
    assert stored(spark, root) == []
    for _ in range(2):
        identities.add(table(spark, *rows), root, buckets=4)
        assert stored(spark, root) == [("listing", "a"), ("sold", "a")]
    given = table(spark, *rows, ("b", "sold", "m", 5.0), ("a", None, "m", 6.0))
    found = identities.fresh(given, root, buckets=4).collect()
    assert sorted(r.ClosePrice for r in found) == [1.0, 5.0, 6.0]


def test_stored_identities_are_found_by_another_session(spark, tmp_path):
    root = str(tmp_path)
    identities.add(table(spark, ("a", "sold", "m", 1.0)), root, buckets=4)
    for one in spark.catalog.listTables():
        if one.name.startswith("identities_"):
            # the session's name for an external folder; its files stay
            spark.sql(f"DROP TABLE {one.name}")
    assert stored(spark, root) == [("sold", "a")]
    identities.add(table(spark, ("a", "sold", "m", 1.0), ("b", "sold", "m", 1.0)), root, buckets=4)
    assert stored(spark, root) == [("sold", "a"), ("sold", "b")]


@pytest.mark.parametrize("size", [40, 400])
def test_only_the_new_side_is_shuffled(spark, tmp_path, size):
    root = str(tmp_path)
    for part in range(2):
        rows = [(str(n), "sold", "m", 1.0) for n in range(part, size, 3)]
        identities.add(table(spark, *rows), root, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = identities.fresh(table(spark, *[(str(n), "sold", "m", 1.0) for n in range(size)]), root, buckets=4)
        assert sorted(int(r.EventId) for r in found.collect()) == list(range(2, size, 3))
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_an_event_that_comes_back_is_not_new_and_a_stopped_run_loses_none(spark, tmp_path, monkeypatch):
    root, reports = str(tmp_path), {}

    def published(*rows):
        given = table(spark, *rows)
        monthly_run.publish_events(spark, given, given.drop("EventId"), root, reports.__setitem__)
        return sorted((r.YrMo, r.new_events) for r in reports["newly_published"].collect())

    a, b, c = ("a", "sold", "2024-01", 1.0), ("b", "sold", "2024-02", 2.0), ("c", "sold", "2024-03", 3.0)
    assert published(a, b) == [("2024-01", 1), ("2024-02", 1)]
    # stops after the version is out and before anything is reported
    with monkeypatch.context() as patch:
        patch.setattr(identities, "fresh", lambda *given: (_ for _ in ()).throw(KeyboardInterrupt))
        patch.setattr(identities, "add", lambda *given: None)
        with pytest.raises(KeyboardInterrupt):
            published(a, b, c)
    assert published(a, c) == []
    assert published(a, b, c) == []


def test_a_window_of_months_reads_its_folders_only(spark, tmp_path):
    schema = "YrMo string, EventDate date, EventType string, City string, ClosePrice double"
    rows = [(f"2024-{m:02}", f"2024-{m:02}-0{d}", "Closed Sale", "AB"[d % 2], float(m * d)) for m in range(1, 7) for d in range(1, 6)]
    values = ", ".join(f"('{a}', date'{b}', '{c}', '{d}', {e}D)" for a, b, c, d, e in rows)
    given = spark.sql(f"SELECT * FROM VALUES {values}, (NULL, NULL, 'Closed Sale', 'A', 9D) AS t({', '.join(f.split()[0] for f in schema.split(', '))})")
    root = str(tmp_path)
    versions.publish(given, root, "YrMo")
    name = "measure_median_close_price"
    found = market.published_measure(spark, root, name, {"City": ["B"]}, "2024-02", "2024-04")
    assert sorted((r.EventMonth.month, r.ClosePrice) for r in found.collect()) == [(2, 6.0), (3, 9.0), (4, 12.0)]
    scan = versions.read_version(spark, root).filter("_month >= '2024-02' AND _month <= '2024-04'")
    assert {path.split("_month=")[1].split("/")[0] for path in scan.selectExpr("input_file_name() AS f").toPandas()["f"]} == {
        "2024-02", "2024-03", "2024-04",
    }
    # all conditions on months are left to the choice of folders
    plan = found._jdf.queryExecution().optimizedPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan
    assert market.published_measure(spark, root, name, {}, "2025-01").collect() == []
    assert market.published_measure(spark, root, name, {}, last="2024-01").count() == 1
