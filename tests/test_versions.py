"""Versions of published tables: only changed months are written, and a version is seen whole or not at all."""

import pytest

from parcelworks.sources import versions

SCHEMA = "k string, m string, v double"


def table(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def seen(spark, root, **choice):
    return sorted(map(tuple, versions.read_version(spark, root, **choice).select("k", "m", "v").collect()), key=repr)


FIRST = [("a", "2024-01", 1.0), ("b", "2024-01", None), ("c", "2024-02", 2.0), ("d", None, 3.0), ("a", "2024-01", 1.0)]


def test_a_filled_month_is_all_that_is_written(spark, tmp_path):
    root = str(tmp_path)
    assert versions.publish(table(spark, *FIRST), root, "m") == 0
    assert seen(spark, root) == sorted(FIRST, key=repr)
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet") if "data" in p.parts}
    second = [*FIRST[:2], FIRST[4], ("c", "2024-02", 2.5), ("e", "2024-02", 4.0), ("d", None, 3.0), ("f", "2024-03", 5.0)]
    assert versions.publish(table(spark, *reversed(second)).repartition(3), root, "m") == 1
    assert seen(spark, root) == sorted(second, key=repr)
    assert {p: p.stat().st_mtime_ns for p in files} == files
    written = {p.parent.name for p in tmp_path.rglob("*.parquet") if "version=1" in str(p)}
    assert written == {"_month=2024-02", "_month=2024-03"}
    assert {r.month: r.version for r in versions.manifest(spark, root, 1).collect()} == {
        "2024-01": 0, "2024-02": 1, "2024-03": 1, None: 0,
    }
    assert seen(spark, root, version=0) == sorted(FIRST, key=repr)


def test_the_same_rows_make_no_version_and_a_lost_month_does(spark, tmp_path):
    root = str(tmp_path)
    versions.publish(table(spark, *FIRST), root, "m")
    assert versions.publish(table(spark, *FIRST).repartition(4), root, "m") == 0
    # one of two equal rows less is another table
    assert versions.publish(table(spark, *FIRST[:4]), root, "m") == 1
    assert versions.publish(table(spark, FIRST[2]), root, "m") == 2
    assert seen(spark, root) == [FIRST[2]]


def test_a_run_that_stops_before_the_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    versions.publish(table(spark, *FIRST), root, "m")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "_point", lambda *given: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            versions.publish(table(spark, ("z", "2024-02", 9.0)), root, "m")
    assert versions.versions(spark, root) == [0] and seen(spark, root) == sorted(FIRST, key=repr)
    # the next run takes the same number and overwrites what was left
    assert versions.publish(table(spark, ("y", "2024-05", 8.0)), root, "m") == 1
    assert seen(spark, root) == [("y", "2024-05", 8.0)]


def test_of_two_runs_at_once_one_fails(spark, tmp_path):
    root = str(tmp_path)
    versions.publish(table(spark, *FIRST), root, "m")
    with pytest.raises(versions.Conflict):
        versions._point(spark, root, 0)
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root, version=7)
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, str(tmp_path / "none"))


def test_only_the_months_asked_for_are_read(spark, tmp_path):
    root = str(tmp_path)
    versions.publish(table(spark, *FIRST), root, "m")
    versions.publish(table(spark, *FIRST, ("f", "2024-03", 5.0)), root, "m")
    assert seen(spark, root, months=["2024-03"]) == [("f", "2024-03", 5.0)]
    assert seen(spark, root, months=["2030-01"]) == []
    whole = versions.read_version(spark, root)
    assert len(whole.inputFiles()) >= 4
    plan = whole.filter("_month = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan
    some = spark.createDataFrame([("2024-02",)], "_month string").filter("_month > '2024-01'")
    joined = whole.join(some.hint("broadcast"), "_month")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert [r.k for r in joined.collect()] == ["c"]


def test_forgotten_versions_leave_what_later_ones_use(spark, tmp_path):
    root = str(tmp_path)
    versions.publish(table(spark, *FIRST), root, "m")
    later = [*FIRST[:2], ("c", "2024-02", 7.0)]
    versions.publish(table(spark, *later), root, "m")
    versions.forget_before(spark, root, 1)
    assert versions.versions(spark, root) == [1] and seen(spark, root) == sorted(later, key=repr)
    assert not (tmp_path / "data/version=0/_month=2024-02").exists()
