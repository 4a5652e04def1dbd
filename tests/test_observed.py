"""Gates whose numbers are observed while their table is written."""

import pytest

from parcelworks.operators import checks
from parcelworks.sources.sinks import write_observed

SCHEMA = "PropertyType string, CloseDate date, YrMo string, excluded boolean, ClosePrice double, LivingArea double"
GOOD = [("Residential", "2024-01-05", "2024-01", False, 5.0, 1.0), ("Residential", "2024-02-05", "2024-02", True, 0.0, 2.0)]


def table(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA.replace("CloseDate date", "CloseDate string"))
    return frame.selectExpr("* EXCEPT (CloseDate)", "date(CloseDate) AS CloseDate")


@pytest.mark.parametrize("partition_by", [None, "YrMo"])
def test_totals_are_those_of_the_stored_rows(spark, tmp_path, partition_by):
    df = table(spark, GOOD * 50).repartition(7)
    stored, seen = write_observed(
        df, str(tmp_path / "t"), {"rows": "count(*)", "kept": "count_if(NOT excluded)", "none": "sum(CASE WHEN false THEN 1 END)"}, partition_by
    )
    assert seen == {"rows": 100, "kept": 50, "none": None}
    assert stored.columns == df.columns and sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))


def test_an_empty_table_is_observed_too(spark, tmp_path):
    for number, df in enumerate([table(spark, GOOD).filter("false"), table(spark, []), table(spark, GOOD).filter("ClosePrice > 9")]):
        _, seen = write_observed(df, str(tmp_path / f"t{number}"), {"rows": "count(*)", "sum": "sum(ClosePrice)"})
        assert seen == {"rows": 0, "sum": None}


def test_totals_cost_no_job_of_their_own(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()

    def jobs_of(label, write):
        spark.sparkContext.setJobGroup(label, label)
        write()
        spark.sparkContext.setJobGroup("tests", "tests")
        return len(tracker.getJobIdsForGroup(label))

    df = table(spark, GOOD)
    plain = jobs_of("plain write", lambda: df.write.parquet(str(tmp_path / "a")))
    assert jobs_of("observed write", lambda: write_observed(df, str(tmp_path / "b"), {"rows": "count(*)"})) == plain


KEPT = "NOT excluded"


@pytest.mark.parametrize(
    "gates, bad, message",
    [
        (checks.category_checks("sold"), ("Land", "2024-01-05", "2024-01", True, 5.0, 1.0), "sold rows of another PropertyType: observed 1"),
        (checks.category_checks("kept", trimmed=True, among=KEPT), (" Land ", "2024-01-05", "2024-01", False, 5.0, 1.0), "kept rows of another"),
        (checks.date_checks("sold", "CloseDate", KEPT), ("Residential", None, "2024-01", False, 5.0, 1.0), "without CloseDate: observed 1"),
        (checks.rule_checks("sold", ["ClosePrice < 0"]), ("Residential", "2024-01-05", "2024-01", True, -1.0, 1.0), "breaking a rule: observed 1"),
    ],
)
def test_each_gate_fails_on_a_bad_row_and_only_then(spark, tmp_path, gates, bad, message):
    def judge(rows, name):
        asked = {f"{side}{place}": text for place, pair in enumerate(gates.values()) for side, text in zip("oe", pair)}
        _, seen = write_observed(table(spark, rows), str(tmp_path / name), asked)
        checks.enforce_observed({gate: (seen[f"o{place}"], seen[f"e{place}"]) for place, gate in enumerate(gates)})

    judge(GOOD, "good")
    # rows that a gate does not look at
    if KEPT in str(gates):
        judge([*GOOD, (*bad[:3], True, *bad[4:])], "other")
    with pytest.raises(checks.CheckFailed, match=message):
        judge([*GOOD, bad], "bad")


def test_a_table_without_the_category_fails(spark, tmp_path):
    gates = checks.category_checks("sold")
    _, seen = write_observed(table(spark, []), str(tmp_path / "t"), {"o": gates["sold has a Residential row"][0]})
    with pytest.raises(checks.CheckFailed, match="has a Residential row: observed 0, expected 1"):
        checks.enforce_observed({"sold has a Residential row": (seen["o"], 1)})
