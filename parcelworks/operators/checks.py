"""Quality gates. A gate is rows (check, observed, expected, passed); ``enforce`` raises on failure.

The pairs of aggregates behind a gate (``category_checks`` and its like) may also be observed while
their table is written, see ``sinks.write_observed``; ``enforce_observed`` takes what was seen.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from parcelworks import fixed
from parcelworks.functions.casts import clean_text
from parcelworks.functions.logic import any_of, literal, quoted, rows_of

#: name: (observed aggregate, expected aggregate)
Checks = dict[str, tuple[str, str]]
CHECK_COLUMNS = ["check", "observed", "expected", "passed"]


class CheckFailed(ValueError):
    """At least one check row did not pass."""


def check_rows(df: DataFrame, checks: Checks) -> DataFrame:
    """All checks ``name: (observed aggregate, expected aggregate)`` of one input, in one pass."""
    totals = df.selectExpr(
        *[f"bigint({observed}) AS observed{place}" for place, (observed, _) in enumerate(checks.values())],
        *[f"bigint({expected}) AS expected{place}" for place, (_, expected) in enumerate(checks.values())],
    )
    rows = [
        (literal(name), f"observed{place}", f"expected{place}", f"observed{place} <=> expected{place}")
        for place, name in enumerate(checks)
    ]
    return rows_of(totals, rows, CHECK_COLUMNS)


def enforce(*checks: DataFrame) -> None:
    """Raise with every check row that did not pass."""
    failed = reduce(lambda a, b: a.unionByName(b), checks).filter("NOT passed").collect()
    if failed:
        raise CheckFailed(
            "; ".join(f"{row.check}: observed {row.observed}, expected {row.expected}" for row in failed)
        )


def enforce_observed(seen: Mapping[str, tuple[int | None, int | None]]) -> None:
    """Raise with every check, name: (observed, expected), whose numbers differ."""
    failed = [f"{name}: observed {found}, expected {wanted}" for name, (found, wanted) in seen.items() if found != wanted]
    if failed:
        raise CheckFailed("; ".join(failed))


def category_checks(
    dataset: str,
    column: str = fixed.CATEGORY_COLUMN,
    value: str = fixed.CATEGORY,
    trimmed: bool = False,
    among: str = "true",
) -> Checks:
    """Every present value of the column is ``value``, and there is at least one, in rows for which ``among`` holds."""
    held = clean_text(quoted(column)) if trimmed else quoted(column)
    return {
        f"{dataset} rows of another {column}": (f"count_if(({among}) AND {held} <> {literal(value)})", "0"),
        f"{dataset} has a {value} row": (f"coalesce(max(int(({among}) AND {held} = {literal(value)})), 0)", "1"),
    }


def only_category(
    df: DataFrame,
    dataset: str,
    column: str = fixed.CATEGORY_COLUMN,
    value: str = fixed.CATEGORY,
    trimmed: bool = False,
) -> DataFrame:
    """Every present value of the column is ``value``, and there is at least one."""
    return check_rows(df, category_checks(dataset, column, value, trimmed))


def rule_checks(dataset: str, predicates: Sequence[str]) -> Checks:
    return {f"{dataset} rows breaking a rule": (f"count_if({any_of(predicates)})", "0")}


def no_rule_broken(df: DataFrame, dataset: str, predicates: Sequence[str]) -> DataFrame:
    """No row of a cleaned table still breaks a removal rule."""
    return check_rows(df, rule_checks(dataset, predicates))


def date_checks(dataset: str, column: str, among: str = "true") -> Checks:
    return {f"{dataset} rows without {column}": (f"count_if(({among}) AND {quoted(column)} IS NULL)", "0")}


def dates_present(df: DataFrame, dataset: str, column: str) -> DataFrame:
    """The date is never missing."""
    return check_rows(df, date_checks(dataset, column))


def same_row_count(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Two tables have equally many rows."""
    sides = left.selectExpr("1 AS side").unionByName(right.selectExpr("2 AS side"))
    return check_rows(sides, {name: ("count_if(side = 1)", "count_if(side = 2)")})


def unique_key(df: DataFrame, name: str, *key: str) -> DataFrame:
    """No key value occurs twice, so that a join on it keeps the number of left rows."""
    return check_rows(df.groupBy(*key).count(), {name: ("count_if(count > 1)", "0")})


def require_columns(df: DataFrame, names: Sequence[str], dataset: str) -> DataFrame:
    """``df`` itself if it has every named column; reads no data."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise CheckFailed(f"{dataset} is missing required columns: {absent}")
    return df


def require_header(found: Sequence[str], expected: Sequence[str]) -> None:
    """The header has exactly the expected names in the expected order."""
    if list(found) != list(expected):
        raise CheckFailed(f"header {list(found)} does not match {list(expected)}")
