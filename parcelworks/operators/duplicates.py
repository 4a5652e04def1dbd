"""Columns that occur twice in a file: audit of the copies, recovery and removal.

Files with different headers are audited and merged apart, before they are united: a file's copies
say nothing about a file that has none.

Copies of a column ``X`` are named ``X.1``, ``X.2`` ... Reading the pairs off the header is
schema work; the audit of all pairs is one aggregation.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from parcelworks import fixed
from parcelworks.functions.casts import parse_number, strip
from parcelworks.functions.logic import holds, literal, quoted, rows_of
from parcelworks.operators.checks import CheckFailed

CLASSES = [
    "equivalent_rows",
    "canonical_only_rows",
    "duplicate_only_rows_recovered",
    "conflicting_non_null_rows_kept_canonical",
]


def copies(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(column, copy) pairs in column order."""
    pairs = []
    for name in columns:
        original, dot, number = name.rpartition(".")
        if dot and number.isdigit() and original in columns:
            pairs.append((original, name))
    return pairs


def _value_before(pairs: Sequence[tuple[str, str]], place: int) -> str:
    """The column as it stands once the copies before this one have filled its gaps."""
    original = pairs[place][0]
    earlier = [copy for name, copy in pairs[:place] if name == original]
    return f"coalesce({', '.join(quoted(name) for name in [original, *earlier])})"


def _same(left: str, right: str, numeric: bool) -> str:
    left, right = f"string({left})", f"string({right})"
    equal = holds(f"{strip(left)} = {strip(right)}")
    if numeric:
        equal += " OR " + holds(f"{parse_number(left)} = {parse_number(right)}")
    return f"({equal})"


def audit(
    df: DataFrame,
    dataset: str,
    numeric: Sequence[str] = fixed.NUMERIC_DUPLICATE_COLUMNS,
    month: str = "SourceMonth",
    file: str = "SourceFile",
) -> DataFrame:
    """Per file and pair, how the copy compares: four exclusive classes that add up to the rows."""
    pairs = copies(df.columns)
    if not pairs:
        raise ValueError(f"{dataset} has no repeated columns")
    counts, rows = ["count(*) AS rows_checked"], []
    for place, (original, copy) in enumerate(pairs):
        left, right = _value_before(pairs, place), quoted(copy)
        equal = _same(left, right, original in numeric)
        classes = [
            f"({left} IS NULL AND {right} IS NULL) OR {equal}",
            f"{left} IS NOT NULL AND {right} IS NULL",
            f"{left} IS NULL AND {right} IS NOT NULL",
            f"{left} IS NOT NULL AND {right} IS NOT NULL AND NOT {equal}",
        ]
        named = [f"{name}_{place}" for name in CLASSES]
        counts += [f"count_if({rule}) AS {name}" for rule, name in zip(classes, named)]
        rows.append((literal(original), literal(copy), "rows_checked", *named))
    per_file = df.groupBy(month, file).agg(*[F.expr(text) for text in counts])
    return rows_of(
        per_file,
        rows,
        ["original_column", "duplicate_column", "rows_checked", *CLASSES],
        f"{literal(dataset)} AS dataset",
        f"{quoted(month)} AS source_month",
        f"{quoted(file)} AS source_file",
    )


def audit_files(frames: Sequence[DataFrame], dataset: str, numeric: Sequence[str] = fixed.NUMERIC_DUPLICATE_COLUMNS) -> DataFrame | None:
    """``audit`` of each frame that has copies; None if none has any."""
    audits = [audit(frame, dataset, numeric) for frame in frames if copies(frame.columns)]
    return reduce(DataFrame.unionByName, audits) if audits else None


def merged_files(frames: Sequence[DataFrame]) -> DataFrame:
    """``merged`` frames, united by column name."""
    parts = [merged(frame) if copies(frame.columns) else frame for frame in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def audit_totals(audited: DataFrame) -> DataFrame:
    """Distinct pairs, conflicts kept and values recovered over all files."""
    return audited.selectExpr(
        "count(DISTINCT original_column, duplicate_column) AS duplicate_pairs",
        "sum(conflicting_non_null_rows_kept_canonical) AS conflicts_kept",
        "sum(duplicate_only_rows_recovered) AS values_recovered",
    )


def merged(df: DataFrame) -> DataFrame:
    """Gaps filled from the copies in their order, and the copies gone."""
    pairs = copies(df.columns)
    dropped = {copy for _, copy in pairs}
    fills = {}
    for place, (original, copy) in enumerate(pairs):
        fills[original] = f"coalesce({_value_before(pairs, place)}, {quoted(copy)})"
    result = df.selectExpr(
        *[
            f"{fills.get(name, quoted(name))} AS {quoted(name)}"
            for name in df.columns
            if name not in dropped
        ]
    )
    left = copies(result.columns)
    if left:
        raise CheckFailed(f"duplicate columns remain: {[copy for _, copy in left]}")
    return result
