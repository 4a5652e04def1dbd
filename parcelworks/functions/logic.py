"""Null-safe predicates, small arithmetic and helpers for expressions written as SQL text."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def quoted(name: str) -> str:
    """A column name as an identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float | int | None) -> str:
    """A double literal; ``None`` is a null double."""
    return "double(NULL)" if value is None else f"double('{value!r}')"


def in_list(values: Iterable[str]) -> str:
    return ", ".join(literal(value) for value in values)


def with_exprs(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Columns added or replaced by SQL expressions, all seeing the columns as they were."""
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def holds(predicate: str) -> str:
    """True only where the predicate is true; an unknown predicate counts as false."""
    return f"coalesce({predicate}, false)"


def any_of(predicates: Iterable[str]) -> str:
    return " OR ".join(f"({text})" for text in predicates) or "false"


def guarded_ratio(numerator: str, denominator: str) -> str:
    """Quotient where the denominator is positive, else null."""
    return f"CASE WHEN {denominator} > 0 THEN {numerator} / {denominator} END"


def year_month(date: str) -> str:
    return f"date_format({date}, 'yyyy-MM')"


def percent(part: str, whole: str, digits: int) -> str:
    """Share in percent, rounded half-even."""
    return f"bround({part} / {whole} * 100, {digits})"


def all_equal(left: Sequence[str], right: Sequence[str]) -> str:
    """Null-safe equality over two equally long lists."""
    return " AND ".join(f"{a} <=> {b}" for a, b in zip(left, right))


def rows_of(one_row: DataFrame, rows: Iterable[Sequence[str]], names: Sequence[str], *keep: str) -> DataFrame:
    """One row per tuple of expressions for each row of a small aggregate, after ``keep``."""
    structs = [
        "named_struct(" + ", ".join(f"{literal(name)}, {value}" for name, value in zip(names, row)) + ")"
        for row in rows
    ]
    return one_row.selectExpr(*keep, f"inline(array({', '.join(structs)}))")
