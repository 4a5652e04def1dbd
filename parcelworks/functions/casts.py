"""Lenient and strict casts, as SQL expressions that stay in generated code."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelworks import fixed
from parcelworks.functions.logic import in_list, literal, quoted, rows_of, with_exprs

SPACES = "'" + "".join(f"\\u{ord(space):04x}" for space in fixed.WHITESPACE) + "'"

BARE_TEXT = r"^[!-~](?s:.*[!-~])?\z"


def strip(text: str) -> str:
    """Trim every kind of white space, not only blanks."""
    return f"btrim({text}, {SPACES})"


def clean_text(column: str) -> str:
    """Trim; text that is then empty becomes null.

    Text that begins and ends with a visible ASCII character has nothing to trim; a pattern sees that
    in less than half the time of trying, and in so little code that wide rows are still compiled.
    """
    text = f"string({column})"
    return f"nullif(CASE WHEN {text} RLIKE r'{BARE_TEXT}' THEN {text} ELSE {strip(text)} END, '')"


def drop_nan(value: str) -> str:
    """A double with NaN turned into null, as every aggregate here expects."""
    return f"nanvl(double({value}), double(NULL))"


def parse_number(text: str) -> str:
    """Text to double; text that is no plain number becomes null."""
    trimmed = strip(text)
    return f"CASE WHEN {trimmed} RLIKE r'{fixed.NUMBER_PATTERN}' THEN try_cast({trimmed} AS double) END"


def has_time(fmt: str) -> bool:
    """Whether a datetime pattern has a time of day outside its quoted text."""
    return any(letter in part for part in fmt.split("'")[::2] for letter in "HhKkmsSan")


def parse_date(text: str, formats=fixed.DATE_FORMATS) -> str:
    """Text by the declared formats; anything else becomes null.

    The result is a date, or a timestamp without time zone as soon as a format has a time of day,
    so that whole days between two times are counted as such.
    """
    if any(map(has_time, formats)):
        tries = ", ".join(f"try_to_timestamp({strip(text)}, {literal(fmt)})" for fmt in formats)
        return f"CAST(coalesce({tries}) AS timestamp_ntz)"
    tries = ", ".join(f"try_to_date({strip(text)}, {literal(fmt)})" for fmt in formats)
    return f"coalesce({tries})"


def null_tokens(column: str, tokens=fixed.NULL_TOKENS) -> str:
    return f"CASE WHEN {column} NOT IN ({in_list(tokens)}) THEN {column} END"


def number_of(df: DataFrame, name: str) -> str:
    """Column ``name`` of ``df`` as a double, parsed only if it is text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_number(quoted(name))
    return drop_nan(quoted(name))


def typed_number(df: DataFrame, name: str) -> str:
    """As ``number_of``, for a typed column that ``coerce`` has freed of NaN."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_number(quoted(name))
    return f"double({quoted(name)})"


def date_of(df: DataFrame, name: str, formats=fixed.DATE_FORMATS) -> str:
    """Column ``name`` of ``df`` as a date, or as it is when it already carries a time."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return parse_date(quoted(name), formats)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return quoted(name)
    return f"date({quoted(name)})"


def elapsed_days(df: DataFrame, start: str, end: str) -> str:
    """Whole days from ``start`` to ``end``, rounded down; null if either is null."""
    kinds = {type(df.schema[name].dataType) for name in (start, end)}
    if kinds == {T.DateType}:
        return f"datediff({quoted(end)}, {quoted(start)})"
    times = [f"unix_micros(timestamp({quoted(name)}))" for name in (end, start)]
    return f"int(floor(({times[0]} - {times[1]}) / 86400000000))"


def coerce(df: DataFrame, numbers=(), dates=(), formats=fixed.DATE_FORMATS) -> DataFrame:
    """Replace the named columns by their lenient casts; absent columns are skipped."""
    casts = {name: number_of(df, name) for name in numbers if name in df.columns}
    casts |= {name: date_of(df, name, formats) for name in dates if name in df.columns}
    return with_exprs(df, casts)


def coercion_audit(
    df: DataFrame,
    dataset: str,
    columns,
    kind: str = "number",
    formats=fixed.DATE_FORMATS,
) -> DataFrame:
    """Missing before and after a lenient cast, one row per present column, one pass."""
    present = [name for name in columns if name in df.columns]
    label = {"number": "new_invalid_numeric_values", "date": "new_invalid_dates"}[kind]

    def cast(name: str) -> str:
        return number_of(df, name) if kind == "number" else date_of(df, name, formats)

    counts = df.selectExpr(
        *[f"count_if({missing(df, name)}) AS {quoted(name + ' before')}" for name in present],
        *[f"count_if(({cast(name)}) IS NULL) AS {quoted(name + ' after')}" for name in present],
    )
    rows = []
    for name in present:
        before, after = quoted(f"{name} before"), quoted(f"{name} after")
        rows.append((literal(dataset), literal(name), before, after, f"{after} - {before}"))
    return rows_of(counts, rows, ["dataset", "column", "missing_before", "missing_after", label])


def missing(df: DataFrame, name: str) -> str:
    """Null, or NaN in a floating-point column."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return f"{column} IS NULL OR isnan({column})"
    return f"{column} IS NULL"


STRICT_TYPES = {
    "string": "string",
    "date": "date",
    "integer": "bigint",
    "real": "double",
    "boolean": "boolean",
}


def strict(column: str, kind: str) -> str:
    """Typed value of non-empty text; null for empty text; an error for anything else."""
    text = f"nullif({column}, '')"
    trimmed = strip(text)
    word = f"lower({trimmed})"
    if kind == "string":
        return text
    # (text that qualifies, its value)
    accepted = {
        "date": (f"{text} RLIKE r'{fixed.ISO_DATE_PATTERN}'", f"try_cast({text} AS date)"),
        "integer": (f"{trimmed} RLIKE r'{fixed.INTEGER_PATTERN}'", f"try_cast({trimmed} AS bigint)"),
        "real": ("true", parse_number(text)),
        "boolean": (f"{word} IN ('true', 'false')", f"{word} = 'true'"),
    }
    if kind not in accepted:
        raise ValueError(f"unknown kind {kind!r}")
    qualifies, value = accepted[kind]
    complaint = f"raise_error(concat('not a valid {kind}: ', {text}))"
    return (
        f"CASE WHEN {text} IS NULL THEN NULL WHEN {qualifies} AND ({value}) IS NOT NULL THEN {value} "
        f"ELSE CAST({complaint} AS {STRICT_TYPES[kind]}) END"
    )


def whole_number(column: str) -> str:
    """A double holding a whole number as bigint; a fraction is an error."""
    complaint = f"raise_error(concat('not a whole number: ', string({column})))"
    return (
        f"CASE WHEN {column} IS NULL OR {column} = floor({column}) THEN bigint({column}) "
        f"ELSE CAST({complaint} AS bigint) END"
    )
