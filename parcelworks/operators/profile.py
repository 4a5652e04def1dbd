"""Profiles: missing values, numeric summaries, outlier counts, histogram and box statistics."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from parcelworks import fixed
from parcelworks.functions.casts import missing, number_of
from parcelworks.functions.logic import holds, literal, percent, quoted, rows_of
from parcelworks.operators.quantiles import long_values, quantiles, with_field


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing count and percent of every column, from one pass over the table."""
    names = {name: f"missing{place}" for place, name in enumerate(df.columns)}
    counts = df.selectExpr(
        "count(*) AS total", *[f"count_if({missing(df, name)}) AS {count}" for name, count in names.items()]
    )
    rows = [(literal(name), count, percent(count, "total", 2)) for name, count in names.items()]
    return rows_of(counts, rows, ["column", "Missing Count", "Missing %"]).orderBy(
        F.desc("Missing %"), "column"
    )


def high_missing(summary: DataFrame, above: float = fixed.HIGH_MISSING_PERCENT) -> DataFrame:
    """Columns whose rounded missing percent lies above the limit."""
    return summary.filter(f"`Missing %` > {above}")


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    names = [name for name in columns if name in df.columns]
    if not names:
        raise ValueError("none of the requested columns exist")
    return names


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str] = fixed.PROFILE_COLUMNS,
    percentiles: Mapping[str, float] = fixed.PROFILE_PERCENTILES,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact percentiles of the available columns."""
    names = _present(df, columns)
    values = df.selectExpr(*[f"{number_of(df, name)} AS {quoted(name)}" for name in names])
    uses = {"count": "count", "mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    moments = rows_of(
        values.selectExpr(*[f"{use}({quoted(name)}) AS {use}_{name}" for name in names for use in uses.values()]),
        [(literal(name), *[f"{use}_{name}" for use in uses.values()]) for name in names],
        ["column", *uses],
    )
    found = quantiles(long_values(values, names), percentiles)
    shown = [quoted(label) for label in percentiles]
    # one row per column on either side
    return moments.join(F.broadcast(found), moments["column"] == found["field"], "left").selectExpr(
        "column", "count", "mean", "std", "min", *shown, "max"
    )


def outside(value: str, lower: str, upper: str) -> str:
    """Strictly below or above the bounds; a missing value is never outside."""
    return holds(f"{value} < {lower} OR {value} > {upper}")


def iqr_bounds(values: DataFrame, multiplier: float = fixed.IQR_MULTIPLIER) -> DataFrame:
    """Quartiles and bounds per field; fields without any value do not appear."""
    found = quantiles(values, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return found.selectExpr(
        "field",
        "q1",
        "median",
        "q3",
        "q3 - q1 AS iqr",
        f"q1 - {multiplier}D * (q3 - q1) AS lower_bound",
        f"q3 + {multiplier}D * (q3 - q1) AS upper_bound",
    )


BEYOND = outside("value", "lower_bound", "upper_bound")


def iqr_counts(values: DataFrame, bounds: DataFrame) -> DataFrame:
    """Bounds per field with rows in all, present rows and rows outside.

    ``bounds`` has one row per profiled column, so it is broadcast.
    """
    totals = {
        "rows_total": "true",
        "rows_non_null": "value IS NOT NULL",
        "rows_missing": "value IS NULL",
        "outlier_count": BEYOND,
    }
    return (
        with_field(values, bounds, "LEFT")
        .groupBy("field", "q1", "median", "q3", "iqr", "lower_bound", "upper_bound")
        .agg(*[F.expr(f"sum(CASE WHEN {test} THEN rows ELSE 0 END) AS {name}") for name, test in totals.items()])
    )


def outlier_summary(df: DataFrame, columns: Sequence[str] = fixed.PROFILE_COLUMNS) -> DataFrame:
    """Quartiles, bounds and outliers per column; percent of the present values, 2 digits."""
    values = long_values(df, _present(df, columns))
    counts = iqr_counts(values, iqr_bounds(values))
    return counts.filter("rows_non_null > 0").selectExpr(
        "field AS Column",
        "rows_non_null AS Count",
        "q1 AS Q1",
        "median AS Median",
        "q3 AS Q3",
        "iqr AS IQR",
        "lower_bound AS `Lower Bound`",
        "upper_bound AS `Upper Bound`",
        "outlier_count AS `Outlier Count`",
        f"{percent('outlier_count', 'rows_non_null', 2)} AS `Outlier %`",
    )


def displayed(values: DataFrame, between=fixed.DISPLAY_RANGE) -> DataFrame:
    """The values a distribution chart shows.

    Those within the two quantiles, ends included; all of them where both quantiles coincide.
    """
    ends = quantiles(values, {"low": between[0], "high": between[1]})
    return (
        with_field(values, ends)
        .filter("value IS NOT NULL AND (value BETWEEN low AND high OR low = high)")
        .select("field", "value", "rows")
    )


def _shown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return displayed(long_values(df, _present(df, columns)))


def histogram(
    df: DataFrame, columns: Sequence[str] = fixed.PROFILE_COLUMNS, bins: int = fixed.HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width bins over the displayed values: (field, bin, bin_start, bin_end, rows).

    Bins are half-open but for the last; a single displayed value gets a range of width one.
    """
    shown = _shown(df, columns)

    def edge(number: str) -> str:
        return f"(low + {number} * width)"

    # a value next to an edge may fall on the wrong side of it by rounding
    placed = (
        f"CASE WHEN value < {edge('guess')} THEN guess - 1 "
        f"WHEN value >= {edge('(guess + 1)')} AND guess < {bins - 1} THEN guess + 1 ELSE guess END"
    )
    return df.sparkSession.sql(
        f"""WITH extremes AS (SELECT field, min(value) AS least, max(value) AS most FROM {{shown}} GROUP BY field),
        spans AS (
          SELECT field, CASE WHEN least = most THEN least - 0.5D ELSE least END AS low,
            CASE WHEN least = most THEN most + 0.5D ELSE most END AS high FROM extremes),
        widths AS (SELECT *, (high - low) / {bins} AS width FROM spans),
        guessed AS (
          SELECT /*+ BROADCAST(w) */ s.*, low, width,
            least(floor((value - low) / width), {bins - 1}L) AS guess
          FROM {{shown}} s JOIN widths w ON s.field = w.field),
        counted AS (SELECT field, int({placed}) AS bin, sum(rows) AS rows FROM guessed GROUP BY ALL),
        every_bin AS (SELECT *, explode(sequence(0, {bins - 1})) AS bin FROM widths)
        SELECT /*+ BROADCAST(c) */ b.field, b.bin, {edge("b.bin")} AS bin_start,
          CASE WHEN b.bin = {bins - 1} THEN high ELSE {edge("(b.bin + 1)")} END AS bin_end,
          coalesce(c.rows, 0L) AS rows
        FROM every_bin b LEFT JOIN counted c ON b.field = c.field AND b.bin = c.bin""",
        shown=shown,
    )


def box_stats(df: DataFrame, columns: Sequence[str] = fixed.PROFILE_COLUMNS) -> DataFrame:
    """Quartiles, whiskers and fliers of the displayed values per field.

    A whisker ends at the last value within the bounds, but never inside the box.
    """
    shown = _shown(df, columns)
    totals = [
        "sum(rows) AS rows",
        f"least(min(CASE WHEN NOT {BEYOND} THEN value END), q1) AS whisker_low",
        f"greatest(max(CASE WHEN NOT {BEYOND} THEN value END), q3) AS whisker_high",
        f"sum(CASE WHEN {BEYOND} THEN rows ELSE 0 END) AS fliers",
    ]
    return (
        with_field(shown, iqr_bounds(shown))
        .groupBy("field", "q1", "median", "q3")
        .agg(*[F.expr(text) for text in totals])
        .select("field", "rows", "q1", "median", "q3", "whisker_low", "whisker_high", "fliers")
    )
