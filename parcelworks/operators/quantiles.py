"""Exact quantiles with linear interpolation that neither sort nor shuffle the values.

A double's 64 bits, with the sign taken for minus, are a whole number that grows with the value.
Three passes over the column locate the wanted ranks in it: the first counts values by the upper
22 bits, and each next one counts, by 21 more bits, only the values in the bins that hold a wanted
rank; where located bins are broadcast, the others are left out by comparison with the bins' ends. Counts are combined on the map side, so what is shuffled are bins, at most 2**22 a group and
far fewer in practice, however many values there are and however close to each other they lie.
After the third pass the bits are complete: the bin is the value.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from parcelworks.functions.casts import number_of
from parcelworks.functions.logic import all_equal, literal, quoted

#: bits still hidden after each pass
SHIFTS = (42, 21, 0)
#: groups whose located bins are broadcast; each is a few rows
GROUPS_TO_BROADCAST = 100_000


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., field, value, rows) with one row per row and column, and ``rows`` 1."""
    groups = [quoted(name) for name in by]
    if len(columns) == 1:
        return df.selectExpr(
            *groups, f"{literal(columns[0])} AS field", f"{number_of(df, columns[0])} AS value", "1L AS rows"
        )
    numbers = df.selectExpr(*groups, *[f"{number_of(df, name)} AS {quoted(name)}" for name in columns])
    return numbers.unpivot(list(by), list(columns), "field", "value").selectExpr("*", "1L AS rows")


def _with_bits(values: str, keys: str) -> str:
    """SQL text of ``values`` with ``bits``, the ordered whole number of each value.

    The exponent is found by a logarithm and set right by comparison with powers of two; the rest
    of the division by a power of two is exact. From 2**-19 up to 2**41 the powers are shifted ones,
    far cheaper than ``pow``, and values are compared times 2**20. Values below the smallest normal
    number are whole multiples of 2**-1074.
    """
    usual = "far >= 1.9073486328125E-6D AND far < 2199023255552D"
    return f"""
      SELECT {keys}, value, rows, CASE WHEN value < 0 THEN -size ELSE size END AS bits
      FROM (
        SELECT *, CASE
          WHEN value IS NULL THEN NULL
          WHEN {usual} THEN (power + 1023L) * 4503599627370496L
            + bigint((far * 1048576D / shiftleft(1L, int(power + 20L)) - 1D) * 4503599627370496D)
          WHEN far = 0 THEN 0L
          WHEN far > 1.7976931348623157E308D THEN 2047L * 4503599627370496L
          WHEN far < 2.2250738585072014E-308D THEN bigint(far * pow(2D, 537) * pow(2D, 537))
          ELSE (power + 1023L) * 4503599627370496L + bigint((far / pow(2D, power) - 1D) * 4503599627370496D)
          END AS size
        FROM (
          SELECT *, guess + CASE
            WHEN {usual} THEN CASE
              WHEN shiftleft(1L, int(guess + 20L)) > far * 1048576D THEN -1
              WHEN shiftleft(1L, int(guess + 21L)) <= far * 1048576D THEN 1 ELSE 0 END
            WHEN pow(2D, guess) > far THEN -1 WHEN pow(2D, guess + 1) <= far THEN 1 ELSE 0 END AS power
          FROM (
            SELECT *, bigint(floor(log2(CASE WHEN far BETWEEN 2.2250738585072014E-308D AND 1.7976931348623157E308D
              THEN far ELSE 1D END))) AS guess
            FROM (SELECT {keys}, value, rows, abs(value) AS far FROM {values}))))"""


def bins_of(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., field, bin, rows, least, most): how often values have each setting of their upper 22 bits.

    Bins of several tables add up to those of their union, see ``added``. Missing values have a
    null bin.
    """
    keys = ", ".join(quoted(name) for name in [*by, "field"])
    return values.sparkSession.sql(
        f"""SELECT {keys}, shiftright(bits, {SHIFTS[0]}) AS bin, sum(rows) AS rows, min(value) AS least, max(value) AS most
        FROM ({_with_bits('{values}', keys)}) GROUP BY ALL""",
        values=values,
    )


def added(bins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``bins_of`` by fewer columns, from those by more."""
    keys = ", ".join(quoted(name) for name in [*by, "field"])
    return bins.sparkSession.sql(
        f"SELECT {keys}, bin, sum(rows) AS rows, min(least) AS least, max(most) AS most FROM {{bins}} GROUP BY ALL", bins=bins
    )


def holding(bins: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., field, least, most) of the bins that hold a wanted rank: a few per group and field."""
    keys = ", ".join(quoted(name) for name in [*by, "field"])
    parts = [
        f"sized AS (SELECT *, sum(CASE WHEN bin IS NOT NULL THEN rows END) OVER (PARTITION BY {keys}) AS n FROM {{bins}})",
        f"counted AS (SELECT *, array_distinct(array({_ranks(probabilities)})) AS ranks, 0L AS before FROM sized)",
        _holding_ranks("located", "counted", keys, keys),
    ]
    query = f"WITH {', '.join(parts)} SELECT {keys}, l.least, b.most FROM located l JOIN {{bins}} b USING ({keys}, bin)"
    if by:
        same = " AND ".join(f"l.{quoted(name)} <=> b.{quoted(name)}" for name in [*by, "field", "bin"])
        chosen = ", ".join(f"l.{quoted(name)}" for name in [*by, "field"])
        query = f"WITH {', '.join(parts)} SELECT {chosen}, l.least, b.most FROM located l JOIN {{bins}} b ON {same}"
    return bins.sparkSession.sql(query, bins=bins)


def _ranks(probabilities: Mapping[str, float]) -> str:
    return ", ".join(f"bigint({use}({p!r}D * (n - 1)))" for p in probabilities.values() for use in ("floor", "ceil"))


def quantiles(
    values: DataFrame,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    broadcast: bool | None = None,
    bins: DataFrame | None = None,
) -> DataFrame:
    """One row per (by..., field) with ``n`` non-missing rows and a column per probability.

    ``values`` has (by..., field, value, rows), ``rows`` being how often the value counts; it may
    hold a value many times. Groups without any non-missing value do not appear. ``broadcast``
    says that the groups are few enough for their located bins to be broadcast; without groups
    they are a few rows per field. ``bins`` are the ``bins_of`` the values, if they are known; then
    ``values`` need hold no more than those of the bins with a wanted rank.
    """
    names = [*by, "field"]
    keys = ", ".join(quoted(name) for name in names)
    ranks = _ranks(probabilities)
    few = broadcast or not by
    parts = [
        f"bits AS ({_with_bits('{values}', keys)})",
        f"""binned AS (
          SELECT {keys}, shiftright(bits, {SHIFTS[0]}) AS bin, sum(rows) AS rows, min(value) AS least, max(value) AS most
          FROM bits GROUP BY ALL)"""
        if bins is None
        else f"binned AS (SELECT {keys}, bin, rows, least, most FROM {{bins}})",
        f"""sized AS (
          SELECT *, sum(CASE WHEN bin IS NOT NULL THEN rows END) OVER (PARTITION BY {keys}) AS n FROM binned)""",
        f"counted AS (SELECT *, array_distinct(array({ranks})) AS ranks, 0L AS before FROM sized)",
        _holding_ranks("located", "counted", keys, keys),
    ]
    located = "located"
    same = all_equal([f"f.{quoted(key)}" for key in names], [f"l.{quoted(key)}" for key in names])
    chosen = ", ".join(f"f.{quoted(key)}" for key in names)
    for shift, finer in zip(SHIFTS, SHIFTS[1:]):
        # null-safe equality keeps the missing group and lets all passes read the same scan
        of_bin = "l.bin AS within, l.n, l.before, l.ranks, f.rows, f.value"
        if few:
            # a bin is a range of values, so only values within a located one need their bits
            parts += [
                f"""near_{finer} AS (
                  SELECT /*+ BROADCAST(l) */ {chosen}, {of_bin}
                  FROM {{values}} f JOIN {located} l ON {_met("f", "l", names)} AND f.value BETWEEN l.least AND l.most)""",
                f"within_{finer} AS ({_with_bits(f'near_{finer}', f'{keys}, within, n, before, ranks')})",
            ]
        else:
            # the bin is a key of the join, so that a group with many rows is spread over tasks
            parts.append(
                f"""within_{finer} AS (
                  SELECT {chosen}, {of_bin}, f.bits
                  FROM bits f JOIN {located} l ON {same} AND shiftright(f.bits, {shift}) <=> l.bin)"""
            )
        parts += [
            f"""counted_{finer} AS (
              SELECT {keys}, within, shiftright(bits, {finer}) AS bin, n, before, ranks,
                sum(rows) AS rows, min(value) AS least, max(value) AS most
              FROM within_{finer} GROUP BY ALL)""",
            _holding_ranks(f"located_{finer}", f"counted_{finer}", keys, f"{keys}, within"),
        ]
        located = f"located_{finer}"
    results = ", ".join(f"{_interpolated(p)} AS {quoted(name)}" for name, p in probabilities.items())
    parts += [
        f"exploded AS (SELECT {keys}, n, least AS value, explode(ranks) AS rank FROM {located})",
        f"""at_ranks AS (
          SELECT {keys}, n, map_from_entries(collect_list(struct(rank, value))) AS at
          FROM exploded GROUP BY ALL)""",
    ]
    query = f"WITH {', '.join(parts)} SELECT {keys}, n, {results} FROM at_ranks"
    given = {"values": values} if bins is None else {"values": values, "bins": bins}
    return values.sparkSession.sql(query, **given)


def _met(left: str, right: str, names: Sequence[str]) -> str:
    """SQL text of null-safe equality of columns, for a join of all values with a few broadcast rows.

    The hash alone is the join's key: a number is looked up several times faster than texts are. The
    equality is written as two comparisons, which are no keys.
    """
    hashes = " = ".join(f"xxhash64({', '.join(f'{side}.{quoted(name)}' for name in names)})" for side in (left, right))
    same = [
        f"({a} >= {b} AND {a} <= {b} OR {a} IS NULL AND {b} IS NULL)"
        for a, b in ((f"{left}.{quoted(name)}", f"{right}.{quoted(name)}") for name in names)
    ]
    return " AND ".join([hashes, *same])


def with_field(values: DataFrame, per_field: DataFrame, kind: str = "INNER") -> DataFrame:
    """``values`` with the other columns of ``per_field``, which has a row per field and is broadcast."""
    others = ", ".join(f"p.{quoted(name)}" for name in per_field.columns if name != "field")
    return values.sparkSession.sql(
        f"SELECT /*+ BROADCAST(p) */ v.*, {others} FROM {{values}} v {kind} JOIN {{per_field}} p ON {_met('v', 'p', ['field'])}",
        values=values,
        per_field=per_field,
    )


def few_groups(df: DataFrame, by: Sequence[str], limit: int = GROUPS_TO_BROADCAST) -> bool:
    """Whether the groups are at most ``limit``; one pass over the group columns."""
    return df.select(*map(quoted, by)).distinct().limit(limit + 1).count() <= limit


def grouped_median(
    df: DataFrame, column: str, by: Sequence[str], name: str, broadcast: bool | None = None
) -> DataFrame:
    """Exact median of one column per group, as (by..., name)."""
    return quantiles(long_values(df, [column], by), {name: 0.5}, by, broadcast).select(*by, name)


def every_group_median(
    df: DataFrame, column: str, by: Sequence[str], name: str, broadcast: bool | None = None
) -> DataFrame:
    """``grouped_median`` that keeps groups without any value, with a null median."""
    medians = grouped_median(df, column, by, name, broadcast)
    groups = df.select(*map(quoted, by)).distinct()
    same = all_equal([f"g.{quoted(key)}" for key in by], [f"m.{quoted(key)}" for key in by])
    chosen = ", ".join(f"g.{quoted(key)}" for key in by)
    return df.sparkSession.sql(
        f"SELECT {chosen}, m.{quoted(name)} FROM {{groups}} g LEFT JOIN {{medians}} m ON {same}",
        groups=groups,
        medians=medians,
    )


def _holding_ranks(name: str, counted: str, keys: str, within: str) -> str:
    """Bins whose run of positions holds a wanted rank.

    ``before`` moves on to the start of the run, ``ranks`` keeps the ranks lying in it.
    """
    in_run = "rank -> rank >= upto - rows AND rank < upto"
    return f"""{name} AS (
      SELECT {keys}, bin, n, least, most, upto - rows AS before, filter(ranks, {in_run}) AS ranks
      FROM (
        SELECT *, before + sum(rows) OVER (
          PARTITION BY {within} ORDER BY bin ASC NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM {counted})
      WHERE exists(ranks, {in_run}))"""


def _interpolated(probability: float) -> str:
    position = f"({probability!r}D * (n - 1))"
    low, high = (f"element_at(at, bigint({use}({position})))" for use in ("floor", "ceil"))
    share = f"({position} - floor({position}))"
    return f"CASE WHEN {low} = {high} THEN {low} ELSE {low} + ({high} - {low}) * {share} END"
