"""Compare a Spark result with the SQL result of the same query: names, types, rows, values."""

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def database(folder):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql):
    """A list of complaints; empty when both results agree."""
    relation = connection.sql(sql)
    complaints = []
    spark_types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != sql_types:
        odd = {n: (spark_types.get(n), sql_types.get(n)) for n in {*spark_types, *sql_types} if spark_types.get(n) != sql_types.get(n)}
        complaints.append(f"types differ: {odd}")
    left, right = _bag(df.columns, df.collect()), _bag(relation.columns, relation.fetchall())
    if sum(left.values()) != sum(right.values()):
        complaints.append(f"rows: {sum(left.values())} in Spark, {sum(right.values())} in SQL")
    if left != right:
        only_left, only_right = left - right, right - left
        complaints.append(
            f"values: {sum(only_left.values())} only in Spark, e.g. {list(only_left)[:2]}; "
            f"{sum(only_right.values())} only in SQL, e.g. {list(only_right)[:2]}"
        )
    return complaints
