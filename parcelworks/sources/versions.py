"""Published tables as versions: a run writes only the months that have changed, and readers see a whole version.

A table's folder holds ``data/version=N/<month column>=...`` with the months that version N wrote,
``manifests/N`` with one row per month of the whole version (its folder, rows and digest), and
``versions/N``, an empty file. That file is the pointer: it is created last, in one step that fails
if it exists, so a run that stops before it leaves the version before as the latest, and of two runs
that publish at once one fails. Older versions stay readable until ``forget_before``.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks.functions.logic import literal, quoted

MANIFEST = "month string, version long, rows long, digest string"


class Conflict(RuntimeError):
    """Another run has published the version that this one was about to."""


def _file_system(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    files, path = _file_system(spark, f"{root}/versions")
    return sorted(int(one.getPath().getName()) for one in files.listStatus(path)) if files.exists(path) else []


def manifest(spark: SparkSession, root: str, version: int) -> DataFrame:
    """(month, version, rows, digest) of a version's months; ``version`` is the one that wrote the month."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{version}")


def digests(df: DataFrame, month: str) -> DataFrame:
    """(month, rows, digest): equal for equal bags of rows, whatever their order and files."""
    columns = sorted(df.columns)
    row = f"xxhash64({', '.join(map(quoted, columns))})"
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    shape = literal(",".join(f"{name}:{kinds[name]}" for name in columns))
    return df.groupBy(F.col(quoted(month)).cast("string").alias("month")).agg(
        F.expr("count(*) AS rows"),
        F.expr(f"concat_ws(':', xxhash64({shape}), bit_xor({row}), sum(pmod({row}, 4294967291L))) AS digest"),
    )


def publish(df: DataFrame, root: str, month: str) -> int:
    """Publish ``df`` as the next version and return its number; months with the rows of before are not written.

    A month that ``df`` does not have is not in the new version. Rows without a month are a month of
    their own. If no month has changed, no version is made and the number is the latest. Rows are
    gone through twice, once for the digests; give a stored table.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    number = known[-1] + 1 if known else 0
    now = digests(df, month)
    before = manifest(spark, root, known[-1]) if known else spark.createDataFrame([], MANIFEST)
    rows = spark.sql(
        f"""
        SELECT n.month, CASE WHEN n.rows = b.rows AND n.digest = b.digest THEN b.version ELSE {number}L END AS version,
          n.rows, n.digest
        FROM {{now}} n LEFT JOIN {{before}} b ON n.month <=> b.month""",
        now=now,
        before=before,
    )
    # one row per month
    found = rows.collect()
    changed = [row["month"] for row in found if row["version"] == number]
    if known and not changed and len(found) == before.count():
        return known[-1]
    part = F.col(quoted(month))
    if changed:
        there = part.cast("string").isin([one for one in changed if one is not None])
        chosen = df.filter(there | part.isNull() if None in changed else there)
        # the written column is a copy, so that a month's own type and place among the columns stay
        chosen.withColumn("_month", part.cast("string")).hint("rebalance", "_month").write.mode("overwrite").partitionBy(
            "_month"
        ).parquet(f"{root}/data/version={number}")
    spark.createDataFrame(found, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/{number}")
    _point(spark, root, number)
    return number


def _point(spark: SparkSession, root: str, number: int) -> None:
    files, path = _file_system(spark, f"{root}/versions/{number}")
    try:
        files.create(path, False).close()
    except Exception as error:
        raise Conflict(f"version {number} of {root} has been published by another run") from error


def read_version(spark: SparkSession, root: str, version: int | None = None, months: Sequence[str] | None = None) -> DataFrame:
    """A published version, the latest by default; of ``months`` only, if they are given.

    Months are folders, so only those asked for are read; a filter on the column ``_month`` prunes
    likewise, also by the rows of a join.
    """
    known = versions(spark, root)
    if version is None and not known or version is not None and version not in known:
        raise FileNotFoundError(f"{root} has no published version{'' if version is None else f' {version}'}")
    version = known[-1] if version is None else version
    # one row per month; a month of a version is a folder
    chosen = [row for row in manifest(spark, root, version).collect() if months is None or row["month"] in months]
    last = max((row["version"] for row in manifest(spark, root, version).collect()), default=None)
    if last is None:
        raise FileNotFoundError(f"version {version} of {root} has no rows")
    schema = spark.read.parquet(f"{root}/data/version={last}").drop("_month").schema
    if not chosen:
        return spark.createDataFrame([], schema.add("_month", "string"))
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    paths = [
        f"{root}/data/version={row['version']}/_month="
        + ("__HIVE_DEFAULT_PARTITION__" if row["month"] is None else escape(row["month"]))
        for row in chosen
    ]
    read = spark.read.option("basePath", f"{root}/data").schema(schema.add("_month", "string").add("version", "long"))
    return read.parquet(*paths).drop("version")


def forget_before(spark: SparkSession, root: str, version: int) -> None:
    """Delete the versions before ``version``, and the months that no version from then on uses."""
    known = versions(spark, root)
    kept = [one for one in known if one >= version]
    used = {(row["version"], row["month"]) for one in kept for row in manifest(spark, root, one).collect()}
    for one in [number for number in known if number < version]:
        months = [row["month"] for row in manifest(spark, root, one).filter(f"version = {one}").collect()]
        for month in months:
            if (one, month) not in used and month is not None:
                escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
                files, path = _file_system(spark, f"{root}/data/version={one}/_month={escape(month)}")
                files.delete(path, True)
        files, path = _file_system(spark, f"{root}/versions/{one}")
        files.delete(path, False)
