"""Layers, sinks and file exports."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from greenshoe.schemas import COVER_SAMPLE, FCT_IPO_OFFERINGS

RAW, STAGING, MARTS = "raw", "staging", "marts"


def layer_name(custom: str | None, default: str) -> str:
    """A custom layer name is used as it is, but trimmed; without one the default holds."""
    return default if custom is None else custom.strip()


def table_name(table: str, custom: str | None, default: str) -> str:
    return f"{layer_name(custom, default)}.{table}"


# The innermost partition of tables that grow: which batch or stream batch wrote the rows.
LOAD = "load"


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def hadoop(spark: SparkSession, path):
    """The file system of a path and the path, as Spark's own readers reach them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create(spark: SparkSession, path: str) -> None:
    """An empty table, unless there is one."""
    files, target = hadoop(spark, path)
    files.mkdirs(target)


def delete(spark: SparkSession, path) -> None:
    """Delete a file or folder, if it is there."""
    files, target = hadoop(spark, path)
    files.delete(target, True)


def append(
    df: DataFrame,
    path: str,
    load: str,
    partition_by: str | None = None,
    observed: Observation | None = None,
    *figures: Column,
) -> None:
    """Append rows as one load; keys are not checked, the staging views remove duplicates.

    Jobs and streams both write through here, each load under its own name. A load that is
    written again, after a failure for instance, replaces itself: partitions that it had rows in
    before and has none now are emptied.

    With ``partition_by`` the rows are gathered by that column first, so that a range of days does
    not end in a file per task and day. The rebalance still splits a day that is very large.

    ``observed`` gets the figures of the rows as they are written, without a pass of its own. They
    are taken behind the last shuffle, where every row is counted once whatever is run again.
    """
    days = [partition_by] if partition_by else []
    rows = df.hint("rebalance", *days) if days else df
    if observed is not None:
        rows = rows.observe(observed, *figures)
    before = _files_of_load(df.sparkSession, path, days, load)
    writer = rows.withColumn(LOAD, F.lit(load)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*days, LOAD).parquet(path)
    if before:
        now = _files_of_load(df.sparkSession, path, days, load)
        for folder, files in before.items():
            if now.get(folder) == files:  # not written this time
                delete(df.sparkSession, folder)


def _files_of_load(
    spark: SparkSession, path: str, days: list[str], load: str
) -> dict[str, set[str]]:
    """The names of a load's files by partition."""
    levels = [f"{day}=*" for day in days]
    system, pattern = hadoop(spark, "/".join([path, *levels, f"{LOAD}={load}", "*"]))
    found: dict[str, set[str]] = {}
    for status in system.globStatus(pattern) or []:
        file = status.getPath()
        found.setdefault(file.getParent().toString(), set()).add(file.getName())
    return found


def replace_days(
    df: DataFrame, path: str, start: date, end: date, kind: str = "parquet"
) -> None:
    """Write a range of ``filing_date`` anew; days without rows are empty afterwards.

    No shuffle: meant for rows that come from a table with the same partitions. ``df`` must not
    read from ``path``. A run that fails in between is repeated as a whole.
    """
    files, _ = hadoop(df.sparkSession, path)
    for n in range((end - start).days + 1):
        _, day = hadoop(df.sparkSession, f"{path}/filing_date={start + timedelta(n)}")
        files.delete(day, True)
    create(df.sparkSession, path)
    rows = df.withColumn(LOAD, F.lit("days"))
    rows.write.mode("append").partitionBy("filing_date", LOAD).format(kind).save(path)


def rebuild(df: DataFrame, path: str) -> None:
    """Replace the whole table. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def _version(path: str, number: int) -> str:
    return f"{path}/version={number}"


def write_version(df: DataFrame, path: str, number: int) -> None:
    """Write one version of a table. The same version written again replaces itself."""
    df.write.mode("overwrite").parquet(_version(path, number))


def read_version(spark: SparkSession, path: str, number: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(_version(path, number))


def last_version(spark: SparkSession, path: str) -> int | None:
    """The newest complete version, also if it has no rows; None without any.

    A version is complete once Spark has left its mark in it.
    """
    files, marks = hadoop(spark, f"{path}/version=*/_SUCCESS")
    found = files.globStatus(marks) or []
    numbers = [int(mark.getPath().getParent().getName().partition("=")[2]) for mark in found]
    return max(numbers, default=None)


def publish_view(df: DataFrame, table: str) -> None:
    df.createOrReplaceTempView(table)


def write_samples(samples: DataFrame, path: str) -> None:
    samples.write.mode("overwrite").json(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COVER_SAMPLE).json(path)


def newest_first(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc("filing_date"), F.asc("accession_number"))


def export_csv(mart: DataFrame, path: str) -> None:
    """Newest filings first, header in upper case. Sorted by range, so files follow each other."""
    columns = [F.col(c).alias(c.upper()) for c in mart.columns]
    newest_first(mart).select(*columns).write.mode("overwrite").csv(path, header=True)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """A CSV export with its lower-case column names."""
    return spark.read.schema(FCT_IPO_OFFERINGS).csv(path, header=True)
