"""A table that is merged into by appending.

A merge appends the rows it got, stamped with its time. What the table holds is the newest row of
every key, so a merge touches no other row and writes no more than it got, jobs and streams need
nothing from each other but the folder, and a merge that is repeated changes nothing else: rows are
only ever replaced, never removed.

``compact`` writes the newest rows as one more load and retires the files that they came from. Both
are read until the next compaction deletes the retired files, which gives the same rows, so readers
and merges can go on meanwhile. One compaction of a table runs at a time.
"""

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from greenshoe.operators.latest import latest_by, newest
from greenshoe.sources.tables import LOAD, create, delete, hadoop, read_table

MERGED_AT, LANDED_AT = "merged_at", "landed_at"
COMPACTED = "compacted-"
# Names that begin so are no data for Spark's readers.
RETIRED = "_retired"


def before_all() -> Column:
    """A time that every merge goes before, for rows that are there from the start."""
    return F.lit("0001-01-01 00:00:00").cast("timestamp")


def _stamped(schema: StructType) -> StructType:
    stamps = [StructField(name, TimestampType()) for name in (MERGED_AT, LANDED_AT)]
    return StructType(schema.fields + stamps)


def merge(
    rows: DataFrame, path: str, load: str, schema: StructType, at: Column | None = None
) -> None:
    """Merge rows into the table: they replace those with their keys, others are added.

    Of several rows with one key the last landed counts, where ``rows`` have that time. A later
    merge goes before an earlier one, by ``at``, the time of the run as a rule.
    """
    landed = F.col(LANDED_AT) if LANDED_AT in rows.columns else F.lit(None)
    stamps = [
        (F.current_timestamp() if at is None else at).cast("timestamp").alias(MERGED_AT),
        landed.cast("timestamp").alias(LANDED_AT),
    ]
    changes = rows.select(*schema.names, *stamps).withColumn(LOAD, F.lit(load))
    changes.write.mode("append").partitionBy(LOAD).parquet(path)


def changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every row that was merged and not yet compacted away."""
    return read_table(spark, path, _stamped(schema))


def _newest_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    return latest_by(rows, keys, [F.desc(MERGED_AT), newest(LANDED_AT)])


def read(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The table: the newest row of every key."""
    return _newest_rows(changes(spark, path, schema), keys).select(*schema.names)


def compact(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> int:
    """Write the newest rows as one load; gives the number of files that this retires.

    First the files that the compaction before has retired are deleted. Without new loads since
    then nothing is written.
    """
    create(spark, path)
    _delete_retired(spark, path)
    rows = changes(spark, path, schema)
    files = list(rows.inputFiles())
    if all(f"/{LOAD}={COMPACTED}" in name for name in files):
        return 0
    mark = uuid.uuid4().hex
    newest_rows = _newest_rows(rows, keys).withColumn(LOAD, F.lit(f"{COMPACTED}{mark}"))
    newest_rows.write.mode("append").partitionBy(LOAD).parquet(path)
    system, target = hadoop(spark, f"{path}/{RETIRED}/{mark}.json")
    with_list = system.create(target)
    with_list.write(bytearray(json.dumps(files).encode()))
    with_list.close()
    return len(files)


def _delete_retired(spark: SparkSession, path: str) -> None:
    """Delete what earlier compactions have replaced, each list after the files that it names."""
    system, pattern = hadoop(spark, f"{path}/{RETIRED}/*.json")
    for found in system.globStatus(pattern) or []:
        text = spark.read.text(found.getPath().toString(), wholetext=True).first()[0]
        for name in json.loads(text):
            delete(spark, spark._jvm.java.net.URI.create(name))
        delete(spark, found.getPath().toString())
