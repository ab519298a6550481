"""Incremental ingest: append newly landed files, keep the company table up to date.

Late and repeated rows need no watermark: the raw tables keep everything and the staging views
take the last row by timestamp. Where a source repeats itself a lot, ``Lateness`` removes repeats
on the way in, with bounded state. All checkpoints belong in a folder shared by the cluster.
"""

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from greenshoe.plans.terms import extract, typed
from greenshoe.schemas import COMPANIES, EXTRACTED
from greenshoe.sources import changes, tables
from greenshoe.sources.landed import company_metadata, document_covers


def landed_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int = 1_000
) -> DataFrame:
    """New Parquet files under ``path``, a bounded number of them per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


@dataclass(frozen=True)
class Lateness:
    """Repeats of a key within ``bound`` of each other, by the times in ``time``, are one row.

    The state holds the keys of that long only. Rows that come later than ``bound`` behind the
    newest time seen are dropped; ``late_rows`` counts them.
    """

    keys: list[str]
    time: str
    bound: str

    def __call__(self, stream: DataFrame) -> DataFrame:
        known = stream.withWatermark(self.time, self.bound)
        return known.dropDuplicatesWithinWatermark(self.keys)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a finished query has dropped as they came later than its bound allows."""
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def append_raw(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    stamp: str,
    partition_by: str | None = None,
    lateness: Lateness | None = None,
) -> StreamingQuery:
    """Append what has landed, each row stamped with the time of its batch, and stop.

    ``partition_by`` has to be what the jobs partition the table by, if they write to it too. All
    rows are kept as they are, however late and however often they come, unless ``lateness`` bounds
    for how long repeats are looked for.
    """
    rows = stream if lateness is None else lateness(stream)
    return _append(rows.withColumn(stamp, F.current_timestamp()), path, checkpoint, partition_by)


def append_extracted(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append covers and terms of newly landed documents, before the fallback, and stop.

    Extraction needs no state and no shuffle, so every document is parsed once, as it lands.
    """
    extracted = typed(extract(document_covers(documents)), EXTRACTED)
    return _append(extracted, path, checkpoint, "filing_date")


def _append(
    rows: DataFrame, path: str, checkpoint: str, partition_by: str | None
) -> StreamingQuery:
    """Each batch is written as the jobs write theirs: a file sink of its own would keep a log by
    which readers no longer see what others wrote. A repeated batch replaces itself."""
    name = _name_of(checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        tables.append(batch, path, f"stream-{name}-{number}", partition_by)

    return _run(rows.writeStream.foreachBatch(write), checkpoint)


def _name_of(checkpoint: str) -> str:
    """A stream's part in the names of its loads."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def _run(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Take what has landed and stop."""
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """The company table: the newest row of every company, whoever merged it."""
    return changes.read(spark, path, COMPANIES, ["cik"])


def upsert_companies(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    initial: DataFrame | None = None,
    now: Callable[[], Column] = F.current_timestamp,
) -> StreamingQuery:
    """Merge landed metadata ``(cik, http_status, body, landed_at)`` into the company table.

    A batch appends the rows it got and reads nothing. One that is repeated after a failure appends
    them again, which changes no company. ``initial`` rows go into the table with the first batch
    and give way to any other.
    """
    name = _name_of(checkpoint)

    def merge(batch: DataFrame, number: int) -> None:
        if number == 0 and initial is not None:
            changes.merge(initial, path, f"initial-{name}", COMPANIES, changes.before_all())
        incoming = company_metadata(batch, "landed_at").withColumn("ingested_at", now())
        changes.merge(incoming, path, f"stream-{name}-{number}", COMPANIES)

    tables.create(stream.sparkSession, path)
    return _run(stream.writeStream.foreachBatch(merge), checkpoint)
