"""Incremental ingest: new files, repeated runs, late rows."""

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from greenshoe import schemas as S
from greenshoe.cases.derived import Tables
from greenshoe.operators.latest import latest_by, newest
from greenshoe.plans.staging import stg_prospectus_filings
from greenshoe.plans.terms import extract
from greenshoe.plans import jobs
from greenshoe.sources import tables
from greenshoe.sources.landed import document_covers
from greenshoe.streaming import incremental as I

LANDED = S.LANDED_BODY


def land(spark, path, rows):
    rows = [(cik, 200, json.dumps({"name": name, "sic": "7372"}), at) for cik, name, at in rows]
    spark.createDataFrame(rows, LANDED).write.mode("append").parquet(path)


def test_companies_are_merged_over_runs(spark, tmp_path):
    landed, table = str(tmp_path / "landed"), str(tmp_path / "companies")
    checkpoint = str(tmp_path / "checkpoint")
    initial = spark.createDataFrame(
        [("0", "Old", None, None, None, None, None)], S.COMPANIES
    )

    def run():
        stream = I.landed_stream(spark, landed, LANDED)
        I.upsert_companies(stream, table, checkpoint, initial).awaitTermination()
        return {r.cik: r.company_name for r in I.read_companies(spark, table).collect()}

    day = [datetime(2024, 1, n) for n in range(1, 5)]
    land(spark, landed, [("1", "A", day[0]), ("1", "A2", day[1]), ("2", "B", day[0])])
    assert run() == {"0": "Old", "1": "A2", "2": "B"}
    assert run() == {"0": "Old", "1": "A2", "2": "B"}  # nothing new
    land(spark, landed, [("2", "B2", day[2]), ("3", "C", day[3])])
    assert run() == {"0": "Old", "1": "A2", "2": "B2", "3": "C"}
    rows = I.read_companies(spark, table)
    assert rows.columns == S.COMPANIES.names
    assert rows.where("ingested_at is null").count() == 1  # only the row that was never touched


def test_new_files_are_appended_once_and_the_last_row_wins(spark, tmp_path):
    landed, raw, checkpoint = (str(tmp_path / n) for n in ("index", "raw", "checkpoint"))

    def run():
        stream = I.landed_stream(spark, landed, S.FILING_INDEX)
        I.append_raw(stream, raw, checkpoint, "ingested_at").awaitTermination()
        return spark.read.schema(S.PROSPECTUS_FILINGS).parquet(raw)

    def filing(accession, name):
        row = ("1", name, date(2024, 1, 1), accession, "424B4", "u")
        spark.createDataFrame([row], S.FILING_INDEX).write.mode("append").parquet(landed)

    filing("a", "first")
    assert run().count() == 1
    assert run().count() == 1
    filing("a", "again")
    filing("b", "other")
    rows = run()
    assert rows.count() == 3
    latest = {r.accession_number: r.company_name for r in stg_prospectus_filings(rows).collect()}
    assert latest == {"a": "again", "b": "other"}


def test_documents_are_extracted_as_they_land(spark, folder, tmp_path):
    """Two halves through the stream give the same rows as one batch over both."""
    documents = Tables(spark, folder)["fx_documents"]
    landed, path, checkpoint = (str(tmp_path / n) for n in ("documents", "extracted", "checkpoint"))
    early = F.col("filing_date") < "1998-01-01"
    for half in (early, ~early):
        documents.where(half).write.mode("append").partitionBy("filing_date").parquet(landed)
        stream = I.landed_stream(spark, landed, S.LANDED_DOCUMENT)
        I.append_extracted(stream, path, checkpoint).awaitTermination()
    got = spark.read.schema(S.EXTRACTED).parquet(path).select(*S.EXTRACTED.names)
    expected = extract(document_covers(documents)).select(*S.EXTRACTED.names)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_events_by_day_arrive_in_any_order(spark, folder, tmp_path):
    """Late files change nothing in the end: the last row per key is the same as in one batch."""
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("day", F.to_date("ts"))
    landed, raw, checkpoint = (str(tmp_path / n) for n in ("landed", "raw", "checkpoint"))
    days = sorted(r.day for r in events.select("day").distinct().collect())
    for day in [*days[1::2], *days[::2]]:
        part = events.where(F.col("day") == F.lit(day)).drop("day")
        part.coalesce(1).write.mode("append").parquet(landed)
        if day in (days[1], days[-1]):
            stream = I.landed_stream(spark, landed, part.schema, max_files=2)
            I.append_raw(stream, raw, checkpoint, "ingested_at").awaitTermination()
    stream = I.landed_stream(spark, landed, events.drop("day").schema)
    I.append_raw(stream, raw, checkpoint, "ingested_at").awaitTermination()
    got = spark.read.parquet(raw).drop("ingested_at", tables.LOAD)
    assert got.count() == events.count()

    def last(df):
        return sorted(map(str, latest_by(df, ["user_id"], [newest("ts")]).collect()))

    assert last(got) == last(events.drop("day"))


def test_stream_and_jobs_share_tables(spark, tmp_path):
    """Whoever writes first: readers see the rows of both, and a repeated load adds none."""
    def filing(accession):
        row = ("1", "n", date(2024, 1, 1), accession, "424B4", "u")
        return spark.createDataFrame([row], S.FILING_INDEX)

    for first in ("stream", "job"):
        landed, raw, checkpoint = (str(tmp_path / first / n) for n in ("index", "raw", "checkpoint"))
        tables.create(spark, raw)
        filing("s").write.parquet(landed)

        def stream():
            rows = I.landed_stream(spark, landed, S.FILING_INDEX)
            I.append_raw(rows, raw, checkpoint, "ingested_at", "filing_date").awaitTermination()

        def job():
            rows = filing("j").withColumn("ingested_at", F.current_timestamp())
            tables.append(rows, raw, "batch-1", "filing_date")

        for write in (stream, job) if first == "stream" else (job, stream):
            write()
            write()
        rows = tables.read_table(spark, raw, S.PROSPECTUS_FILINGS).collect()
        assert sorted(r.accession_number for r in rows) == ["j", "s"]


def test_stream_and_jobs_share_extracted_days(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path))
    body = "<p>This is an initial public offering. We are offering 50,000 ordinary shares.</p>"
    days = [date(2024, 1, n) for n in (1, 2)]
    for n, day in enumerate(days):
        row = [("1", f"acc{n}", day, 200, body)]
        documents = spark.createDataFrame(row, S.LANDED_DOCUMENT)
        documents.write.mode("append").partitionBy("filing_date").parquet(w.path("landed", "documents"))
        if n == 0:
            stream = I.landed_stream(spark, w.path("landed", "documents"), S.LANDED_DOCUMENT)
            path = w.path(tables.STAGING, "extracted")
            I.append_extracted(stream, path, str(tmp_path / "checkpoint")).awaitTermination()
    jobs.extract_days(w, days[1], days[1])
    jobs.extract_days(w, days[1], days[1])
    assert sorted(r.accession_number for r in w.extracted(*days).collect()) == ["acc0", "acc1"]
