"""Layers, sinks, exports, scans and quality checks."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from greenshoe import schemas as S
from greenshoe.cases import warehouse as W
from greenshoe.cases import extraction  # noqa: F401  (registers the queries)
from greenshoe.cases.derived import Tables
from greenshoe.cases.registry import QUERIES
from greenshoe.plans import ingest, quality, reports
from greenshoe.plans import terms as T
from greenshoe.sources import filings, tables


def test_layer_names():
    assert tables.layer_name(None, "public") == "public"
    assert tables.layer_name(" MARTS ", "public") == "MARTS"
    assert tables.table_name("fct", None, "raw") == "raw.fct"


def index(spark):
    rows = [
        ("1", "A", date(2024, 1, 1), "a", "424B4", "u"),
        ("2", "B", date(2024, 1, 2), "b", "424B4", None),
        ("3", "C", date(2024, 1, 2), "c", "S-1", "u"),
        ("4", "D", date(2024, 1, 3), "d", "424B4", "u"),
    ]
    return spark.createDataFrame(rows, S.FILING_INDEX)


def test_partitioned_index_is_pruned(spark, tmp_path, plan):
    path = str(tmp_path / "index")
    tables.append(index(spark), path, "batch-1", partition_by="filing_date")
    table = tables.read_table(spark, path, S.FILING_INDEX)
    day = filings.daily_filings(table, "424B4", date(2024, 1, 1))
    assert [r.accession_number for r in day.collect()] == ["a"]
    both = filings.filings_in_range(table, "424B4", date(2024, 1, 1), date(2024, 1, 3))
    assert sorted(r.accession_number for r in both.collect()) == ["a", "d"]
    text = plan(day)
    assert "PartitionFilters: [isnotnull(filing_date" in text
    assert "EqualTo(form_type,424B4)" in text and "IsNotNull(filing_url)" in text


def test_append_keeps_duplicates_and_takes_empty_batches(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.append(index(spark), path, "batch-1")
    tables.append(index(spark), path, "batch-2")
    tables.append(index(spark).limit(0), path, "batch-3")
    assert tables.read_table(spark, path, S.FILING_INDEX).count() == 8
    tables.append(index(spark), path, "batch-2")  # a load that is repeated replaces itself
    table = tables.read_table(spark, path, S.FILING_INDEX)
    assert table.count() == 8 and table.columns == S.FILING_INDEX.names


def test_versions_without_rows_count(spark, tmp_path):
    path = str(tmp_path / "versions")
    assert tables.last_version(spark, path) is None
    for number in (0, 9, 10):
        tables.write_version(index(spark).limit(0), path, number)
    (tmp_path / "versions" / "version=11").mkdir()  # not complete
    assert tables.last_version(spark, path) == 10


def test_rebuild_replaces(spark, tmp_path):
    path = str(tmp_path / "mart")
    tables.rebuild(index(spark), path)
    tables.rebuild(index(spark).limit(1), path)
    assert tables.read_table(spark, path, S.FILING_INDEX).count() == 1


def test_view(spark):
    tables.publish_view(index(spark), "v_index")
    assert spark.table("v_index").count() == 4


def test_csv_export_reads_back(spark, folder, tmp_path):
    fact = W.fact_table(Tables(spark, folder))
    path = str(tmp_path / "export")
    tables.export_csv(fact, path)
    back = tables.read_export(spark, path)
    assert back.columns == fact.columns and back.count() == fact.count()
    assert sorted(map(str, back.collect())) == sorted(map(str, fact.collect()))
    files = sorted((tmp_path / "export").glob("*.csv"))
    assert files[0].read_text().startswith("CIK,COMPANY_NAME,FILING_DATE")


def test_sample_file(spark, folder, tmp_path):
    t = Tables(spark, folder)
    path = str(tmp_path / "samples")
    samples = reports.cover_samples(t["fx_covers"].drop("cover"), t["fx_documents"], 20)
    tables.write_samples(samples, path)
    back = tables.read_samples(spark, path)
    found = {r["index"] for r in back.collect()}
    assert found < set(range(20)) and len(found) > 10  # some documents could not be fetched
    failed = reports.failed_samples(t["fx_covers"].drop("cover"), t["fx_documents"], 20)
    assert {r["index"] for r in failed.collect()} == set(range(20)) - found
    assert {f.name for f in back.schema} == {f.name for f in samples.schema}


def test_batch_of_empty_tables(spark):
    day = date(2024, 1, 1)
    batch = ingest.batch(
        index(spark).limit(0),
        ingest.extract_days(spark.createDataFrame([], S.LANDED_DOCUMENT), day, day),
        spark.createDataFrame([], S.LANDED_BODY),
        spark.createDataFrame([], "accession_number string, raw string"),
        day,
        day,
    )
    assert {name: df.count() for name, df in batch.items()} == {
        "prospectus_filings": 0,
        "companies": 0,
        "offering_terms": 0,
    }
    assert batch["prospectus_filings"].columns == S.FILING_INDEX.names


def test_daily_batch(spark):
    day = date(2024, 1, 1)
    documents = [
        ("1", "a", day, 200, "<p>This is an initial public offering. 20,000 shares</p>"),
        ("1", "a", day, 503, None),
        ("9", "z", day, 200, "<p>not listed in the index</p>"),
        ("4", "d", date(2024, 1, 3), 200, "<p>another day</p>"),
    ]
    bodies = [("1", 200, '{"name": "A"}'), ("1", 200, '{"name": "A2"}'), ("4", 200, "{}")]
    metadata = [(*row, None) for row in bodies]
    args = (
        index(spark),
        ingest.extract_days(spark.createDataFrame(documents, S.LANDED_DOCUMENT), day, day),
        spark.createDataFrame(metadata, S.LANDED_BODY),
        spark.createDataFrame([], "accession_number string, raw string"),
        day,
        day,
    )
    daily = ingest.batch(*args)
    assert [r.cik for r in daily["prospectus_filings"].collect()] == ["1"]
    assert [r.cik for r in daily["companies"].collect()] == ["1"]
    got = {(r.offering_type, r.shares_offered, r.extraction_method)
           for r in daily["offering_terms"].collect()}
    assert got == {("ipo", 20000, "regex"), ("unknown", None, "error")}
    backfill = ingest.batch(*args, mode=T.BACKFILL)
    assert [r.extraction_method for r in backfill["offering_terms"].collect()] == ["regex"]


def test_html_is_never_shuffled(spark, tmp_path, plan):
    path = str(tmp_path / "documents")
    day = date(2024, 1, 1)
    documents = spark.createDataFrame([("1", "a", day, 200, "<p>x</p>")], S.LANDED_DOCUMENT)
    documents.write.partitionBy("filing_date").parquet(path)
    landed = tables.read_table(spark, path, S.LANDED_DOCUMENT)
    responses = spark.createDataFrame([], "accession_number string, raw string")
    extracted = ingest.extract_days(landed, day, day)
    batch = ingest.batch(index(spark), extracted, spark.createDataFrame([], S.LANDED_BODY),
                         responses, day, day)
    text = plan(batch["offering_terms"])
    assert "PartitionFilters: [isnotnull(filing_date" in text
    below_python = text[text.index("ArrowEvalPython") :]
    scan = below_python[: below_python.index("FileScan")]
    assert "Exchange" not in scan
    assert text.count("ArrowEvalPython") == 1


def test_checks_let_null_pass(spark):
    df = spark.createDataFrame([("a", 1), ("a", 20), ("b", None), (None, 5)], "k string, v int")
    assert [tuple(r) for r in quality.unique(df, "k").collect()] == [("a", 2)]
    assert quality.not_null(df, "v").count() == 1
    assert quality.accepted_values(df, "k", ["b"]).count() == 2
    assert [r.v for r in quality.accepted_range(df, "v", 1, 5).collect()] == [20]
    assert [r.v for r in quality.expression_is_true(df, "v > 1").collect()] == [1]


def test_suite_counts_failures(spark, folder):
    t = Tables(spark, folder)
    bad = t["fx_companies"].limit(1)
    companies = t["fx_companies"].unionByName(bad).unionByName(bad.withColumn("cik", F.lit(None)))
    report = quality.report({"companies": companies})
    assert {r.test: r.failures for r in report.collect()} == {"unique": 1, "not_null": 1}
    assert len(quality.suite()) == 13


def test_suite_reads_every_table_once(spark, folder, tmp_path, plan):
    t, path = Tables(spark, folder), str(tmp_path / "companies")
    t["fx_companies"].write.parquet(path)
    report = quality.report({"companies": spark.read.parquet(path)})
    assert plan(report).count("FileScan") == 1
    nothing = quality.report({"companies": spark.read.parquet(path).limit(0)})
    assert {r.test: r.failures for r in nothing.collect()} == {"unique": 0, "not_null": 0}


def test_suite_takes_a_second_key(spark, monkeypatch):
    checks = [quality.Check("unique", "t", "a"), quality.Check("unique", "t", "b"),
              quality.Check("not_null", "t", "a", F.col("a").isNull())]
    monkeypatch.setattr(quality, "suite", lambda: checks)
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 2), (None, 3)], "a int, b int")
    found = {(r.test, r.column): r.failures for r in quality.report({"t": df, "u": df}).collect()}
    assert found == {("unique", "a"): 1, ("unique", "b"): 1, ("not_null", "a"): 2}


@pytest.mark.parametrize("name", ["extract_terms", "backfill_terms", "fallback_requests"])
def test_no_text_is_shuffled_before_the_parser(spark, folder, plan, name):
    """In the registered queries too: what is shuffled below the parser has no HTML in it."""
    text = plan(QUERIES[name](spark, folder))
    below = text[text.index("ArrowEvalPython") :]
    below = below[: below.index("FileScan")]
    for line in below.splitlines():
        assert "Exchange" not in line or "html" not in line
    first = below.index("Exchange") if "Exchange" in below else len(below)
    assert "<html>" in below[:first]  # made after the shuffle of its parts
