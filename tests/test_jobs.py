"""The whole cycle over folders: ingest, mart, enrichment, mart again."""

import json
from datetime import date, datetime

from greenshoe import schemas as S
from greenshoe.plans import ingest, jobs
from greenshoe.plans.terms import BACKFILL, fold_responses, typed

DAY1, DAY2 = date(2024, 1, 2), date(2024, 1, 3)


def html(shares, price):
    return (
        "<html><body><p>This is an initial public offering. We are offering "
        f"{shares:,} ordinary shares.</p><p>The initial public offering price per share is"
        f" ${price:.2f}</p></body></html>"
    )


def land(w, table, rows, **options):
    schema = jobs.LANDED[table]
    rows = [row + (None,) * (len(schema) - len(row)) for row in rows]
    df = w.spark.createDataFrame(rows, schema)
    df.write.mode("append").partitionBy(*options.get("by", [])).parquet(w.path("landed", table))


def landed(w):
    index = [
        ("1", "One", DAY1, "a", "424B4", "u"),
        ("2", "Two", DAY1, "b", "424B4", "u"),
        ("3", "Three", DAY2, "c", "424B4", "u"),
        ("4", "Four", DAY2, "d", "424B4", None),
        ("5", "Five", DAY2, "e", "424B4", "u"),
    ]
    land(w, "filing_index", index, by=["filing_date"])
    bodies = {"a": (1, DAY1, html(100_000, 10)), "b": (2, DAY1, html(200_000, 20)),
              "c": (3, DAY2, html(300_000, 30))}
    documents = [(str(c), acc, day, 200, body) for acc, (c, day, body) in bodies.items()]
    documents += [("5", "e", DAY2, 503, None)]
    land(w, "documents", documents, by=["filing_date"])
    meta = [(str(c), 200, json.dumps({"name": f"N{c}", "sic": "7372"})) for c in (1, 2, 3)]
    land(w, "submissions", meta)
    fact = {"end": "2023-12-31", "val": 1_000_000, "form": "10-K", "fp": "FY"}
    facts = json.dumps({"facts": {"us-gaap": {"Revenues": {"units": {"USD": [fact]}}}}})
    land(w, "company_facts", [("1", 200, facts), ("2", 404, None), ("3", 200, facts)])
    land(w, "fallback_responses", [])


def flags(w):
    return {r.accession_number: (r.sector, r.implied_market_cap, r.valuation_flag)
            for r in w.fact().collect()}


def test_cycle(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path))
    landed(w)
    jobs.create_raw(w)
    jobs.extract_days(w, DAY1, DAY2)
    jobs.ingest_days(w, DAY1, DAY1, version=1)
    jobs.ingest_days(w, DAY2, DAY2, version=2)
    jobs.ingest_days(w, DAY2, DAY2, version=3)  # repeated: duplicates are removed when read
    assert w.raw("prospectus_filings").count() == 6
    assert w.raw("offering_terms").where("extraction_method = 'error'").count() == 2
    assert w.raw("offering_terms").schema == S.OFFERING_TERMS
    assert sorted(r.cik for r in w.companies().collect()) == ["1", "2", "3"]

    jobs.build_mart(w)
    software = "Software & IT Services"
    before = flags(w)
    assert before == {
        "a": (software, 1_000_000, "No revenue data"),
        "b": (software, 4_000_000, "No revenue data"),
        "c": (software, 9_000_000, "No revenue data"),
    }
    jobs.enrich(w, date(2024, 7, 1))  # too early for all
    assert w.raw("post_ipo_financials").count() == 0
    jobs.parse_facts(w)
    jobs.enrich(w, date(2024, 7, 3), parsed=True)
    from_parsed = sorted(map(str, w.raw("post_ipo_financials").collect()))
    jobs.enrich(w, date(2024, 7, 3))  # the same load, from text
    assert sorted(map(str, w.raw("post_ipo_financials").collect())) == from_parsed
    assert sorted(r.cik for r in w.raw("post_ipo_financials").collect()) == ["1", "3"]
    jobs.build_mart(w)
    assert {a: flag for a, (_, _, flag) in flags(w).items()} == {
        "a": "Cheaply valued",  # ratios 1 and 9, median 5
        "b": "No revenue data",
        "c": "Richly valued",
    }


def test_backfill_is_one_job_over_the_range(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path))
    landed(w)
    jobs.create_raw(w)
    jobs.extract_days(w, DAY1, DAY2)
    jobs.ingest_days(w, DAY1, DAY2, version=1, mode=BACKFILL)
    assert w.raw("prospectus_filings").count() == 4
    assert sorted(r.accession_number for r in w.raw("offering_terms").collect()) == ["a", "b", "c"]


def test_fallback_goes_between_extraction_and_ingest(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path))
    landed(w)
    jobs.create_raw(w)
    land(w, "filing_index", [("6", "Six", DAY2, "f", "424B4", "u")], by=["filing_date"])
    bare = "<p>This is an initial public offering.</p>"
    land(w, "documents", [("6", "f", DAY2, 200, bare)], by=["filing_date"])
    jobs.extract_days(w, DAY2, DAY2)
    jobs.extract_days(w, DAY2, DAY2)  # replaces its day
    assert w.extracted(DAY2, DAY2).count() == 3
    jobs.request_fallback(w, DAY2, DAY2)
    (request,) = spark.read.json(w.path("staging", "fallback_requests")).collect()
    assert request.accession_number == "f" and "initial public offering" in request.prompt
    answer = '{"offering_type": "ipo", "shares_offered": 50000, "price_low": 4, "price_high": 6}'
    land(w, "fallback_responses", [("f", answer)])
    jobs.ingest_days(w, DAY2, DAY2, version=1)
    (row,) = w.raw("offering_terms").where("accession_number = 'f'").collect()
    assert (row.shares_offered, row.price_low, row.extraction_method) == (50000, 4, "llm")


def test_default_for_a_missing_method(spark):
    df = spark.createDataFrame([(1, None)], "a int, extraction_method string")
    assert jobs.with_default(df, "extraction_method", "regex").first()[1] is None
    assert jobs.with_default(df.drop("extraction_method"), "extraction_method", "regex").first()[1] == "regex"


def test_figures_that_do_not_fit_make_error_rows(spark):
    schema = "cik string, accession_number string, offering_type string, shares_offered double,"
    schema += " price_low double, price_high double, extraction_method string, extracted_at timestamp"
    rows = [("1", "a", "ipo", 5.0, 1e30, 2.5, "llm", None), ("1", "b", "ipo", None, 1.0, 2.5, "llm", None)]
    stored = typed(spark.createDataFrame(rows, schema), S.OFFERING_TERMS)
    bad, good = stored.orderBy("accession_number").collect()
    assert bad[2:7] == ("unknown", None, None, None, "error")
    assert (good.offering_type, good.shares_offered, float(good.price_high)) == ("ipo", None, 2.5)
    assert stored.schema == S.OFFERING_TERMS


def test_a_mart_of_nothing(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path))
    jobs.create_raw(w)
    jobs.build_mart(w)
    assert w.fact().count() == 0 and w.companies().count() == 0


def test_a_day_that_is_run_again_leaves_nothing_stale(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path))
    document = w.path("landed", "documents")
    for body in ("<p>This is an initial public offering.</p>", html(100_000, 10)):
        rows = spark.createDataFrame([("6", "f", DAY2, 200, body)], jobs.LANDED["documents"])
        rows.write.mode("overwrite").partitionBy("filing_date").parquet(document)
        jobs.extract_days(w, DAY1, DAY2)
        jobs.request_fallback(w, DAY1, DAY2)
    assert w.extracted(DAY1, DAY2).count() == 1
    requests = spark.read.schema("accession_number string").json(w.path("staging", "fallback_requests"))
    assert requests.count() == 0


def test_the_newest_answer_counts(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    body = '{"name":"%s","sic":"%s"}'
    landed = spark.createDataFrame(
        [("1", 200, body % ("Zeta", "7372"), early), ("1", 200, body % ("Alpha", "2834"), late)],
        S.LANDED_BODY,
    )
    found = ingest.company_lookup(spark.createDataFrame([("1",)], "cik string"), landed).collect()
    assert [(r.company_name, r.sic_code) for r in found] == [("Alpha", "2834")]
    extracted = spark.createDataFrame(
        [("1", "a", DAY1, "x", "ipo", None, None, None, "regex")], S.EXTRACTED
    )
    answers = spark.createDataFrame(
        [("a", "not json", early), ("a", '{"offering_type":"ipo","shares_offered":20000}', late)],
        S.FALLBACK_RESPONSES,
    )
    (row,) = fold_responses(extracted, answers).collect()
    assert (row.shares_offered, row.extraction_method) == (20000, "llm")
