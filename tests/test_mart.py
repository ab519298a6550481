"""The mart on published figures and on its edge cases."""

import csv
from datetime import date, datetime
from pathlib import Path

import pytest

from greenshoe import schemas as S
from greenshoe.functions.valuation import sector
from greenshoe.plans import mart, staging

GOLDEN = list(csv.DictReader(open(Path(__file__).parent / "golden_offerings.csv")))


def raw_from(spark, golden):
    """The four raw tables that the published rows come from."""
    when = datetime(2025, 1, 1)
    filings = {
        (r["cik"], "Name", date.fromisoformat(r["filing_date"]), r["accession_number"], "424B4", "u", when)
        for r in golden
    }
    price = lambda r: float(r["final_price"])
    terms = [
        (r["cik"], r["accession_number"], "ipo", int(r["shares_offered"]), price(r), price(r), "regex", when)
        for r in golden
    ]
    companies = {(r["cik"], "Other name", r["sic_code"], "D", "DE", "1231", when) for r in golden}
    financials = {
        (r["cik"], None, float(r["trailing_revenue"]),
         int(r["shares_outstanding"]) if r["shares_outstanding"] else None, "Revenues")
        for r in golden if r["trailing_revenue"]
    }
    terms_schema = (
        "cik string, accession_number string, offering_type string, shares_offered bigint, price_low"
        " double, price_high double, extraction_method string, extracted_at timestamp"
    )
    return (
        spark.createDataFrame(sorted(filings), S.PROSPECTUS_FILINGS),
        spark.createDataFrame(terms, terms_schema),
        spark.createDataFrame(sorted(companies), S.COMPANIES),
        spark.createDataFrame(sorted(financials, key=str), S.POST_IPO_FINANCIALS),
    )


@pytest.mark.parametrize("rows_per_part", [1_000_000, 1])
def test_published_rows(spark, rows_per_part):
    base = mart.mart_base(*raw_from(spark, GOLDEN), rows_per_part=rows_per_part)
    got = {r.accession_number: r for r in mart.with_benchmark(base).collect()}
    assert len(got) == len(GOLDEN) == 18
    for expected in GOLDEN:
        row = got[expected["accession_number"]].asDict()
        assert row["company_name"] == "Name"  # of the filing, not of the company
        for column, text in expected.items():
            if text == "":
                assert row[column] is None
            elif isinstance(row[column], float):
                assert row[column] == pytest.approx(float(text), rel=1e-8)
            else:
                assert str(row[column]) == text


def test_fact_table_has_its_schema(spark):
    fact = mart.fct_ipo_offerings(*raw_from(spark, GOLDEN))
    assert fact.columns == S.FCT_IPO_OFFERINGS.names
    assert [f.dataType for f in fact.schema] == [f.dataType for f in S.FCT_IPO_OFFERINGS]


def test_decimal_prices(spark):
    filings, terms, companies, financials = raw_from(spark, GOLDEN)
    exact = spark.createDataFrame(terms.collect(), terms.schema).selectExpr(
        "cik", "accession_number", "offering_type", "shares_offered",
        "cast(price_low as decimal(18,2)) price_low", "cast(price_high as decimal(18,2)) price_high",
        "extraction_method", "extracted_at",
    )
    base = mart.mart_base(filings, exact, companies, financials)
    got = {r.accession_number: r.gross_proceeds for r in base.collect()}
    assert {a: float(v) for a, v in got.items()} == {
        r["accession_number"]: float(r["gross_proceeds"]) for r in GOLDEN
    }


def test_zero_shares_outstanding_count(spark):
    golden = [dict(GOLDEN[0], shares_outstanding="0")]
    (row,) = mart.with_benchmark(mart.mart_base(*raw_from(spark, golden))).collect()
    assert row.implied_market_cap == 0 and row.price_to_sales_ratio == 0


def test_companies_without_sector_are_a_group(spark):
    filings, terms, companies, financials = raw_from(spark, GOLDEN)
    fact = mart.with_benchmark(mart.mart_base(filings, terms, companies.limit(0), financials))
    rows = fact.collect()
    assert len(rows) == 18 and {r.sector for r in rows} == {None}
    assert len({r.sector_median_ps for r in rows}) == 1 and rows[0].sector_median_ps is not None


def test_rows_are_priced_ipos_with_matching_company(spark, folder):
    from greenshoe.cases.derived import Tables
    from greenshoe.cases.warehouse import RAW

    t = Tables(spark, folder)
    filings, terms, companies, financials = (t[name] for name in RAW)
    base = mart.mart_base(filings, terms, companies, financials)
    priced = mart.ipo_terms(staging.stg_offering_terms(terms))
    expected = staging.stg_prospectus_filings(filings).join(priced, ["cik", "accession_number"])
    assert base.count() == expected.count() == base.select("accession_number").distinct().count()


def test_sectors_compare_as_strings(spark):
    codes = ["7370", "73700", "737", "2839", "8731", "6411", "6412", "6726", None, ""]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = {r.c: r.s for r in df.select("c", sector(df.c).alias("s")).collect()}
    assert got == {
        "7370": "Software & IT Services",
        "73700": "Software & IT Services",
        "737": "Other",
        "2839": "Pharmaceuticals",
        "8731": "Biotech R&D",
        "6411": "Insurance",
        "6412": "Other",
        "6726": "Investment Funds",
        None: None,
        "": "Other",
    }


def test_plan_shuffles_each_raw_table_once(spark, folder, plan):
    """With nothing small enough to broadcast, filings and terms meet without a second shuffle."""
    from greenshoe.cases.derived import Tables

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, folder)
        joined = mart.filings_with_terms(
            staging.stg_prospectus_filings(t["fx_prospectus_filings"]),
            mart.ipo_terms(staging.stg_offering_terms(t["fx_offering_terms"])),
        )
        text = plan(joined)
        assert text.count("Exchange hashpartitioning") == 2
        assert "SortMergeJoin" in text and "Cartesian" not in text and "NestedLoop" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
