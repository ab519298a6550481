import json

from greenshoe.plans.enrichment import enrich, post_ipo_financials
from greenshoe.sources.landed import company_facts, company_metadata, parsed_facts, triage


def fact(end, val, form="10-K", fp="FY"):
    return {"end": end, "val": val, "form": form, "fp": fp}


def usd(*facts):
    return {"units": {"USD": list(facts)}}


def shares(*facts):
    return {"units": {"shares": list(facts)}}


BODIES = {
    # The first of two facts with the same end wins; shares take any form.
    "1": {"us-gaap": {
        "Revenues": usd(fact("2023-12-31", 5), fact("2024-12-31", 7),
                        fact("2024-12-31", 9, "10-K/A"), fact("2025-03-31", 99, "10-Q", "Q1")),
        "CommonStockSharesOutstanding": shares(fact("2024-12-31", 100), fact("2025-03-31", 120, "10-Q"))}},
    # A tag without annual facts gives way to the next one.
    "2": {"us-gaap": {"Revenues": usd(fact("2024-03-31", 1, "10-Q", "Q1")),
                      "SalesRevenueNet": usd(fact("2022-12-31", 11))},
          "dei": {"EntityCommonStockSharesOutstanding": shares(fact("2022-12-31", 55.0))}},
    "3": {"us-gaap": {"Assets": usd(fact("2024-12-31", 1))}},
    "4": {},
    # The year end looks at any form, the revenue does not.
    "5": {"us-gaap": {"Revenues": usd(fact("2023-12-31", 4, "10-KT"), fact("2024-12-31", 8, "20-F"))}},
    # us-gaap goes before dei for each tag; an empty list is passed over.
    "6": {"us-gaap": {"Revenues": usd(fact("2023-12-31", 4)),
                      "CommonStockSharesOutstanding": shares(),
                      "EntityCommonStockSharesOutstanding": shares(fact("2020-01-01", 2))},
          "dei": {"CommonStockSharesOutstanding": shares(fact("2019-01-01", 3))}},
    # A missing end counts as the smallest.
    "7": {"us-gaap": {"Revenues": usd({"val": 1, "form": "10-K", "fp": "FY"}, fact("2020-12-31", 2))}},
}

EXPECTED = {
    "1": ("2024-12-31", 7.0, 120, "Revenues"),
    "2": (None, 11.0, 55, "SalesRevenueNet"),
    "5": ("2024-12-31", 4.0, None, "Revenues"),
    "6": ("2023-12-31", 4.0, 3, "Revenues"),
    "7": ("2020-12-31", 2.0, None, "Revenues"),
}


def landed(spark, extra=()):
    rows = [(cik, 200, json.dumps({"facts": facts})) for cik, facts in BODIES.items()]
    return spark.createDataFrame(rows + list(extra), "cik string, http_status int, body string")


def test_financials(spark):
    extra = [("8", 404, None), ("9", 500, json.dumps({"facts": BODIES["1"]})), ("10", 200, "<html>")]
    got = {row.cik: tuple(row)[1:] for row in post_ipo_financials(landed(spark, extra)).collect()}
    assert got == EXPECTED


def test_chosen_fact_without_figure_drops_the_company(spark):
    bodies = [
        ("a", {"us-gaap": {"Revenues": usd({"end": "2024-12-31", "form": "10-K", "fp": "FY"})}}),
        ("b", {"us-gaap": {"Revenues": usd(fact("2024-12-31", 5)),
                           "CommonStockSharesOutstanding": shares({"end": "2024-12-31"})}}),
        ("c", {"us-gaap": {"Revenues": usd({"val": 5, "form": "10-K", "fp": "FY"})}}),
    ]
    rows = [(cik, 200, json.dumps({"facts": facts})) for cik, facts in bodies]
    df = spark.createDataFrame(rows, "cik string, http_status int, body string")
    assert post_ipo_financials(df).count() == 0


def test_broken_bodies_are_skipped(spark):
    good = json.dumps({"facts": BODIES["1"]})
    bad = [good[:-5], good + " x", good.replace('"', "'"), "[" + good + "]", "null", ""]
    rows = [(str(i), 200, body) for i, body in enumerate([good + "\n", *bad])]
    df = spark.createDataFrame(rows, "cik string, http_status int, body string")
    assert [row.cik for row in post_ipo_financials(df).collect()] == ["0"]
    assert [row.cik for row in company_metadata(df).collect()] == ["0"]


def stored(df, tmp_path):
    path = str(tmp_path / "parsed")
    parsed_facts(df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_parsed_bodies_give_the_same(spark, tmp_path):
    """As VARIANTs in a table, and as text where a VARIANT cannot hold a body."""
    good = json.dumps({"facts": BODIES["1"]})
    extra = [
        ("8", 404, None), ("9", 500, good), ("10", 200, "<html>"), ("11", 200, good[:-5]),
        ("12", 200, good + " x"), ("13", 200, "[" + good + "]"), ("14", 200, "null"), ("15", 200, ""),
        ("16", 200, good.replace("'", '"') + "\n"), ("17", 200, good[:-1] + ', "facts": {}}'),
        ("18", 200, good.replace("}}}}", '}}}, "other": {"x": 1, "x": 2}}}')),
        ("19", 200, '{"facts": 5}'), ("20", 200, '{"facts": {"us-gaap": {"Revenues": [1]}}}'),
        ("21", 200, json.dumps({"facts": {"us-gaap": {"Revenues": usd(fact("2024-12-31", "12"))}}})),
    ]
    df = landed(spark, extra)
    table = stored(df, tmp_path)
    assert table.schema["parsed"].dataType.simpleString() == "variant"
    kept = {r.cik: r.has for r in table.selectExpr("cik", "body IS NOT NULL AS has").collect()}
    assert not any(kept[cik] for cik in BODIES) and kept["18"]
    results = [sorted(map(str, company_facts(x).collect())) for x in (df, table)]
    assert results[0] == results[1]
    assert EXPECTED == {
        row.cik: tuple(row)[1:] for row in post_ipo_financials(table).collect() if row.cik in BODIES
    }


def test_what_is_no_fact_is_passed_over_in_parsed_bodies(spark, tmp_path):
    """As text such a body is skipped whole."""
    body = json.dumps({"facts": {"us-gaap": {"Revenues": usd(fact("2024-12-31", 12), 7)}}})
    df = spark.createDataFrame([("1", 200, body)], "cik string, http_status int, body string")
    assert post_ipo_financials(df).count() == 0
    assert post_ipo_financials(stored(df, tmp_path)).first().trailing_revenue == 12.0


def test_figures_of_parsed_bodies_keep_their_digits(spark, tmp_path):
    numbers = ["7", "7.0", "1.5", "12345678901234", "1e3", "1.25e10", "0.1", "-3", "123456789.125"]
    rows = []
    for n, number in enumerate(numbers):
        body = json.dumps({"facts": {"us-gaap": {"Revenues": usd(fact("2024-12-31", "@"))},
                                     "dei": {"EntityCommonStockSharesOutstanding": shares(fact("2024-12-31", "@"))}}})
        rows.append((str(n), 200, body.replace('"@"', number)))
    df = spark.createDataFrame(rows, "cik string, http_status int, body string")
    results = [sorted(map(tuple, post_ipo_financials(x).collect())) for x in (df, stored(df, tmp_path))]
    assert results[0] == results[1] and [r[2] for r in results[0]] == [float(n) for n in numbers]


def test_parsed_text_is_not_read_again(spark, plan, tmp_path):
    """The scan itself looks the tags up; no other leaves it."""
    text = plan(company_facts(stored(landed(spark), tmp_path)))
    assert "Exchange" not in text and "parsed:struct<0:struct<facts:struct<us-gaap" in text


def test_no_shuffle(spark, plan):
    assert "Exchange" not in plan(company_facts(landed(spark)))


def test_enrich_keeps_eligible_companies(spark):
    from datetime import date

    mart = spark.createDataFrame(
        [("1", date(2024, 2, 29)), ("2", date(2024, 3, 1)), ("5", date(2020, 1, 1)), ("5", date(2024, 8, 1))],
        "cik string, filing_date date",
    )
    got = enrich(landed(spark), mart, date(2024, 8, 31))
    assert sorted(row.cik for row in got.collect()) == ["1", "5"]


def test_metadata(spark):
    body = {"name": "A", "sic": "7372", "sicDescription": "S", "stateOfIncorporation": "DE",
            "fiscalYearEnd": "1231", "tickers": ["X"]}
    rows = [
        ("1", 200, json.dumps(body)),
        ("2", 200, json.dumps({"name": "B", "sic": None})),
        ("3", 404, json.dumps(body)),
        ("4", 503, None),
        ("5", 200, "not json"),
        ("6", 200, "[1]"),
        ("7", 200, "{}"),
        ("8", 200, json.dumps({"sic": 7372})),
        ("9", None, None),
    ]
    df = spark.createDataFrame(rows, "cik string, http_status int, body string")
    got = {row.cik: tuple(row)[1:] for row in company_metadata(df).collect()}
    assert got == {
        "1": ("A", "7372", "S", "DE", "1231"),
        "2": ("B", None, None, None, None),
        "7": (None,) * 5,
        "8": (None, "7372", None, None, None),
    }
    outcomes = {row.cik: row.outcome for row in triage(df).collect()}
    assert outcomes["1"] == "ok" and outcomes["3"] == "not_found"
    assert outcomes["4"] == outcomes["9"] == "failed"
