from greenshoe.plans import terms as T

FENCE, NAN, INF = "```", float("nan"), float("inf")
ANSWERS = {
    f'{FENCE}json\n{{"offering_type":"ipo","shares_offered":20000,"price_low":1.5,"price_high":2}}\n{FENCE}':
        ("ipo", 20000, 1.5, 2.0, "llm"),
    f'  {FENCE}\n{{"offering_type":"spac"}}{FENCE}  ': ("spac", None, None, None, "llm"),
    '{"price_low": 7}': ("unknown", None, 7.0, None, "llm"),
    '{"offering_type": null, "shares_offered": 5}': (None, 5, None, None, "llm"),
    '{"shares_offered": 1.2e6, "price_high": 9000}': ("unknown", 1200000, None, 9000.0, "llm"),
    "not json": ("unknown", None, None, None, "llm_parse_error"),
    "": ("unknown", None, None, None, "llm_parse_error"),
    "[1]": ("unknown", None, None, None, "error"),
    "5": ("unknown", None, None, None, "error"),
    # Figures of the wrong kind are errors, not rounded or left out.
    '{"offering_type": "ipo", "shares_offered": 1.5}': ("unknown", None, None, None, "error"),
    '{"offering_type": "ipo", "shares_offered": "20,000"}': ("unknown", None, None, None, "error"),
    '{"shares_offered": "20000"}': ("unknown", None, None, None, "error"),
    '{"offering_type": "ipo", "shares_offered": true}': ("unknown", None, None, None, "error"),
    '{"price_low": "1.5", "shares_offered": 7}': ("unknown", None, None, None, "error"),
    '{"price_high": [2], "price_low": 1}': ("unknown", None, None, None, "error"),
    '{"shares_offered": null, "price_low": null}': ("unknown", None, None, None, "llm"),
    # Of repeated keys the last counts.
    '{"offering_type":"ipo","offering_type":"spac","shares_offered":50000}': ("spac", 50000, None, None, "llm"),
    '{"price_low": "x", "price_low": 3}': ("unknown", None, 3.0, None, "llm"),
    '{"a": {"b": 1, "b": 2}, "price_low": 4}': ("unknown", None, 4.0, None, "llm"),
    '{"price_low": {"b": 1, "b": 2}}': ("unknown", None, None, None, "error"),
    # Numbers that are none of JSON's own.
    "NaN": ("unknown", None, None, None, "error"),
    "[NaN]": ("unknown", None, None, None, "error"),
    '{"offering_type":"ipo","price_low":NaN}': ("ipo", None, NAN, None, "llm"),
    '{"price_low": -Infinity, "price_high": Infinity}': ("unknown", None, -INF, INF, "llm"),
    '{"price_low": "NaN"}': ("unknown", None, None, None, "error"),
    '{"shares_offered": NaN}': ("unknown", None, None, None, "error"),
    # Nothing may follow the value.
    '{"price_low": 1} x': ("unknown", None, None, None, "llm_parse_error"),
    '{"price_low": 1}}': ("unknown", None, None, None, "llm_parse_error"),
    '{"price_low": 1}, {"price_low": 2}': ("unknown", None, None, None, "llm_parse_error"),
    '"{\\"price_low\\": 1}"': ("unknown", None, None, None, "error"),
    "{'price_low': 1}": ("unknown", None, None, None, "llm_parse_error"),
}


def rows_by(df, key):
    return {row[key]: tuple(row[c] for c in T.TERMS) for row in df.collect()}


def test_parse_responses(spark):
    df = spark.createDataFrame([(raw, raw) for raw in ANSWERS], "accession_number string, raw string")
    found = rows_by(T.parse_responses(df), "accession_number")
    assert found.keys() == ANSWERS.keys()
    assert {k: str(v) for k, v in found.items()} == {k: str(v) for k, v in ANSWERS.items()}


def covers(spark):
    open_ipo = "This is an initial public offering."
    rows = [
        ("a", open_ipo),
        ("b", open_ipo),
        ("c", open_ipo + " 20,000 shares"),
        ("d", open_ipo + " per share $5.00"),
        ("e", "trust account and founder shares"),
        ("f", None),
    ]
    return spark.createDataFrame(rows, "accession_number string, cover string")


def responses(spark):
    answer = '{"offering_type":"ipo","shares_offered":7,"price_low":3,"price_high":3}'
    rows = [(key, answer) for key in "acdef"]
    return spark.createDataFrame(rows, "accession_number string, raw string")


FOLDED = {
    "a": ("ipo", 7, 3.0, 3.0, "llm"),
    "b": ("unknown", None, None, None, "error"),  # its answer never came
    "c": ("ipo", 20000, None, None, "regex"),
    "d": ("ipo", None, 5.0, 5.0, "regex"),
    "e": ("spac", None, None, None, "regex"),
    "f": ("unknown", None, None, None, "error"),
}


def test_fold_responses(spark):
    folded = T.fold_responses(T.extract(covers(spark)), responses(spark))
    assert rows_by(folded, "accession_number") == FOLDED


def test_fold_responses_of_given_filings(spark):
    filings = spark.createDataFrame([("a",), ("c",), ("c",), ("z",)], "accession_number string")
    folded = T.fold_responses(T.extract(covers(spark)), responses(spark), filings)
    assert rows_by(folded, "accession_number") == {key: FOLDED[key] for key in "ac"}


def test_copies_of_one_filing_stay(spark):
    many = covers(spark).where("accession_number = 'a'").crossJoin(spark.range(300)).drop("id")
    extracted = T.extract(many.repartition(8))
    folded = T.fold_responses(extracted, responses(spark))
    assert [row[3:] for row in folded.groupBy("accession_number", "extraction_method",
            "shares_offered").count().collect()] == [(300,)]


def test_requests_hold_the_first_4000_characters(spark):
    long = "This is an initial public offering." + "x" * 5000
    df = spark.createDataFrame([("a", long), ("b", "nothing")], "accession_number string, cover string")
    (row,) = T.fallback_requests(T.extract(df)).collect()
    assert row.accession_number == "a" and row.prompt.endswith("Cover page:\n" + long[:4000])


def test_backfill_drops_error_rows(spark):
    terms = T.extract(covers(spark))
    assert T.keep_for(T.DAILY, terms).count() == 6
    assert T.keep_for(T.BACKFILL, terms).count() == 5


def test_a_repeated_answer_does_not_repeat_the_filing(spark):
    answers = responses(spark).unionByName(responses(spark))
    folded = T.fold_responses(T.extract(covers(spark)), answers)
    assert folded.count() == 6 and rows_by(folded, "accession_number") == FOLDED
