from datetime import date

from pyspark.sql import functions as F

from greenshoe.llm.url_lists import judge, validity_intervals

ENTRY = "list string, verdict string, pattern string, action string, effective_on date"


def day(n):
    return date(2024, 1, n)


def entries(spark):
    return spark.createDataFrame(
        [
            ("l", "block", "Example.com", "add", day(5)), ("l", "block", "Example.com", "add", day(7)),
            ("l", "block", "example.com", "remove", day(10)), ("l", "block", "example.com", "add", day(20)),
            ("l", "block", "example.com", "remove", day(20)), ("l", "block", "example.com", "add", day(25)),
            ("l", "block", "example.com", "add", day(25)),
            ("a", "allow", "www.example.com/ok//b/", "add", day(1)),
            ("a", "allow", "both.org", "add", day(1)), ("l", "block", "both.org", "add", day(1)),
            (None, "block", "x.org", "add", day(1)), ("l", "block", None, "add", day(1)),
            ("l", "block", "x.org", "add", None), ("l", "block", "x.org", "drop", day(1)),
        ],
        ENTRY,
    )


def test_intervals(spark):
    lowered = entries(spark).withColumn("pattern", F.lower("pattern"))
    rows = validity_intervals(lowered).where("pattern = 'example.com'").orderBy("valid_from").collect()
    # Of two changes on one day the removal holds.
    assert [(r["valid_from"], r["valid_to"]) for r in rows] == [
        (day(5), day(7)), (day(7), day(10)), (day(25), None)
    ]


def test_as_of(spark):
    cases = [
        ("http://example.com/", 4, "unlisted"), ("http://example.com/", 5, "block"),
        ("https://u:p@a.b.EXAMPLE.com.:80/x?y#z", 9, "block"), ("http://example.com", 10, "unlisted"),
        ("http://example.com", 20, "unlisted"), ("http://example.com", 31, "block"),
        ("http://www.example.com/ok/b", 6, "allow"), ("http://www.example.com//ok/b/c?d", 6, "allow"),
        ("http://www.example.com/ok/bc", 6, "block"), ("http://example.com/ok/b", 6, "block"),
        ("http://notexample.com/", 6, "unlisted"), ("http://both.org", 6, "allow"),
        ("http://x.org/", 6, "unlisted"), ("no url", 6, "unlisted"), (None, 6, "unlisted"),
        ("http:///path", 6, "unlisted"), ("http://example.com/" + "a/" * 50_000, 6, "block"),
    ]
    rows = [(i, u, day(n), "old", 1) for i, (u, n, _) in enumerate(cases)]
    rows += [(100, "http://example.com/", None, "old", 1), (101, "http://both.org", day(6), "old", 1)]
    rows.append(rows[-1])
    schema = "page_id long, url string, fetched_on date, verdict string, _url int"
    found = judge(spark.createDataFrame(rows, schema), entries(spark))
    assert found.columns == ["page_id", "url", "fetched_on", "_url", "verdict", "list", "pattern", "valid_from"]
    verdicts = [(r["page_id"], r["verdict"]) for r in found.orderBy("page_id").collect()]
    assert verdicts == [(i, v) for i, (_, _, v) in enumerate(cases)] + [
        (100, "unlisted"), (101, "allow"), (101, "allow")
    ]


def test_empty_tables(spark):
    none = spark.createDataFrame([], ENTRY)
    pages = spark.createDataFrame([(1, "http://a.b/c", day(1))], "page_id long, url string, fetched_on date")
    assert judge(pages, none).first()["verdict"] == "unlisted"
    assert judge(pages.limit(0), entries(spark)).count() == 0


def test_no_python(spark, plan):
    pages = spark.createDataFrame([(1, "http://a.b/c", day(1))], "page_id long, url string, fetched_on date")
    text = plan(judge(pages, entries(spark)))
    assert "Python" not in text and "Arrow" not in text
