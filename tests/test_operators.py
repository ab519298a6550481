"""Skewed joins, exact medians, latest rows and upserts."""

import math
import random
import statistics
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

from greenshoe.operators import median, semi_join
from greenshoe.operators.latest import latest_by, newest
from greenshoe.operators.median import exact_median
from greenshoe.operators.skew import hot_keys, lookup_join
from greenshoe.operators.upsert import upsert


def skewed(spark):
    """A third of the rows under one key, a third without key, copies among both."""
    rows = [("hot", i % 5) for i in range(1000)] + [(None, i % 3) for i in range(1000)]
    rows += [(f"k{i % 400}", i) for i in range(1000)]
    return spark.createDataFrame(rows, "k string, v int").repartition(8)


def lookup(spark):
    rows = [("hot", "H")] + [(f"k{i}", f"L{i}") for i in range(0, 400, 2)] + [(None, "N")]
    return spark.createDataFrame(rows, "k string, name string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_lookup_join_equals_plain_join(spark, how):
    facts, names = skewed(spark), lookup(spark)
    hot = hot_keys(facts, "k", rows_per_part=50)
    assert [tuple(row) for row in hot.collect()] == [("hot", 20)]
    got = lookup_join(facts, names, "k", hot, how)
    expected = facts.join(names, "k", how)
    assert got.columns == expected.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


def test_every_hot_key_is_split(spark):
    rows = spark.range(30_000).select((F.col("id") % 1_500).alias("k"))
    hot = hot_keys(rows, "k", rows_per_part=10)
    assert hot.count() == 1_500 and {r["_parts"] for r in hot.collect()} == {2}


def test_hot_rows_reach_many_tasks(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = skewed(spark)
        joined = lookup_join(facts, lookup(spark), "k", hot_keys(facts, "k", 50))
        per_task = joined.groupBy(F.spark_partition_id().alias("p"), "k").count()
        for key in ("hot", None):
            counts = [r["count"] for r in per_task.where(F.col("k").eqNullSafe(key)).collect()]
            assert sum(counts) == 1000 and max(counts) < 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def values(seed):
    rng = random.Random(seed)
    groups = {
        "even": [rng.uniform(-5, 5) for _ in range(400)],
        "odd": [rng.expovariate(1) for _ in range(301)],
        "one": [3.25],
        "two": [1.0, 2.0],
        "ties": [7.0] * 500 + [rng.uniform(0, 20) for _ in range(200)],
        "split": [0.0] * 50 + [1.0] * 50,
        None: [rng.gauss(0, 1) for _ in range(100)],
    }
    return groups


@pytest.mark.parametrize("bits", [16, 8, 32])
def test_exact_median(spark, bits):
    groups = values(3)
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("empty", None), ("odd", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: (r["mean"], r["median"]) for r in exact_median(df, "g", "v", bits).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g][1] == pytest.approx(statistics.median(vs), abs=1e-12)
        assert got[g][0] == pytest.approx(statistics.fmean(vs), abs=1e-12)


def test_median_of_many_values_is_exact(spark):
    df = spark.range(200_001).select(
        (F.col("id") % 3).cast("string").alias("g"), (F.hash("id") * 1.0).alias("v")
    )
    expected = dict(df.groupBy("g").agg(F.median("v")).collect())
    got = {r.g: r["median"] for r in exact_median(df, "g", "v").collect()}
    assert got == expected


EDGES = [
    0.0, -0.0, 1.0, -1.0, 2.0, 0.1, 1 / 3, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324,
    2.0**-1023, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"),
    2.0**1023, 4.0 - 2**-51, 4.0, 4.0 + 2**-50, 2.0**52 + 1, 1e-300, 123456.789,
]


def test_keys_order_as_doubles_do(spark):
    rng = random.Random(6)
    numbers = EDGES + [math.ldexp(rng.uniform(-1, 1), rng.randrange(-1060, 1020)) for _ in range(3_000)]
    numbers += [math.nextafter(2.0**k, d) for k in range(-1000, 1000, 37) for d in (0.0, math.inf)]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    keys = {}
    for v, key in median.ordered_key(df, "v", "key").select("v", "key").collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert key == (-bits if v < 0 else bits)
        keys[v] = key
    nan = median.ordered_key(spark.createDataFrame([(float("nan"),)], "v double"), "v", "key").first().key
    assert nan > max(keys.values())


def test_median_of_edges(spark):
    edges = [v for v in EDGES if math.isfinite(v) and abs(v) < 1e300]
    for numbers in (edges, edges[:-1], [float("inf")] * 3 + [1.0], [5e-324] * 3):
        df = spark.createDataFrame([("g", v) for v in numbers], "g string, v double")
        assert exact_median(df, "g", "v").first()["median"] == statistics.median(numbers)
    assert exact_median(df.limit(0), "g", "v").collect() == []


@pytest.mark.parametrize("distribution", ["hash(id) * 1.0", "1e6 + rand(3)"])
def test_a_window_task_holds_counters_only(spark, monkeypatch, distribution):
    """As many rows are ranked for a group of one size as for one four times as large."""
    ranked, peaks = median._ranked, {}

    for rows in (20_000, 80_000):
        counted = []

        def watched(counts, by):
            counted.append(counts.groupBy(*by).count().agg(F.max("count")).first()[0])
            return ranked(counts, by)

        monkeypatch.setattr(median, "_ranked", watched)
        df = spark.range(rows).select(F.lit("g").alias("g"), F.expr(distribution).alias("v"))
        exact_median(df, "g", "v", bits=8)
        peaks[rows] = max(counted)
        assert len(counted) == 8 and peaks[rows] <= 2**8
    assert peaks[80_000] <= peaks[20_000] * 1.3


def test_many_groups_are_not_broadcast(spark, monkeypatch, plan):
    monkeypatch.setattr(median, "MOST_TARGETS", 10)
    rows = [(f"g{i % 40}", float(i * i % 101)) for i in range(2_000)]
    groups = {g: [v for h, v in rows if h == g] for g, _ in rows}
    got = exact_median(spark.createDataFrame(rows, "g string, v double"), "g", "v")
    assert {r.g: r["median"] for r in got.collect()} == {g: statistics.median(v) for g, v in groups.items()}


# --- semi join -------------------------------------------------------------------------------------


@pytest.fixture
def shuffled(spark):
    """Joins shuffle, as they do for tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def wide(spark, n=4_000):
    return spark.range(n).select(
        F.when(F.col("id") % 50 != 7, F.col("id").cast("string")).alias("k"), F.lit("x").alias("body")
    )


@pytest.mark.parametrize("n_keys", [0, 1, 300])
def test_semi_join_equals_the_plain_one(spark, shuffled, n_keys):
    facts = wide(spark).unionByName(wide(spark))
    rows = [(str(i * 13),) for i in range(n_keys)] * 2 + [("absent",), (None,)] * (n_keys > 0)
    keys = spark.createDataFrame(rows, "k string")
    got = semi_join.semi_join(facts, keys, "k")
    expected = facts.join(keys, "k", "left_semi")
    assert got.columns == facts.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


def test_the_filter_loses_no_key_and_drops_most_others(spark):
    keys = spark.range(5_000).select(F.col("id").cast("string").alias("k"))
    let_through = semi_join.prefilter(wide(spark, 100_000), keys, "k")
    found = {r.k for r in let_through.collect()}
    wanted = {str(i) for i in range(5_000) if i % 50 != 7}
    assert wanted <= found and len(found) < len(wanted) + 95_000 * 0.01


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(semi_join, "MOST_BLOCKS", 2)
    keys = wide(spark).select("k")
    assert semi_join.n_blocks_for(10**12) == 2
    assert semi_join.semi_join(wide(spark), keys, "k").count() == 3_920


def _output(lines, at):
    """The scan or projection that an exchange takes its rows from."""
    return next(x for x in lines[at + 1 :] if "Project" in x or "FileScan" in x)


def test_no_body_of_others_is_shuffled(spark, shuffled, plan, tmp_path):
    """The filter lies below every exchange that carries a body."""
    path = str(tmp_path / "facts")
    wide(spark).write.parquet(path)
    keys = spark.createDataFrame([("1",), ("2",)], "k string")
    joined = semi_join.semi_join(spark.read.parquet(path), keys, "k")
    lines = plan(joined).splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    with_body = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x and "body" in _output(lines, i)]
    assert len(with_body) == 1
    below = lines[with_body[0] + 1 :]
    below = below[: next((i for i, x in enumerate(below) if depth(x) <= depth(lines[with_body[0]])), None)]
    assert any("BroadcastHashJoin [" in x and "shiftleft(_words" in x for x in below)
    assert sum("FileScan" in x and "body" in x for x in below) == 1
    rows = joined.collect()
    assert sorted(r.k for r in rows) == ["1", "2"]


def test_latest_row_wins_and_a_missing_time_counts_as_newest(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", None, "n"), ("b", 9, "z"), ("c", 1, "p"), ("c", 1, "q")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    latest = latest_by(df, ["k"], [newest("t")])
    assert {r.k: r.v for r in latest.collect()} == {"a": "y", "b": "n", "c": "q"}
    again = latest_by(latest, ["k"], [newest("t")])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, latest.collect()))


def test_latest_limits_each_key_before_the_shuffle(spark, plan):
    df = spark.createDataFrame([("a", 1)], "k string, t int").repartition(3, "t")
    text = plan(latest_by(df, ["k"], [newest("t")]))
    assert text.count("WindowGroupLimit") == 2


def test_upsert(spark):
    current = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    incoming = spark.createDataFrame([("b", 2), ("b", 3), ("c", 4)], "k string, v int")
    once = upsert(current, incoming, ["k"], [F.desc("v")])
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 3), ("c", 4)]
    twice = upsert(once, incoming, ["k"], [F.desc("v")])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_of_nothing(spark):
    current = spark.createDataFrame([("a", 1)], "k string, v int")
    assert upsert(current, current.limit(0), ["k"], []).collect() == current.collect()


def test_fewer_columns_hold_the_same_values(spark):
    from greenshoe.plans.staging import stg_prospectus_filings

    rows = [("k", c, n, f, u, 1) for c in "12" for n in "AB" for f in "xy" for u in "pq"]
    names = "accession_number string, cik string, company_name string, form_type string,"
    df = spark.createDataFrame(rows, names + " filing_url string, ingested_at int")
    df = df.withColumn("filing_date", F.current_date())
    few = ["cik", "company_name", "filing_date", "accession_number"]
    whole = stg_prospectus_filings(df).select(*few)
    assert stg_prospectus_filings(df, few).collect() == whole.collect()
