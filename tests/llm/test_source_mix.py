import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from greenshoe.llm import source_mix as M


def brute_targets(sizes):
    """Round by round: cap, reshare the excess by weight among those not capped."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "a", "B", "é", "z", "\U0001f600", "￮"]
    sizes = {s: rng.choice([0, 1, 10, 100, 10_000]) * rng.randrange(1, 5) for s in names[: 3 + seed]}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r["source"]: r["target"] for r in M.targets(df).collect()}
    expected = brute_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[s], expected[s], rel_tol=1e-9, abs_tol=1e-9) for s in found)


def test_moment_inverts_the_integral(spark):
    df = spark.range(300).select((F.col("id") % 3).cast("int").alias("number"), ((F.col("id") + 0.5) / 300).alias("u"))
    rows = df.select("number", "u", M.moment(F.col("u"), M.curriculum()).alias("t")).collect()

    def share(knots, t):
        whole = done = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            whole += (t1 - t0) * (w0 + w1) / 2
            x = min(max(t - t0, 0), t1 - t0)
            done += w0 * x + (w1 - w0) * x * x / (2 * (t1 - t0))
        return done / whole

    for r in rows:
        assert math.isclose(share(M.CURRICULA[r["number"]], r["t"]), r["u"], abs_tol=1e-9)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3_000):
        source = rng.choices(["big", "mid", "tiny", None], [60, 30, 2, 8])[0]
        rows.append((i, " ".join(["w"] * rng.randrange(0, 40)), source, "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, position string").cache()


def test_plan(corpus, scratch):
    documents, order = M.training_plan(corpus, scratch)
    docs, order = documents.collect(), order.collect()
    sizes, taken, targets = Counter(), Counter(), {}
    for d in docs:
        sizes[d["source"]] += d["size"]
        taken[d["source"]] += d["times"] * d["size"]
        targets[d["source"]] = d["target"]
        assert 0 <= d["times"] <= 3 and d["source_size"] > 0
    expected = brute_targets(sizes)
    for s in sizes:
        assert math.isclose(targets[s], expected[s], rel_tol=1e-9)
        assert abs(taken[s] - targets[s]) <= 20  # half of the longest document
    assert Counter(r["row"] for r in order) == {d["row"]: d["times"] for d in docs if d["times"]}
    positions = [r["position"] for r in order]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_shares_follow_the_schedule(corpus, scratch):
    documents, order = M.training_plan(corpus, scratch)
    size = {d["row"]: (d["size"], d["number"], d["target"]) for d in documents.collect()}
    halves = Counter()
    for r in order.collect():
        words, number, target = size[r["row"]]
        halves[number, r["position"] < 0.5] += words / target
    for number in range(4):
        knots = M.CURRICULA[number % 3]
        first = {0: 0.5, 1: 0.375 / 1.125, 2: 0.75 / 1.125}[number % 3]
        assert abs(halves[number, True] - first) < 0.05, (number, knots)


def test_reruns_agree(corpus, scratch):
    first = sorted((r["doc_id"], r["times"]) for r in M.training_plan(corpus, scratch)[0].collect())
    scratch.root += "-again"
    again = M.training_plan(corpus.repartition(7), scratch)[0].collect()
    assert first == sorted((r["doc_id"], r["times"]) for r in again)


def test_mixed_documents(corpus, odd, nothing, scratch):
    documents, order = M.training_plan(corpus, scratch)
    mixed = M.mixed_documents(corpus, order)
    times = {d["doc_id"]: d["times"] for d in documents.collect() if d["times"]}
    rows = mixed.collect()
    assert mixed.columns == corpus.columns
    assert Counter(r["doc_id"] for r in rows) == times
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in order.collect()]
    scratch.root += "-odd"
    documents, order = M.training_plan(odd, scratch)
    assert M.mixed_documents(odd, order).count() == sum(d["times"] for d in documents.collect())
    assert documents.count() == odd.count()
    scratch.root += "-empty"
    assert M.training_plan(nothing, scratch)[0].count() == 0
