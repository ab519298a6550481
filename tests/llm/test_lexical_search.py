import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from greenshoe.llm import lexical_search, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, top=10):
    """(item_id, rank, doc_id, score) from (doc_id, text) and (item_id, text)."""
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    sizes = [c.total() for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item, text in items:
        terms = set(plain_terms(text)) & set(df)
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in terms}
        found = []
        for (doc_id, c), size in zip(counts, sizes):
            m = 10 + (90 * size * n) // total if total else 0
            score = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda x: x[:3])
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(found[:top])]
    return Counter(out)


def rows(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def corpus(rng, n):
    """Zipf-like words, copies, ties, very different lengths."""
    vocabulary = [f"w{k}" for k in range(400)]
    odds = [1 / (k + 1) for k in range(400)]
    texts = [" ".join(rng.choices(vocabulary, odds, k=rng.choice([1, 3, 20, 60, 400]))) for _ in range(n)]
    return [(i, texts[rng.randrange(n)] if rng.random() < 0.3 else t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("block_terms", [50, 10**6])
def test_against_brute_force(spark, scratch, block_terms):
    rng = random.Random(4)
    docs = corpus(rng, 700)
    items = [(k, " ".join(docs[rng.randrange(700)][1].split()[:25])) for k in range(20)]
    items += [(100, "w0 w0 w1 unknown"), (101, ""), (102, None), (103, "unknown"), (104, "W399; w398")]
    found = lexical_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
        scratch,
        block_terms=block_terms,
    )
    assert rows(found) == brute_force(docs, items)


def test_whole_tables(spark, folder):
    table = lambda name: [tuple(r) for r in queries.table(spark, folder, name).collect()]
    docs = [(r[0], r[1]) for r in table("documents")]
    assert rows(queries.op11_lexical_search(spark, folder)) == brute_force(docs, table("benchmark"))


def test_odd_rows(spark, odd, nothing, scratch):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    items = [(1, docs[0][1]), (2, "ünï ÇØDÉ çødé"), (2, "one"), (None, "two"), (None, "two"), (3, None)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    found = lexical_search.search(odd, bench, scratch)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    items.remove((None, "two"))  # repeated items are one
    assert rows(found) == brute_force(docs, items)


def test_nothing_at_all(spark, odd, nothing, tmp_path):
    from greenshoe.llm.shared import Scratch

    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    for n, (docs, items) in enumerate([(nothing, bench), (odd, bench.limit(0)), (nothing, bench.limit(0))]):
        scratch = Scratch(spark, "test")
        scratch.root = f"file://{tmp_path}/{n}"
        assert lexical_search.search(docs, items, scratch).collect() == []


def test_terms_of_a_text_in_slices():
    words = [f"Wort{k % 977}ß" for k in range(700_000)]
    counts = lexical_search.terms_of("; ".join(words).encode())
    assert counts == Counter(w.translate(LOWER).encode() for w in words)


def make_bucket(rng, n, n_terms):
    impacts = [{t: rng.randrange(1, 10**6) for t in range(n_terms) if rng.random() < 0.2} for _ in range(n)]
    impacts.sort(key=lambda v: -sum(x * x for x in v.values()))
    names = [str(t).encode() for t in range(n_terms)]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(n), pa.int64()),
            pa.array([math.sqrt(sum(x * x for x in v.values())) for v in impacts]),
            pa.array([[names[t] for t in v] for v in impacts], pa.list_(pa.binary())),
            pa.array([list(v.values()) for v in impacts], pa.list_(pa.int64())),
        ],
        ["doc_id", "length", "terms", "impacts"],
    )
    return impacts, lexical_search.Bucket(batch, pa.array(names, pa.binary()))


def test_bounds_lose_nothing_and_prune():
    rng = random.Random(8)
    impacts, bucket = make_bucket(rng, 300, 40)
    pruned = 0
    for _ in range(60):
        chosen = rng.sample(range(40), 12)
        weights = np.sort(np.array([rng.randrange(0, 9000) for _ in chosen]))[::-1]
        terms = np.array(chosen)
        exact = [sum(w * v.get(t, 0) for t, w in zip(chosen, weights.tolist())) for v in impacts]
        floor = sorted(exact)[rng.choice([-1, -10, -100])]
        length = float(np.sqrt((weights.astype(float) ** 2).sum()))
        found, scores = bucket.survivors(terms, weights, length, floor)
        assert {i for i, s in enumerate(exact) if s >= floor} <= set(found.tolist())
        assert scores.tolist() == [exact[i] for i in found.tolist()]
        pruned += 300 - len(found)
    assert pruned > 60 * 300 / 5
    assert (bucket.slot == -1).all()


def test_a_bucket_of_short_vectors_is_not_opened(spark, scratch, monkeypatch):
    """Once the best of a task are known, items are done with what is shorter."""
    long = [(i, "alpha beta gamma delta") for i in range(30)]
    short = [(100 + i, "alpha " + " ".join(f"x{i}y{k}" for k in range(200))) for i in range(5_000)]
    docs = spark.createDataFrame(long + short, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    found = lexical_search.search(docs, items, scratch)
    assert rows(found) == brute_force(long + short, [(1, "alpha beta gamma delta")])
    block = spark.read.parquet(scratch.path("weighted"))
    gathered = lexical_search.collect_items(block, 10)
    gathered.least = [next(iter(rows(found)))[3]]
    vectors = spark.read.parquet(scratch.path("vectors"))
    assert vectors.count() == 5_030 and gathered.shortest() > 0
    assert len(gathered.vocabulary) == 4 and gathered.seeds[0] is not None
