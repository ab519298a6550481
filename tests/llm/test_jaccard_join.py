import random

import pytest
from pyspark.sql import functions as F

from greenshoe.llm import jaccard_join as J
from greenshoe.llm import token_counts
from greenshoe.llm.components import connected_components
from greenshoe.llm.shared import SPACES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    for c in SPACES:
        text = (text or "").replace(c, " ")
    words = [w for w in text.translate(LOWER).split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute(docs):
    sets = [(i, shingle_set(t)) for i, t in docs]
    pairs = []
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            common = len(x & y) if min(len(x), len(y)) * 100 >= 80 * max(len(x), len(y)) else 0
            if common and 100 * common >= 80 * (len(x) + len(y) - common):
                pairs.append((i, j))
    names = roots(pairs, [i for i, _ in sets])
    return {i: (len(x), names[i]) for i, x in sets}


def found(df, scratch):
    rows = J.near_duplicates(df, scratch).collect()
    return rows, {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_test_table(documents, scratch):
    expected = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert len({c for _, c in expected.values()}) < len(expected)
    assert found(documents, scratch)[1] == expected


def families(seed):
    """Families of copies edited more and more, with shared passages and copies in between."""
    rng = random.Random(seed)
    docs = []
    passage = [f"p{i}" for i in range(30)]
    for family in range(12):
        base = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.choice([4, 7, 12, 40, 120]))]
        if family % 3 == 0:
            base += passage
        for _ in range(rng.choice([2, 8, 25])):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.random()}"
            if rng.random() < 0.3:
                copy = copy[rng.randrange(3) :]
            docs.append(" ".join(copy).upper() if rng.random() < 0.2 else "\t".join(copy))
    docs += docs[:10] + ["", "   ", "one", "One", "two words"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, few", [(1, 2), (2, -1), (3, 10**9)])
def test_families(spark, scratch, monkeypatch, seed, few):
    monkeypatch.setattr(J, "FEW_PAIRS", few)  # -1: all rounds of stars
    monkeypatch.setattr(token_counts, "GROUP_TOKENS", 2_000)
    docs = families(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    df.write.parquet(scratch.path("docs"))
    expected = brute(docs)
    assert found(spark.read.parquet(scratch.path("docs")), scratch)[1] == expected


def test_groups_with_one_prefix(spark, scratch):
    """Sets that differ in frequent tokens only have the same prefix: they are verified, too."""
    rng = random.Random(9)
    common = [[f"c{k}t{i}" for i in range(9)] for k in range(40)]
    docs = [" ".join(sum(rng.sample(common, 25), [])) for _ in range(60)]
    head = [f"h{i}" for i in range(60)]
    docs += [" ".join(head + sum(rng.sample(common, 6), [])) for _ in range(30)]
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df, scratch)[1] == brute(docs)


def test_one_of_each(odd, nothing, scratch):
    rows, by_id = found(odd, scratch)
    assert len(rows) == odd.count()
    assert by_id[1][1] == by_id[2][1] == by_id[13][1] == 1 and by_id[9][1] == 8
    assert by_id[3] == (0, 3) and by_id[5] == (0, 5) and by_id[7][1] == 6
    null_ids = {(r["n_shingles"] > 0, r["component_id"]) for r in rows if r["doc_id"] is None}
    assert null_ids == {(True, 1), (False, None)}
    scratch.root += "-again"
    kept = J.one_of_each(odd, J.near_duplicates(odd, scratch))
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect())
    distinct = {c for _, c in by_id.values() if c is not None}
    assert kept.columns == odd.columns
    assert [i for known, i in ids if known] == sorted(distinct)
    scratch.root += "-empty"
    assert found(nothing, scratch)[0] == []


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, scratch, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(30)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    rows = connected_components(df, scratch, "c").collect()
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    expected = roots(edges, {x for e in edges for x in e} - loops)
    assert {r["node"]: r["component"] for r in rows} == expected
    none = connected_components(df.where(F.lit(False)), scratch, "d")
    assert none.count() == 0
