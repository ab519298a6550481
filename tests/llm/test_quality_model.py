import math
import zlib

import numpy as np

from greenshoe.llm import quality_model, queries


def test_held_out_scores(spark):
    folder = "/root/testdata/sf0.1"
    scores = queries.op12_quality_model(spark, folder)
    assert scores.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores.join(labels, "doc_id").collect()
    for r in rows[:500]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.7)
    rows = [r for r in rows if r["held_out"]]
    good = np.array([r["quality"] == 1 for r in rows])
    predicted = np.array([r["predicted"] == 1 for r in rows])
    assert len(rows) > 500 and (~good).sum() > 100
    assert predicted[good].mean() > 0.99 and predicted[~good].mean() < 0.03
    bad = np.sort([r["score"] for r, g in zip(rows, good) if not g])
    above = np.searchsorted(bad, [r["score"] for r, g in zip(rows, good) if g]) / len(bad)
    assert above.mean() > 0.995  # area under the curve
    assert scores.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def plain_leader(rows, buckets):
    """Follow the regularised leader, weight by weight, from its definition."""
    alpha, beta, l1, l2 = (getattr(quality_model, k) for k in ("ALPHA", "BETA", "L1", "L2"))
    z, n = dict.fromkeys([*range(buckets), "b"], 0.0), dict.fromkeys([*range(buckets), "b"], 0.0)

    def weight(k):
        if k == "b":
            return -z[k] / ((beta + math.sqrt(n[k])) / alpha)
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    for found, values, good in rows:
        x = dict(zip(found, values)) | {"b": 1.0}
        w = {k: weight(k) for k in x}
        p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
        for k, v in x.items():
            g = (p - good) * v
            sigma = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha
            z[k] += g - sigma * w[k]
            n[k] += g * g
    return {k: weight(k) for k in z}


def test_updates_equal_the_plain_ones():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(400):
        found = np.sort(rng.choice(50, rng.integers(1, 12), replace=False))
        rows.append((found.tolist(), rng.random(len(found)).tolist(), int(found[0] < 9)))
    leader = quality_model.Leader()
    for found, values, good in rows:
        leader.update(np.array(found), np.array(values), good)
    expected, model = plain_leader(rows, 50), leader.model()
    assert math.isclose(model.intercept, expected.pop("b"), rel_tol=1e-9)
    assert set(model.buckets.tolist()) == {k for k, w in expected.items() if w}
    for bucket, weight in zip(model.buckets.tolist(), model.weights.tolist()):
        assert math.isclose(weight, expected[bucket], rel_tol=1e-9)


def test_l1_leaves_weights_out():
    leader = quality_model.Leader()
    for k in range(200):
        leader.update(np.array([k % 2, 1_000 + k]), np.array([1.0, 1e-6]), k % 2)
    model = leader.model()
    assert model.buckets.tolist() == [0, 1] and model.weights[0] < 0 < model.weights[1]


def plain_features(text):
    tokens, last = [], None
    for t in quality_model.TOKEN.findall(text):
        tokens.append("<again>" if t == last else t)
        last = t
    grams = {}
    for n in quality_model.SIZES:
        for k in range(len(tokens) - n + 1):
            gram = tuple(tokens[k : k + n])
            grams[gram] = grams.get(gram, 0) + 1
    return grams


def test_features_are_counted_ngrams():
    for text in ["a b a b", "a a a a", "x### y### z", "ÜBER über", "one"]:
        grams = plain_features(text)
        found, values = quality_model.features(text.encode())
        assert len(found) == len(grams) and (np.diff(found) > 0).all()
        expected = np.log1p(sorted(grams.values()))
        assert np.allclose(np.sort(values), expected / np.sqrt((expected**2).sum()))
    assert [len(x) for x in quality_model.features(b" \n")] == [0, 0]


def test_a_text_in_slices_has_the_same_features(monkeypatch):
    text = " ".join(f"w{k % 37}### w{k % 5}" if k % 11 else "same same" for k in range(5_000)).encode()
    whole = quality_model.features(text)
    slices = quality_model.text_slices
    monkeypatch.setattr(quality_model, "text_slices", lambda data: slices(data, 100))
    parts = quality_model.features(text)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])


def test_without_both_classes(spark, odd):
    labels = spark.createDataFrame([(1, 0, 5), (2, 0, 5), (2, None, 5), (None, 1, 5)], "doc_id long, quality int, text int")
    model = quality_model.train(odd, labels)
    rows = quality_model.score(odd, model).collect()
    assert len(rows) == odd.count() and len({r["score"] for r in rows}) == 1
    empty = quality_model.train(odd, labels.limit(0))
    assert quality_model.score(odd, empty).first()["score"] == 0.5


def test_odd_rows(spark, odd, nothing, documents, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_model.train(documents, labels)
    scores = quality_model.score(odd, model)
    assert scores.columns == ["doc_id", "score"] and scores.schema["doc_id"].dataType.simpleString() == "bigint"
    rows = scores.collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert empty == {quality_model.logistic(model.intercept)}
    assert quality_model.score(nothing, model).count() == 0
    again = quality_model.train(documents.repartition(3), labels)
    assert again.intercept == model.intercept and (again.weights == model.weights).all()


def test_held_out_labels_are_not_learnt(spark, documents, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = quality_model.held_out("doc_id")
    turned = labels.withColumn("quality", quality_model.F.when(held, 1 - labels.quality).otherwise(labels.quality))
    first, second = (quality_model.train(documents, x) for x in (labels, turned))
    assert (first.weights == second.weights).all() and first.intercept == second.intercept
