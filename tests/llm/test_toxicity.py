import zlib

import numpy as np

from greenshoe.llm import queries, toxicity


def test_held_out_scores(spark):
    folder = "/root/testdata/sf0.1"
    scores = queries.op8_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores.join(labels, "doc_id").collect()
    for r in rows[:500]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    rows = [r for r in rows if r["held_out"]]
    toxic = np.array([r["toxic"] == 1 for r in rows])
    predicted = np.array([r["predicted"] == 1 for r in rows])
    assert len(rows) > 500 and toxic.sum() > 50
    assert predicted[toxic].mean() > 0.7 and predicted[~toxic].mean() < 0.005
    order = np.sort([r["score"] for r, t in zip(rows, toxic) if not t])
    above = np.searchsorted(order, [r["score"] for r, t in zip(rows, toxic) if t]) / len(order)
    assert above.mean() > 0.93  # area under the curve
    assert scores.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_log_count_ratios_scale_the_features():
    bad, good, both = toxicity.words_features(["idiot", "garden", "house"])
    rows = [np.unique(np.concatenate([both, bad if i % 4 == 0 else good])) for i in range(80)]
    model = toxicity.fit(rows, np.arange(80) % 4 == 0)
    score = model.scorer()
    first, second = score(["house idiot", "house garden"])
    assert first > 0.9 > 0.1 > second
    weight = dict(zip(model.buckets.tolist(), model.weights))
    assert all(weight.get(b, 0) > 0 for b in bad) and all(weight.get(b, 0) < 0 for b in good)
    place = np.full(toxicity.BUCKETS, -1, np.int32)
    place[bad[:1]] = 7
    assert [x.tolist() for x in toxicity.words_features(["garden", "idiot"], place)] == [[], [7]]
    empty = score(["", "   ", None])
    assert len(set(empty)) == 1 and 0 < empty[0] < 1


def test_features_are_the_ngrams_of_each_word():
    words = ["a", "abc", "ünï", "\U0001f600x", "abc" * 50]
    alone = [toxicity.words_features([w])[0] for w in words]
    together = toxicity.words_features(words)
    assert [len(x) for x in together] == [sum(max(0, len(w) + 3 - n) for n in toxicity.SIZES) for w in words]
    assert all((x == y).all() for x, y in zip(alone, together))


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 5)
    features = toxicity.TextFeatures()
    texts = ["a b c", "d e f g h i", None, "a z"]
    found = []
    for x in features(texts):
        found.append(sorted(map(len, x)))
        assert len(features.known) <= 6  # a text's own words, where it has more
    # A word of one letter has one 3-gram, as its ends count.
    assert found == [[1] * 3, [1] * 6, [], [1] * 2]
    assert [len(x) for x in features(["ab abc ab", "Abc"])] == [2, 1]


def test_words_in_any_order_and_number_score_the_same():
    model = toxicity.Model(-1.0, np.arange(toxicity.BUCKETS), np.linspace(-1e-3, 1e-3, toxicity.BUCKETS))
    score = model.scorer()
    first, second = score(["a bcd efg bcd", "EFG\na\tbcd"])
    assert first == second


def test_without_both_classes(spark, odd):
    labels = spark.createDataFrame([(1, 0, 5), (2, 0, 5), (2, None, 5), (None, 1, 5)], "doc_id long, toxic int, text int")
    model = toxicity.train(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and len({r["score"] for r in rows}) == 1
    empty = toxicity.train(odd, labels.limit(0))
    assert toxicity.score(odd, empty).first()["score"] == 0.5


def test_odd_rows(spark, odd, nothing):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train(documents, labels)
    clean = toxicity.without_toxic(odd, model)
    scores = toxicity.score(odd, model).collect()
    assert clean.schema == odd.schema
    assert clean.count() == sum(r["score"] < toxicity.THRESHOLD for r in scores)
    assert toxicity.without_toxic(nothing, model).count() == 0


def test_short_words_have_features():
    assert [len(x) for x in toxicity.words_features(["a", "ab"])] == [1, 3]


def test_held_out_rows_are_ranked_by_the_whole_model(spark):
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL")
    model = toxicity.train(documents, labels)
    assert len(model.buckets) > 1 << 13
    held = toxicity.score(documents.where(toxicity.held_out("doc_id")), model)
    rows = held.join(labels, "doc_id").collect()
    clean = np.sort([r["score"] for r in rows if not r["toxic"]])
    toxic = [r["score"] for r in rows if r["toxic"]]
    assert (np.searchsorted(clean, toxic) / len(clean)).mean() > 0.955  # area under the curve
