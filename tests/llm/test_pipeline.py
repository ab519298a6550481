from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracles import compare
from greenshoe.llm import decontaminate, jaccard_join, queries, source_mix, token_files, toxicity
from greenshoe.llm.shared import Scratch


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, folder, name):
    outcome, _, _ = compare(spark, folder, name, queries.QUERIES[name], queries.ORACLES[name])
    assert outcome == "equal"


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages_one_by_one(spark, documents, folder, scratch):
    """Each stage against what its operator says of the rows that it got."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
    outputs, docs = [], documents
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = scratch.save(stage(spark, docs, folder), name)
        assert out.columns == documents.columns
        outputs.append(out)
        docs = out
    clean, single, decontaminated, mixed = outputs

    model = toxicity.train(documents, labels)
    scores = toxicity.score(documents, model).collect()
    assert ids(clean) == Counter(r["doc_id"] for r in scores if r["score"] < toxicity.THRESHOLD)

    found = jaccard_join.near_duplicates(clean, Scratch(spark, "t")).collect()
    assert ids(single) == Counter({r["component_id"] for r in found})

    bad = decontaminate.overlaps(single, bench, Scratch(spark, "t")).collect()
    assert bad
    assert ids(decontaminated) == ids(single) - Counter({r["doc_id"] for r in bad})

    taken, _ = source_mix.training_plan(decontaminated, Scratch(spark, "t"))
    times = Counter({r["doc_id"]: r["times"] for r in taken.collect() if r["times"]})
    assert ids(mixed) == times

    tokens = corpus_pipeline.write_tokens(spark, mixed, folder).collect()
    assert Counter(r["doc_id"] for r in tokens) == times
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert {r["doc_id"]: r["text"] for r in documents.where(documents.doc_id.isin(*texts)).collect()} == texts


def in_files(docs):
    """Ids in the order of a written table."""
    order = token_files.stored_order(docs)
    return [r["doc_id"] for r in docs.orderBy(*order).select("doc_id").collect()]


def test_the_training_order_decides_the_token_files(spark, documents, scratch, monkeypatch):
    """Files hold the documents by position; with another schedule they hold them otherwise."""
    written, of = [], source_mix.curriculum
    for n, curricula in enumerate([source_mix.CURRICULA, source_mix.CURRICULA[::-1]]):
        monkeypatch.setattr(source_mix, "curriculum", lambda c=curricula: of(c))
        _, order = source_mix.training_plan(documents, Scratch(spark, "t"))
        expected = [r["doc_id"] for r in order.collect()]
        mixed = scratch.save(source_mix.mixed_documents(documents, order), f"mixed-{n}")
        assert in_files(mixed) == expected
        rows = corpus_pipeline.write_tokens(spark, mixed, "").orderBy("start").collect()
        assert [r["doc_id"] for r in rows] == expected
        written.append(expected)
    assert written[0] != written[1] and sorted(written[0]) == sorted(written[1])
    assert token_files.stored_order(documents.groupBy("doc_id").count()) == []


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert rows and [r["doc_id"] for r in rows] != sorted(r["doc_id"] for r in rows)
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]


def test_stages_on_odd_rows(spark, odd, nothing, folder):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, folder)
            assert out.columns == odd.columns
            docs = spark.createDataFrame(out.collect(), odd.schema)
        assert corpus_pipeline.write_tokens(spark, docs, folder).count() == docs.count()
