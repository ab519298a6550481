from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from greenshoe.llm import quality_rules as Q
from greenshoe.llm.shared import SPACES


def brute(text):
    words, word = [], ""
    for c in text + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    earlier, again = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            again += line in earlier
            earlier.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return [len(words), sum(map(len, words)), symbols, again, len(repeated)]


PIECES = st.sampled_from(["a", "b", "c", "éß", " ", "\n", "\t", "\x0b", "　", "#", "|", "a b c d e f g h "])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=60).map("".join))
def test_figures_against_brute_force(text):
    assert Q.measure(text)[:5] == brute(text)


def test_line_rules():
    assert Q.line_verdict("A clean line that ends as lines do.") is None
    assert Q.line_verdict("This%%% is*** not### clean&&&") == "punctuation"
    assert Q.line_verdict("Home | News | About us | Contact") == "navigation"
    assert Q.line_verdict("Copyright 2020. All Rights Reserved.") == "boilerplate"


def test_documents_that_lose_too_much_go(spark):
    clean = "\n".join(" ".join(f"w{i}x{j}" for j in range(11)) + "." for i in range(5))
    menu = "\n".join(f"Home{i} | News{i} | About{i} | Contact{i} | Help{i}" for i in range(12))
    rows = [(1, clean), (2, clean + "\nAll rights reserved."), (3, clean[:120] + "\n" + menu)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in Q.measure_quality(df).collect()}
    assert kept == {1: True, 2: True, 3: False}
    assert Q.cleaned(clean + "\nAll rights reserved.") == clean


def test_good_documents_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1")
    judged = Q.measure_quality(docs).join(labels, "doc_id").where("NOT base_failed")
    assert judged.count() > 0 and judged.where("NOT kept").count() == 0


def test_odd_rows(odd, nothing):
    rows = Q.measure_quality(odd).collect()
    assert len(rows) == odd.count()
    assert all(not r["kept"] for r in rows if r["n_words"] == 0)
    assert Q.measure_quality(nothing).count() == 0
