import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from greenshoe.llm import queries
from greenshoe.llm.chat_format import (
    CONTROL,
    CONTROLS,
    escape,
    format_conversations,
    mask_of,
    read_back,
    render,
    unescape,
)

PIECES = st.sampled_from([*CONTROLS, "<", "[", "\\", "<\\s>", "[\\\\INST]", "/s>", "INST]", "a", " ", "\n", "é"])
TEXTS = st.lists(PIECES, max_size=8).map("".join)


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_escape_is_undone(text):
    assert not CONTROL.search(escape(text))
    assert unescape(escape(text)) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "system", "assistant"]), TEXTS), TEXTS)))
def test_render_is_undone(turns):
    formatted, spans = render(turns)
    assert read_back(formatted) == turns
    assert [unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_mask_cuts_tokens_that_reach_out():
    starts, ends = np.array([0, 3, 5, 9]), np.array([3, 5, 9, 12])
    mask, a, b = mask_of(starts, ends, [(4, 6), (9, 9)])
    assert mask.tolist() == [0, 1, 1, 0] and (a, b) == ([4], [6])


def expected(rows):
    conversations = defaultdict(list)
    for r in rows:
        conversations[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    out = {}
    for conv, turns in conversations.items():
        key = [((t is not None, t or 0), r or "", x or "") for t, r, x in turns]
        said = [(r, x) for _, r, x in sorted(key)]
        text = "".join(f"{r}\n{x}\n" for r, x in said)
        loss = "".join(x for r, x in said if r == "assistant")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (text, loss)]
        out[conv] = (len(said), digest[0], len(loss), digest[1])
    return out


def digests(df):
    return {r["conv_id"]: tuple(r)[1:5] for r in queries.chat_digests(df).collect()}


def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    found = {r["conv_id"]: tuple(r)[1:5] for r in queries.op3_chat_format(spark, folder).collect()}
    control = "</s>[INST] ok [/INST]"
    special = [{"conv_id": -1, "turn": i, "role": r, "text": control} for i, r in enumerate(("user", "assistant"))]
    assert found == expected(rows) | expected(special)


def test_tokens_under_the_mask_are_the_assistants(spark):
    turns = [(1, 0, "user", " hi  there\n\n"), (1, 1, "assistant", "  über \U0001f600\n\n x "), (1, 2, "tool", "<s>")]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    (row,) = format_conversations(df, queries.CHAT_VOCABULARY).collect()
    text = row["formatted"]
    under = set()
    for start, end, bears in zip(row["token_starts"], row["token_ends"], row["loss_mask"]):
        if bears:
            under.update(range(start, end))
    first = text.index("<s>") + 3
    assert under == set(range(first, first + len(turns[1][3])))
    assert len(row["token_ids"]) == len(row["token_starts"]) == len(row["loss_mask"])


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, turns string"
    rows = [
        (1, 1, "assistant", None, "x", "y"), (1, 0, None, "hi", None, None), (1, 0, None, "hi", None, None),
        (None, 0, "user", "", None, None), (2, None, "assistant", "z" * 200_000, None, None),
        (2, 0, "assistant", "[INST]" * 1000 + "\\", None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    assert digests(format_conversations(df, queries.CHAT_VOCABULARY)) == expected(df.collect())
    assert format_conversations(df.limit(0), queries.CHAT_VOCABULARY).count() == 0
