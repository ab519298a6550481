"""Conversations as training texts: formatted, tokenized once, with a loss mask by offsets.

A conversation is rendered whole. The character spans of its turns are sorted, and so are the
character offsets of its tokens, so a binary search finds the tokens of every assistant turn.

    system <<SYS>>text<</SYS>>   user [INST]text[/INST]   assistant <s>text</s>
    any other role [TURN]role[TEXT]text[/TURN]

Control strings inside roles and texts get a backslash after their first character, and one more
for every backslash that already stands there, so formatting can be undone exactly.

Null roles and texts count as empty. Turns are sorted by number (null first), then role, then
text; repeated rows are repeated turns. A null conversation id is a conversation of its own. An
empty table gives an empty result. Other columns are ignored. A conversation is one text in the
result and so is held by one task.
"""

import os
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe.llm.shared import bounded_batches, int_lists, per_process

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The control strings of the template, and the end mark of the vocabulary.
TEMPLATE = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
TURN, TEXT, END_TURN = "[TURN]", "[TEXT]", "[/TURN]"
CONTROLS = [c for pair in TEMPLATE.values() for c in pair] + [TURN, TEXT, END_TURN]
CONTROLS += ["<|endoftext|>"]
CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
TO_ESCAPE = re.compile(
    "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROLS)
)
ESCAPED = re.compile("|".join(re.escape(c[0]) + r"\\+" + re.escape(c[1:]) for c in CONTROLS))

SCHEMA = (
    "n_turns long, formatted string, token_ids array<int>, token_starts array<int>,"
    " token_ends array<int>, loss_mask array<tinyint>, loss_starts array<int>, loss_ends array<int>"
)


def escape(text: str) -> str:
    return TO_ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its assistant texts."""
    out, at, spans = [], 0, []
    for role, text in turns:
        if role in TEMPLATE:
            start, end = TEMPLATE[role]
        else:
            start, end = TURN + escape(role) + TEXT, END_TURN
        body = escape(text)
        if role == "assistant":
            spans.append((at + len(start), at + len(start) + len(body)))
        out += [start, body, end]
        at += len(start) + len(body) + len(end)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    roles = {pair[0]: role for role, pair in TEMPLATE.items()}
    turns, role, at = [], "", 0
    for m in CONTROL.finditer(formatted):
        body = unescape(formatted[at : m.start()])
        if m[0] in roles:
            role = roles[m[0]]
        elif m[0] == TEXT:
            role = body
        elif m[0] != TURN:
            turns.append((role, body))
        at = m.end()
    return turns


def tokenizer_of(vocabulary: str):
    """The tokenizer of a vocabulary file's content; control strings are tokens of their own."""

    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary)
        tokenizer.add_special_tokens(
            [AddedToken(c, special=True, normalized=False) for c in CONTROLS]
        )
        return tokenizer

    return per_process(f"chat_{hash(vocabulary)}", make)


def mask_of(
    starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]
) -> tuple[np.ndarray, list[int], list[int]]:
    """Which tokens bear loss, and the character spans under them, cut to the turns.

    A token bears loss if it overlaps a span; of one that reaches beyond it, only the characters
    inside count.
    """
    mask = np.zeros(len(starts), np.int8)
    loss_starts, loss_ends = [], []
    for a, b in spans:
        first = int(np.searchsorted(ends, a, "right"))
        last = int(np.searchsorted(starts, b, "left"))
        if last > first:
            mask[first:last] = 1
            loss_starts.append(max(a, int(starts[first])))
            loss_ends.append(min(b, int(ends[last - 1])))
    return mask, loss_starts, loss_ends


def format_conversations(
    turns: DataFrame,
    vocabulary: str,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: its text, token ids with offsets, mask, and spans under loss.

    ``vocabulary`` is the path of a byte-level vocabulary file for the tokenizers library; it is
    read here and sent to the executors.
    """
    spark = turns.sparkSession
    bounded_batches(spark)
    with open(vocabulary, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = turns.groupBy(F.col(id_col).alias("_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(content.value)
        for batch in batches:
            out = {k: [] for k in SCHEMA.replace(",", "").split()[::2]}
            for conversation in batch.column(1).to_pylist():
                said = [(t["role"], t["text"]) for t in conversation]
                formatted, spans = render(said)
                encoding = tokenizer.encode(formatted, add_special_tokens=False)
                offsets = np.array(encoding.offsets, np.int32).reshape(-1, 2)
                starts, ends = offsets[:, 0], offsets[:, 1]
                mask, loss_starts, loss_ends = mask_of(starts, ends, spans)
                out["n_turns"].append(len(said))
                out["formatted"].append(formatted)
                out["token_ids"].append(np.array(encoding.ids, np.int32))
                out["token_starts"].append(starts)
                out["token_ends"].append(ends)
                out["loss_mask"].append(mask)
                out["loss_starts"].append(np.array(loss_starts, np.int32))
                out["loss_ends"].append(np.array(loss_ends, np.int32))
            columns = [batch.column(0), pa.array(out["n_turns"], pa.int64())]
            columns.append(pa.array(out["formatted"], pa.string()))
            for name in list(out)[2:]:
                kind = pa.int8() if name == "loss_mask" else pa.int32()
                columns.append(int_lists(out[name], kind))
            yield pa.RecordBatch.from_arrays(columns, ["_id", *out])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, {SCHEMA}").withColumnRenamed("_id", id_col)
