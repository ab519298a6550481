import io
import itertools
import json
import string
import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from greenshoe.llm import token_files
from greenshoe.llm.queries import IDS_VOCABULARY
from greenshoe.llm.shared import text_slices


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(IDS_VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    with open(IDS_VOCABULARY, encoding="utf-8") as file:
        return token_files.Encoder(file.read())


def expected(rows, tokenizer):
    """(doc_id, start, n, crc) by encoding every text whole."""
    rank = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    out, start = [], 0
    for r in sorted(rows, key=rank):
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        out.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def found(df, scratch):
    files = token_files.write_files(df, scratch, IDS_VOCABULARY)
    return [tuple(r) for r in token_files.read_documents(files).collect()]


def test_test_table(documents, scratch, tokenizer):
    assert sorted(found(documents, scratch), key=lambda r: r[0]) == expected(documents.collect(), tokenizer)


def test_odd_rows(odd, nothing, scratch, tokenizer):
    got = found(odd, scratch)
    assert {(i, n, c) for i, _, n, c in got} == {(i, n, c) for i, _, n, c in expected(odd.collect(), tokenizer)}
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == list(np.cumsum([0] + [r[2] for r in got])[:-1])
    ids = [r[0] for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:]) and len(got) == odd.count()
    scratch.root += "-empty"
    assert found(nothing, scratch) == []


CHARS = st.characters(exclude_categories=["Cs"]) | st.sampled_from(
    list(" \t\n\r\x0b\x0c\x1c\x85\xa0 　ABab'sİIΣς̇̊가K<|endoftext|>%*!")
)


@settings(max_examples=1_000, deadline=None)
@given(st.lists(CHARS, max_size=40).map("".join))
def test_word_by_word_is_the_whole_text(tokenizer, encoder, text):
    (data,) = encoder.encode([text.encode()])
    assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    [
        "W\u030a T\u0344! w\u030a",  # accents that join a small letter only
        "<|EndOfText|> a<|endoftext|>b <|ENDOFTEXT|>.",
        "\u0130. \u0958., \u0915\u093c.",  # letters that come apart into a letter and a mark
        "sou. sou, 'sou' sou's ... sou... $$$ s.o.u. \x00 a\x00b, " + "sou! " * 3,
        "",
        " \n",
    ],
)
def test_odd_words(tokenizer, encoder, text):
    with open(IDS_VOCABULARY, encoding="utf-8") as file:
        without_suffix = json.loads(file.read())
    without_suffix["model"]["end_of_word_suffix"] = None
    other = json.dumps(without_suffix)
    for whole, words in ((tokenizer, encoder), (Tokenizer.from_str(other), token_files.Encoder(other))):
        (data,) = words.encode([text.encode()])
        assert np.frombuffer(data, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_every_character(tokenizer, encoder):
    """Before a sign, and every accent after A to Z."""
    every = [chr(i) for i in range(0x20000) if not 0xD800 <= i < 0xE000]
    accents = [c for c in every if unicodedata.combining(unicodedata.normalize("NFD", c)[0])]
    words = [c + "." for c in every] + [a + c for a in string.ascii_uppercase for c in accents]
    for i in range(0, len(words), 1_000):
        text = " ".join(words[i : i + 1_000])
        (data,) = encoder.encode([text.encode()])
        assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_texts_and_groups(monkeypatch, tokenizer, encoder):
    monkeypatch.setattr(token_files, "GROUP_BYTES", 100)
    monkeypatch.setattr(token_files, "text_slices", lambda text: text_slices(text, 64))
    texts = ["Word%d, %s" % (k, "tail. " * (k % 40)) for k in range(90)] + ["", "one"]
    got = list(encoder.encode([t.encode() for t in texts]))
    assert len(got) == len(texts)
    for text, data in zip(texts, got):
        assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_signs_after_a_word_cost_no_new_encoding():
    with open(IDS_VOCABULARY, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    whole, seen = encoder.tokenizer, []

    class Counting:
        def encode(self, text, **options):
            seen.extend(text.split())
            return whole.encode(text, **options)

        def encode_batch_fast(self, texts, **options):
            seen.extend(word for text in texts for word in text.split())
            return whole.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    words = ["".join(p) for p in itertools.product("bdlm", "aeo", "nrst")]
    texts = [f"{w} {w}. {w.upper()}, {w}... {w}!".encode() for w in words]
    assert len(list(encoder.encode(texts))) == len(texts)
    assert sorted(seen) == sorted([*words, ".", ",", "...", "!"])


def test_memory_of_words_is_bounded(monkeypatch, tokenizer, encoder):
    monkeypatch.setattr(token_files, "REMEMBERED", 10)
    texts = [" ".join(f"word{i} again" for i in range(k, k + 9)) for k in range(50)]
    for text, data in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=60), max_size=30), st.integers(1, 50))
def test_files_round_trip(documents, block):
    class File(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

    old, token_files.BLOCK = token_files.BLOCK, block
    try:
        file = File()
        writer = token_files.Writer(file)
        data = [np.array(d, "<u4").tobytes() for d in documents]
        for i, d in enumerate(data):
            writer.add(None if i == 3 else i, d)
        writer.close()
        reader = token_files.Reader(file)
        blocks = list(reader.blocks())
        assert b"".join(b.tobytes() for b in blocks) == b"".join(data)
        assert all(len(b) == block for b in blocks[:-1])
        rows = list(reader.documents())
        assert [(r[0], r[2], r[3]) for r in rows] == [
            (None if i == 3 else i, len(d) // 4, zlib.crc32(d)) for i, d in enumerate(data)
        ]
    finally:
        token_files.BLOCK = old


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "bc", " ", "\n", "\x0b", "é"]), max_size=40).map("".join))
def test_text_slices(text):
    parts = list(text_slices(text.encode(), size=5))
    assert b"".join(parts) == text.encode()
    assert [w for p in parts for w in p.split()] == text.encode().split()


def test_not_a_token_file():
    class File(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

    with pytest.raises(ValueError):
        token_files.Reader(File(b"x" * 40))
