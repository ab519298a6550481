import base64
import bz2
import gzip
import hashlib
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from greenshoe.llm import queries, secret_scan
from greenshoe.llm.secret_scan import scan_text

SECRET = "password=abcdefgh12345678"


def plain(text):
    """The contract's matches, straight from its patterns."""
    found = []
    assign = r"""(?a:((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
    for m in re.finditer(assign, text):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text):
            if len(m.group()) >= least:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def hidden(text):
    return [(s, k, e) for s, k, e, depth in scan_text(text)[0] if depth]


def test_query_against_patterns(spark, folder, documents):
    rows = {r["doc_id"]: r for r in queries.op1_secret_scan(spark, folder).collect()}
    assert len(rows) == documents.count()
    for doc in documents.collect():
        expected = plain(doc["text"])
        listed = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in expected)
        row = rows[doc["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [
            sum(k == kind for _, k, _ in expected) for kind in range(3)
        ]
        assert set(filter(None, listed.split(","))) <= set(filter(None, row["spans"].split(",")))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["password", "Token", "SECRET", "api_key", "apikey", "=", ":", " ", '"', "AKIA", "A1B2C3D4E5F6",
     "abcdef0123456789", "ſecret", "toKen", "x", "é", "\n", "%41", "\\u0041"]), max_size=12))
def test_plain_matches_stay(parts):
    text = "".join(parts)
    found = [(s, k, e) for s, k, e, depth in scan_text(text)[0] if depth == 0]
    assert found == plain(text)


def test_each_encoding_maps_to_its_place():
    percent = "".join(f"%{b:02x}" for b in SECRET.encode())
    escapes = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    entities = "".join(f"&#{ord(c)};" for c in SECRET)
    coded = base64.b64encode(SECRET.encode()).decode()
    for text in (percent, escapes, entities, coded, coded.rstrip("=")):
        assert hidden("äö " + text + " end") == [(3, 0, 3 + len(text.rstrip("=")))], text
    part = "see password%3Dabcdefgh%31 there"
    assert hidden(part) == [(4, 0, 26)]


def test_place_inside_a_longer_blob():
    blob = base64.b64encode(b"x" * 30 + b" " + SECRET.encode() + b" " + b"y" * 30).decode()
    ((start, kind, end),) = hidden("<" + blob + ">")
    assert kind == 0 and 1 + 40 <= start <= 1 + 42 and end - start < len(blob) - 60


def test_nested_and_compressed_layers():
    for squeeze in (gzip.compress, zlib.compress, bz2.compress):
        blob = base64.b64encode(squeeze(("text " * 20 + SECRET).encode())).decode()
        for outer in (blob, base64.b64encode(blob.encode()).decode(), blob.replace("=", "%3D")):
            found = hidden("a " + outer)
            assert found and all(s >= 2 and e <= 2 + len(outer) for s, _, e in found)
    twice = base64.b64encode(gzip.compress(gzip.compress(SECRET.encode()))).decode()
    assert hidden(twice) == [(0, 0, len(twice))]
    percent = SECRET.replace("=", "%253D")
    assert hidden(percent) == [(0, 0, len(percent))]


def test_wrapped_base64():
    blob = base64.encodebytes(("text " * 40 + SECRET).encode()).decode()
    assert hidden("begin\n" + blob)


def test_cycles_and_bombs_end():
    bomb = base64.b64encode(zlib.compress(b"0" * 50_000_000)).decode()
    _, layers, unread = scan_text(bomb, limit=1_000_000)
    assert unread >= 1 and layers <= 2
    assert scan_text("%25" * 1000)[1] <= 3
    same = base64.b64encode(SECRET.encode()).decode()
    assert len(hidden(same + " " + same)) == 2  # equal texts, different places


def test_odd_rows(odd, nothing):
    rows = secret_scan.scan(odd).collect()
    assert len(rows) == odd.count()
    assert sum(len(r["secrets"]) for r in rows) == 1
    assert secret_scan.scan(nothing).count() == 0
