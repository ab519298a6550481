"""Secrets in texts and in what their texts encode.

A worklist per document: the text itself is the first layer; percent escapes, Unicode escapes,
base64 and compressed data in a layer give further layers until nothing new comes up. Every layer
is scanned, and what is found is mapped back to the span of the text that it was decoded from.

Null texts count as empty. A text without secrets gives an empty list. Rows that repeat are
scanned and returned each on its own, null ids too. A very long text is scanned whole by one task;
of its decoded layers ``DECODED_CHARS`` characters are read in all, and layers that this cuts are
counted in ``n_unread``. An empty table gives no rows. Other columns are ignored.
"""

import base64
import binascii
import bz2
import lzma
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe.llm.shared import bounded_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGN, MIN_ACCESS = 8, 16

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(
    r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}"
    r"|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)
# The shortest secret is 14 characters long, which base64 makes 19.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{18,}(?:\r?\n[A-Za-z0-9+/_-]{4,})*={0,2}")
URL_SAFE = str.maketrans("-_", "+/")

# A document's layers may hold so many characters in all; a layer beyond is counted as unread.
DECODED_CHARS = 64 << 20

SCHEMA = (
    "secrets array<struct<start:int,kind:int,end:int,depth:int>>, n_layers long, n_unread long"
)


def base_matches(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the plain matches, in code points."""
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_ASSIGN:
                yield 0, m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= MIN_ACCESS:
                yield 1, m.start(), m.end()
    for m in HEX.finditer(text):
        yield 2, m.start(), m.end()


class Layer:
    """A decoded text; ``starts`` and ``ends`` say which span of the document made a character."""

    def __init__(self, text: str, starts: np.ndarray | None, ends: np.ndarray | None, depth: int):
        self.text, self.starts, self.ends, self.depth = text, starts, ends, depth

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def child(self, text: str, starts: np.ndarray, ends: np.ndarray) -> "Layer":
        """A layer made of this one; ``starts`` and ``ends`` are positions in this one."""
        if self.starts is not None:
            starts, ends = self.starts[starts], self.ends[ends - 1]
        return Layer(text, starts, ends, self.depth + 1)

    def key(self) -> tuple:
        """Equal for equal texts from the same place: these need no second look."""
        place = xxhash.xxh3_64_intdigest(np.ascontiguousarray(self.starts).tobytes())
        return xxhash.xxh3_128_digest(self.text.encode("utf-8", "surrogatepass")), place


def _percent(match: str) -> tuple[str, np.ndarray] | None:
    data = bytes.fromhex(match.replace("%", ""))
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text, np.cumsum([0] + [3 * len(c.encode()) for c in text])


def _unicode(match: str) -> tuple[str, np.ndarray] | None:
    digits = match.strip("\\uUxX{}&#;")
    if match.startswith("&#") and match[2] not in "xX":
        code = int(digits)
    elif match.count("\\u") == 2:
        high, low = int(match[2:6], 16), int(match[8:12], 16)
        code = 0x10000 + ((high - 0xD800) << 10) + (low - 0xDC00)
    else:
        code = int(match[3:-1] if match[-1] in "};" else match[2:], 16)
    if code > sys.maxunicode or 0xD800 <= code <= 0xDFFF:
        return None
    return chr(code), np.array([0, len(match)])


def unescaped(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with its escapes replaced; None if there are none."""
    texts, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        if (found := decode(m[0])) is None:
            continue
        kept = np.arange(at, m.start())
        texts += [layer.text[at : m.start()], found[0]]
        starts += [kept, m.start() + found[1][:-1]]
        ends += [kept + 1, m.start() + found[1][1:]]
        at = m.end()
    if not texts:
        return None
    kept = np.arange(at, len(layer.text))
    texts.append(layer.text[at:])
    return layer.child(
        "".join(texts), np.concatenate([*starts, kept]), np.concatenate([*ends, kept + 1])
    )


def readable(data: bytes) -> str | None:
    """The bytes as text, unless they are not UTF-8 or mostly control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    odd = sum(c < 32 and c not in (9, 10, 11, 12, 13) for c in data)
    return text if odd * 10 <= len(data) else None


def decompressor(data: bytes):
    """By the first bytes: gzip, zlib, bzip2, xz, zstandard; None for anything else."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 1 and (data[0] * 256 + data[1]) % 31 == 0:
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def inflated(data: bytes, limit: int) -> tuple[bytes | None, bool]:
    """Decompressed bytes, and whether there were more than ``limit``.

    Fed in small steps, so that no step makes much more than the limit.
    """
    engine, out, size = decompressor(data), [], 0
    if engine is None:
        return None, False
    try:
        for at in range(0, len(data), 512):
            if getattr(engine, "eof", False):
                break
            out.append(engine.decompress(data[at : at + 512]))
            size += len(out[-1])
            if size > limit:
                return b"".join(out)[:limit], True
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        return None, False
    return (b"".join(out), False) if size else (None, False)


def _base64_runs(text: str) -> Iterator[tuple[int, int]]:
    """Spans to decode: a run over lines as a whole, and each of its lines."""
    for m in BASE64.finditer(text):
        yield m.span()
        if "\n" in m[0]:
            at = m.start()
            for line in m[0].split("\n"):
                if len(line) >= 18:
                    yield at, at + len(line.rstrip("\r"))
                at += len(line) + 1


def decoded_blobs(layer: Layer, limit: int) -> Iterator[tuple[Layer | None, bool]]:
    """A layer for each base64 run, decompressed where it is compressed; whether it was cut."""
    for start, end in _base64_runs(layer.text):
        run = layer.text[start:end]
        where = None
        if "\n" in run:
            where = np.array([i for i, c in enumerate(run) if c not in "\r\n"])
            run = run.replace("\r", "").replace("\n", "")
        body = run.rstrip("=").translate(URL_SAFE)
        if len(body) % 4 == 1:
            continue
        try:
            data = base64.b64decode(body + "=" * (-len(body) % 4))
        except (binascii.Error, ValueError):
            continue
        cut, packed, seen = False, False, set()
        while decompressor(data) is not None:
            digest = xxhash.xxh3_128_digest(data)
            if digest in seen:  # data that decompresses to itself
                break
            seen.add(digest)
            more, cut = inflated(data, limit)
            if more is None:
                break
            data, packed = more, True
            if cut:
                break
        text = data.decode("utf-8", "ignore") if cut else readable(data)
        if not text:
            if cut:
                yield None, True
            continue
        if packed:
            starts = np.full(len(text), start)
            ends = np.full(len(text), end)
        else:
            sizes = np.cumsum([0] + [len(c.encode()) for c in text])
            first = sizes[:-1] // 3 * 4
            last = np.minimum((sizes[1:] + 2) // 3 * 4, len(body))
            if where is not None:
                first, last = where[first], where[last - 1] + 1
            starts, ends = start + first, start + last
        yield layer.child(text, starts, ends), cut


def scan_text(text: str, limit: int = DECODED_CHARS) -> tuple[list[tuple], int, int]:
    """((start, kind, end, depth) sorted, decoded layers, layers not read in full)."""
    found: dict[tuple, int] = {}
    work, seen, layers, unread, left = [Layer(text, None, None, 0)], set(), 0, 0, limit
    while work:
        layer = work.pop(0)
        for kind, a, b in base_matches(layer.text):
            start, end = layer.origin(a, b)
            found.setdefault((start, kind, end), layer.depth)
        children = []
        if "%" in layer.text:
            children.append((unescaped(layer, PERCENT, _percent), False))
        if "\\" in layer.text or "&#" in layer.text:
            children.append((unescaped(layer, UNICODE, _unicode), False))
        children += decoded_blobs(layer, max(left, 0))
        for child, cut in children:
            unread += cut
            if child is None or (key := child.key()) in seen:
                continue
            seen.add(key)
            if len(child.text) > left:
                unread += not cut
                child = Layer(child.text[: max(left, 0)], child.starts, child.ends, child.depth)
            left -= len(child.text)
            layers += 1
            work.append(child)
    return sorted((s, k, e, d) for (s, k, e), d in found.items()), layers, unread


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its id, ``secrets`` by start, kind and end, ``n_layers`` and ``n_unread``.

    A secret's ``depth`` is 0 if it stands in the text as it is, else the layer it was found in.
    ``n_unread`` counts layers that go beyond ``DECODED_CHARS``, as a decompression bomb does;
    they are read up to there. Map-only: nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    secrets = pa.list_(
        pa.struct([(n, pa.int32()) for n in ("start", "kind", "end", "depth")])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [scan_text(t or "") for t in batch.column(1).to_pylist()]
            lists = [
                [dict(zip(("start", "kind", "end", "depth"), s)) for s in r[0]] for r in results
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lists, secrets),
                    pa.array([r[1] for r in results], pa.int64()),
                    pa.array([r[2] for r in results], pa.int64()),
                ],
                ["_id", "secrets", "n_layers", "n_unread"],
            )

    return rows.mapInArrow(run, f"_id {kind}, {SCHEMA}").withColumnRenamed("_id", id_col)
