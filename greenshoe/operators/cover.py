"""Cover text of a prospectus: the one step that needs Python.

The text of every ``p``, ``div``, ``span`` and ``td`` follows in document order, nested ones
included, so nested text repeats. Chunks are taken until their summed length goes above the
limit; the chunk that takes it there stays whole.
"""

import sys
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenshoe import fixed_values as V

# The reader travels to the executors with the query, so they need not have this package installed.
# It must therefore use names of this module only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCKS = frozenset(V.COVER_TAGS)
LIMIT = V.COVER_CHARS
# Tags that cannot hold anything, and tags whose text is not shown.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link"
    " menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN = frozenset("script style template rt rp".split())


class _Full(Exception):
    """Enough text was read; the rest of the document cannot change the cover."""


class _CoverReader(HTMLParser):
    """Keeps the visible strings, and for every block which of them it spans.

    A tag stays open until its own end tag or that of a tag around it; an end tag without an
    open tag is ignored.
    """

    def __init__(self, limit: int):
        super().__init__(convert_charrefs=False)
        self.limit = limit
        self.strings: list[str] = []
        self.pending: list[str] = []
        self.spans: list[list] = []  # [first string, end], end None while the block is open
        self.open: list[tuple] = []  # (tag, its span or None)
        self.open_count: dict[str, int] = {}
        self.hidden = 0
        self.taken = 0  # leading blocks that are closed
        self.length = 0  # their summed length

    def cover(self, html: str) -> str:
        try:
            self.feed(html)
            self.close()
            self._end_string()
            self._close_down_to(0)
        except _Full:
            pass
        return " ".join(filter(None, map(self._chunk, self.spans[: self.taken])))

    def _chunk(self, span: list) -> str:
        return " ".join(self.strings[span[0] : span[1]])

    def _end_string(self, shown: bool = False) -> None:
        text = "".join(self.pending).strip()
        self.pending.clear()
        if text and (shown or not self.hidden):
            self.strings.append(text)

    def _close_down_to(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, span = self.open.pop()
            self.open_count[tag] -= 1
            self.hidden -= tag in HIDDEN
            if span:
                span[1] = len(self.strings)
        while self.taken < len(self.spans) and self.spans[self.taken][1] is not None:
            self.length += len(self._chunk(self.spans[self.taken]))
            self.taken += 1
            if self.length > self.limit:
                raise _Full

    def handle_starttag(self, tag, attrs):
        self._end_string()
        if tag not in VOID:
            self._open(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def _open(self, tag: str) -> None:
        span = [len(self.strings), None] if tag in BLOCKS else None
        if span:
            self.spans.append(span)
        self.open.append((tag, span))
        self.open_count[tag] = self.open_count.get(tag, 0) + 1
        self.hidden += tag in HIDDEN

    def handle_endtag(self, tag):
        self._end_string()
        if self.open_count.get(tag):
            depth = len(self.open) - 1
            while self.open[depth][0] != tag:
                depth -= 1
            self._close_down_to(depth)

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        self.pending.append(_character(code))

    def handle_comment(self, data):
        self._end_string()

    def handle_decl(self, decl):
        self._end_string()

    def handle_pi(self, data):
        self._end_string()

    def unknown_decl(self, data):
        self._end_string()
        if data.upper().startswith("CDATA["):
            self.pending.append(data[len("CDATA[") :])
            self._end_string(shown=True)


def _character(code: int) -> str:
    """A numeric reference; those below 256 mean the Windows character, as browsers have it."""
    if code < 256:
        return bytes([code]).decode("windows-1252", errors="ignore") or chr(code)
    if code > sys.maxunicode or 0xD800 <= code <= 0xDFFF:
        return "\N{REPLACEMENT CHARACTER}"
    return chr(code)


def read_cover(html: str | None) -> str | None:
    """The cover text, or None where there is no document or it cannot be parsed."""
    if html is None:
        return None
    try:
        return _CoverReader(LIMIT).cover(html)
    except (AssertionError, ValueError):
        return None


@F.arrow_udf(T.StringType())
def _cover(html: pa.Array) -> pa.Array:
    return pa.array((read_cover(page.as_py()) for page in html), pa.string())


# Declared non-deterministic so that Catalyst never parses a document twice, for instance by
# pushing a filter on the cover below the projection that makes it.
_cover_once = _cover.asNondeterministic()


def cover_text(html: Column) -> Column:
    """Cover text as a column. The other columns of the row do not travel to Python."""
    return _cover_once(html)
