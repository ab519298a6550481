from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from greenshoe.operators.cover import BLOCKS, VOID, _CoverReader, cover_text, read_cover

CASES = [
    ("<div><p>A</p></div>", "A A"),
    ("<p> a <b>b</b> </p>", "a b"),
    ("<div></div><p>x</p>", "x"),
    ("<b>only bold</b>", ""),
    ("", ""),
    ("<table><tr><td>1</td><td>2</td></tr></table>", "1 2"),
    ("<p>a<p>b", "a b b"),
    # An end tag closes what is open inside; one without an open tag is ignored.
    ("<div>a<p>b</div>c</p><span>d</span>", "a b b d"),
    ("<p>a</b>b</p>", "a b"),
    ("<P>Upper</P>", "Upper"),
    # Void and self-closed tags hold nothing, but break the string.
    ("<p>a<br>b<img src=x>c<hr/>d</p>", "a b c d"),
    ("<p/>x<div>y</div>", "y"),
    # Hidden text and comments.
    ("<p>a<script>var p='</p>'</script><style>q</style><!-- c -->b</p>", "a b"),
    ("<div><template>t</template>x</div>", "x"),
    ("<p>a<![CDATA[b]]></p>", "a b"),
    # References; a number below 256 is a Windows character.
    ("<p>a&amp;b &#8217;&#146;&copy;&foo; &#x41;</p>", "a&b ’’©&foo A"),
    ("<p>&#xD800;&#99999999;</p>", "\N{REPLACEMENT CHARACTER}" * 2),
    ("<p>&nbsp;x&nbsp;y</p>", "x\xa0y"),
    # The chunk that takes the sum above the limit stays whole and is the last one.
    ("<div>" + "x" * 16_000 + "</div><p>z</p>", "x" * 16_000),
    ("<div>" + "x" * 15_000 + "</div><p>z</p><p>y</p>", "x" * 15_000 + " z"),
    ("<p>" + "x" * 9_000 + "</p>" + "<p>" + "y" * 9_000 + "</p><p>z</p>",
     "x" * 9_000 + " " + "y" * 9_000),
]


@pytest.mark.parametrize("html,expected", CASES, ids=range(len(CASES)))
def test_read_cover(html, expected):
    assert read_cover(html) == expected


def test_unclosed_wrapper_is_read_to_the_end():
    html = "<div>a" + "<p>" + "x" * 20_000 + "</p>tail"
    assert read_cover(html) == "a " + "x" * 20_000 + " tail"


def test_missing_document():
    assert read_cover(None) is None


def test_as_column(spark):
    rows = [(i, html) for i, (html, _) in enumerate(CASES)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, html string").repartition(4)
    got = dict(df.select("id", cover_text(F.col("html"))).collect())
    assert got == {i: cover for i, (_, cover) in enumerate(CASES)} | {99: None}


def test_parsed_once_below_a_filter(spark, plan):
    df = spark.createDataFrame([(1, "<p>a</p>")], "id int, html string")
    covers = df.withColumn("cover", cover_text(F.col("html"))).where("cover is not null")
    assert plan(covers.where("length(cover) > 0")).count("ArrowEvalPython") == 1


class Tree(HTMLParser):
    """The document as nested lists ``[tag, child, ...]``, for reading the rules literally."""

    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.open = [["root"]]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.open[-1].append([tag])
        if tag not in VOID:
            self.open.append(self.open[-1][-1])

    def handle_endtag(self, tag):
        if tag in [node[0] for node in self.open[1:]]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        self.open[-1].append(data)

    def handle_comment(self, data):
        self.open[-1].append(["comment"])

    def strings(self, node):
        for child in node[1:]:
            if isinstance(child, str):
                yield child.strip()
            elif child[0] not in ("script", "style"):
                yield from self.strings(child)

    def blocks(self, node):
        for child in node[1:]:
            if not isinstance(child, str):
                if child[0] in BLOCKS:
                    yield " ".join(filter(None, self.strings(child)))
                yield from self.blocks(child)


def by_tree(html, limit):
    tree = Tree(html)
    chunks, total = [], 0
    for chunk in tree.blocks(tree.open[0]):
        if total <= limit and chunk:
            chunks.append(chunk)
            total += len(chunk)
    return " ".join(chunks)


TOKENS = st.sampled_from(
    ["<p>", "</p>", "<div>", "</div>", "<span class='a'>", "</span>", "<td>", "</td>", "<b>", "</b>",
     "<table>", "</table>", "<br>", "<hr/>", "<!-- c -->", "word", " two words ", "\n", "x" * 30,
     "<script>var a = '<p>';</script>", "<style>p{}</style>", "<P>", "</DIV>"]
)


@settings(max_examples=600, deadline=None)
@given(st.lists(TOKENS, max_size=40).map("".join), st.sampled_from([0, 5, 40, 200]))
def test_random_documents(html, limit):
    assert _CoverReader(limit).cover(html) == by_tree(html, limit)
