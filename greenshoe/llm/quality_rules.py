"""Quality by lines first: drop the lines that rules reject, then documents that lose too much.

A line is rejected for its punctuation (symbols or shouting marks on most words), as navigation
(many short items between separators) or as boilerplate (fixed phrases). A document goes if less
than half of its word characters stand in lines that stay.

Null and empty texts have no words and are not kept. Rows that repeat are judged each on its own,
null ids too. A very long text is judged whole, by one task, which holds a hash for each of its
words. An empty table gives no rows. Other columns are ignored. Word windows are compared by 64-bit
hashes.
"""

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe.llm.shared import SPACES, bounded_batches, window_hashes, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MOST_REPEATED_PERCENT = 20, 30
# Rules of lines. Marks are counted per word; navigation has at most so many words an item.
MARKS = re.compile(r"[#*$%&<>!]")
MOST_MARKS_PER_WORD = 0.5
SEPARATOR = re.compile(r"[|»›•]")
LEAST_SEPARATORS, MOST_WORDS_PER_ITEM = 3, 3
BOILERPLATE = re.compile(
    rb"all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|accept cookies"
    rb"|enable javascript|lorem ipsum|released under the|licensed under the|subscribe to our"
)
LEAST_KEPT_PERCENT = 50

FIGURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_bad_lines", "bad_word_chars",
]


def line_verdict(line: str) -> str | None:
    """The rule that rejects a line with words: punctuation, navigation, boilerplate; or None."""
    data = line.encode("utf-8", "surrogatepass")
    words = len(data.split())
    if len(MARKS.findall(line)) > MOST_MARKS_PER_WORD * words:
        return "punctuation"
    separators = len(SEPARATOR.findall(line))
    if separators >= LEAST_SEPARATORS and words - separators <= MOST_WORDS_PER_ITEM * (
        separators + 1
    ):
        return "navigation"
    if BOILERPLATE.search(data.lower()):
        return "boilerplate"
    return None


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, SPACES))


def repeated_words(hashes: np.ndarray) -> int:
    """Words that stand in a window whose words stand in another window too."""
    windows = window_hashes(hashes, list(range(WINDOW)), WINDOW)
    _, index, counts = np.unique(windows, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[index] > 1)
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def measure(text: str) -> list[int]:
    """The figures of one text, in the order of ``FIGURES``."""
    hashes = word_hashes(text.encode("utf-8", "surrogatepass"))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    bad = [line for line in lines if line_verdict(line)]
    return [
        len(hashes),
        word_chars(text),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes) if len(hashes) >= WINDOW else 0,
        len(bad),
        sum(map(word_chars, bad)),
    ]


def measure_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document its figures, ``base_failed`` and ``kept``. Map-only.

    ``kept`` needs both: the base figures pass, and the lines that stay hold enough of the text.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t or "") for t in batch.column(1).to_pylist()]
            figures = [pa.array([f[k] for f in found], pa.int64()) for k in range(len(FIGURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *figures], ["_id", *FIGURES])

    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, " + ", ".join(f"{f} long" for f in FIGURES)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    left = F.col("word_chars") - F.col("bad_word_chars")
    enough = 100 * left >= LEAST_KEPT_PERCENT * F.col("word_chars")
    return (
        rows.mapInArrow(run, schema)
        .withColumnRenamed("_id", id_col)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & enough)
    )


def cleaned(text: str) -> str:
    """A text without the lines that the rules reject; lines without words stay."""
    return "\n".join(
        line for line in text.split("\n") if not line.strip(SPACES) or not line_verdict(line)
    )
