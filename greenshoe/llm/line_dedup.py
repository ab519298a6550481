"""Lines that many documents share stay in one of them; the result is bitmaps, not texts.

A line's key is the line without white space at its ends and with A-Z lower-cased. Keys are
hashed, range-partitioned by hash, and sorted by hash, document (largest first) and position. So
the first document of a key streams past first and keeps its lines; all others lose theirs if
the key is in enough documents. Keys with a thousandth of all lines or more are found in a sample
beforehand and cut into slices, each with a first document of its own; the slices' firsts are
then merged. The sample only decides where rows are worked on, never what the result is.

Null and empty texts are one empty line. Keys are compared by their 64-bit hash. Rows with the
same id and text are one document and all of them get its bitmap; a null id ranks below all
others. A very long text is cut into its lines, which are worked on apart; its bitmap is made of
runs. An empty table gives no rows. Other columns are ignored. Only DataFrame operations are used.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenshoe.llm.shared import SPACES, Scratch, ascii_lower, text_of

MIN_CHARS, MIN_DOCUMENTS = 20, 3
# The sample for frequent keys holds about so many lines; a key is frequent from so many on, so
# that there are at most 1,000 of them. Each is cut into so many slices.
SAMPLE_LINES, FREQUENT_LINES, SLICES = 1_000_000, 1_000, 256


def lines_of(text: str) -> Column:
    return F.split(text_of(text), "\n", -1)


def long_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(hash of the key, document, position) of every line with a key that is long enough."""
    trimmed = F.btrim(F.col("_line"), F.lit(SPACES))
    return (
        docs.select(
            F.col(id_col).alias("_id"),
            F.xxhash64(text_of(text_col)).alias("_text"),
            F.posexplode(lines_of(text_col)).alias("_pos", "_line"),
        )
        .select("_id", "_text", "_pos", trimmed.alias("_key"))
        .where(F.length("_key") >= min_chars)
        .select("_id", "_text", "_pos", F.xxhash64(ascii_lower(F.col("_key"))).alias("_hash"))
    )


def frequent_keys(lines: DataFrame) -> DataFrame:
    """Keys that hold about a thousandth of all lines; at most 1,000 rows, by the sample's size."""
    share = min(1.0, SAMPLE_LINES / max(lines.count(), 1))
    sample = lines.select("_hash").sample(share, seed=1)
    return sample.groupBy("_hash").count().where(F.col("count") >= FREQUENT_LINES).select("_hash")


def _drops_in_order(lines: DataFrame, min_documents: int) -> DataFrame:
    """Positions to drop, for keys that fit one task: a stream over each key's documents."""
    spread = lines.repartitionByRange("_hash").sortWithinPartitions(
        "_hash", F.desc_nulls_last("_id"), "_pos"
    )
    by_document = Window.partitionBy("_hash").orderBy(F.desc_nulls_last("_id"))
    ranked = spread.withColumn("_rank", F.dense_rank().over(by_document))
    everything = by_document.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = ranked.withColumn("_documents", F.last("_rank").over(everything))
    late = (F.col("_rank") > 1) & (F.col("_documents") >= min_documents)
    return counted.where(late).select("_id", "_text", "_pos")


def _drops_in_slices(lines: DataFrame, min_documents: int) -> DataFrame:
    """Positions to drop, for frequent keys: first documents by slice, then of all slices."""
    sliced = lines.withColumn("_slice", F.pmod(F.xxhash64("_id"), F.lit(SLICES)))
    firsts = sliced.groupBy("_hash", "_slice").agg(
        F.max("_id").alias("_first"), F.count_distinct(F.struct("_id")).alias("_n")
    )
    # At most 1,000 keys by the way they were chosen.
    keys = firsts.groupBy("_hash").agg(
        F.max("_first").alias("_first"), F.sum("_n").alias("_documents")
    )
    late = (F.col("_documents") >= min_documents) & ~F.col("_id").eqNullSafe(F.col("_first"))
    return lines.join(F.broadcast(keys), "_hash").where(late).select("_id", "_text", "_pos")


def _kept_runs(n_lines: Column, dropped: Column) -> Column:
    """The kept lines as runs (first line, number of lines): the bitmap, run-length encoded."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(n_lines))
    gaps = F.zip_with(
        before,
        after,
        lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")),
    )
    return F.filter(gaps, lambda run: run["length"] > 0)


def keep_bitmaps(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Per document ``doc_id``, ``text_hash`` (xxhash64), ``n_lines``, ``n_dropped``, ``keep``.

    ``keep`` is the bitmap of kept lines as runs of ones (start, length). No text is shuffled.
    """
    lines = scratch.save(long_lines(docs, id_col, text_col, min_chars), "lines")
    frequent = scratch.save(frequent_keys(lines), "frequent")
    rare = lines.join(F.broadcast(frequent), "_hash", "left_anti")
    often = lines.join(F.broadcast(frequent), "_hash", "left_semi")
    drops = _drops_in_order(rare, min_documents).unionByName(_drops_in_slices(often, min_documents))
    dropped = drops.groupBy("_id", "_text").agg(
        F.sort_array(F.collect_set("_pos")).alias("_dropped")
    )
    documents = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text_of(text_col)).alias("text_hash"),
            F.size(lines_of(text_col)).alias("n_lines"),
        )
        .groupBy("doc_id", "text_hash")
        .agg(F.max("n_lines").alias("n_lines"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_text"))
    none = F.array().cast("array<int>")
    positions = F.coalesce(F.col("_dropped"), none)
    return documents.join(dropped, same, "left").select(
        "doc_id",
        "text_hash",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size(positions).cast("long").alias("n_dropped"),
        _kept_runs(F.col("n_lines"), positions).alias("keep"),
    )


def kept_lines(text_col: str) -> Column:
    """The text that a bitmap ``keep`` leaves of ``text_col``."""
    parts = F.transform(
        F.col("keep"), lambda run: F.slice(F.col("_lines"), run["start"] + 1, run["length"])
    )
    return F.array_join(F.flatten(parts), "\n")


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with ``n_lines``, ``n_dropped`` and its ``kept`` text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_t"))
    rows = rows.withColumn("_hash", F.xxhash64("_t"))
    b = bitmaps.withColumnRenamed("doc_id", "_id")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("text_hash"))
    return (
        rows.join(b, same)
        .withColumn("_lines", F.split("_t", "\n", -1))
        .select("doc_id", "n_lines", "n_dropped", kept_lines("_t").alias("kept"))
    )
