"""Sources mixed to target weights over a time-varying curriculum.

Each source has a weight schedule over training time from 0 to 1. Its integral, scaled to the
source's target, is the source's cumulative demand of words. The source's documents lie one after
the other in a fixed pseudo-random order, the whole source again after its end as often as the
target asks for, and the moment at which the demand reaches the middle of a document is its
training position. Documents of all sources sorted by position are the training order.

Weights are 1, 2, 3, repeating, for the sources by code point (null last). Targets share the
size of all documents by weight; a target ends at ``MOST_EPOCHS`` times its source's size, and
the excess goes to the others by weight. A document is taken whole or not at all, each time, so a
source's words differ from its target by less than half a document.

Null and empty texts have size 0 and take no words. Rows that repeat are documents of their own;
among equal rows it does not matter which one is taken. Null ids sort first. A very long text is
one document like any other, taken whole or not at all. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenshoe.llm.shared import WORD, Scratch, text_of

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
# Weight schedules (time, weight), linear in between; sources take them in turn.
CURRICULA = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0)),
    ((0.0, 2.0), (0.5, 1.0), (1.0, 0.5)),
)
# A source's documents are cut into 16**3 blocks by the hash that orders them.
BLOCK_DIGITS = 3


def n_words(text_col: str) -> Column:
    return F.size(F.regexp_extract_all(text_of(text_col), F.lit(WORD), F.lit(0)))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One narrow row per document: its size and its place in the order of its source."""
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.xxhash64(text_of(text_col)).alias("text_hash"),
        n_words(text_col).cast("long").alias("size"),
        order.alias("place"),
    ).withColumn("block", F.substring("place", 1, BLOCK_DIGITS))


def targets(sizes: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Per source its ``source_size``, number and ``target``; ``sizes`` has (source, size).

    Sources are few; their totals are ranked in one task. The level that uncapped targets share
    is found by capping the sources in the order in which a rising level reaches their cap.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("number") % len(weights) + 1)
    cap = F.lit(float(most_epochs)) * F.col("source_size")
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    earlier = Window.orderBy("reached", "number").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything).cast("double")
    capped = F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    sharing = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(earlier), F.lit(0)
    )
    level = (total - F.lit(float(most_epochs)) * capped) / sharing
    # The level with the first k sources capped is right for the first k where it stays below the
    # next cap. It sinks from there on, so it is the greatest of those that do.
    fits = F.when(F.col("level") <= F.col("reached"), F.col("level"))
    return (
        by_source.withColumn("number", number)
        .withColumn("weight", weight)
        .withColumn("reached", cap / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.max(fits).over(everything))
        .select(
            "source",
            "number",
            "source_size",
            F.least(cap, F.col("level") * F.col("weight")).alias("target"),
        )
    )


def curriculum(curricula=CURRICULA) -> Column:
    """The schedule of source ``number`` as segments with the share of demand before and in each."""
    schedules = []
    for knots in curricula:
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
        whole, done, segments = sum(areas), 0.0, []
        for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
            segments.append((t0, t1 - t0, w0 / whole, w1 / whole, done))
            done += area / whole
        fields = ("t", "dt", "w0", "w1", "before")
        schedules.append(
            F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, s)]) for s in segments])
        )
    return F.element_at(F.array(*schedules), F.col("number") % len(curricula) + 1)


def moment(share: Column, segments: Column) -> Column:
    """The time at which the integral of the schedule is ``share``.

    In the segment the integral is w0 x + (w1 - w0) x^2 / (2 dt), so x is a root of a quadratic,
    here in the form that also holds for a constant weight.
    """
    s = F.element_at(F.filter(segments, lambda s: s["before"] <= share), -1)
    rest = share - s["before"]
    slope = (s["w1"] - s["w0"]) / s["dt"]
    root = F.sqrt(F.greatest(s["w0"] * s["w0"] + 2 * slope * rest, F.lit(0.0)))
    return F.least(s["t"] + 2 * rest / (s["w0"] + root), s["t"] + s["dt"])


def training_plan(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The documents with what is taken of them, and the training order.

    Documents: ``row`` (a number), doc_id, source, text_hash, size, source_size, target, ``times``
    (how often it is taken). Order: one row each time, (row, doc_id, text_hash, source, epoch,
    position), sorted over all partitions by position.

    Running sums go over blocks of a source, and over the totals of its blocks; no task holds a
    whole source.
    """
    sizes = sized(docs, id_col, text_col, source_col).withColumn(
        "row", F.monotonically_increasing_id()
    )
    sizes = scratch.save(sizes, "sizes")
    blocks = sizes.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    before = Window.partitionBy("source").orderBy("block")
    earlier = F.sum("block_size").over(before.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(
        F.col("source").alias("_source"),
        F.col("block").alias("_block"),
        F.coalesce(earlier, F.lit(0)).alias("block_start"),
    )
    inside = Window.partitionBy("source", "block").orderBy(
        "place", "doc_id", "size", "text_hash", "row"
    )
    start = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = sizes.withColumn("start", F.coalesce(start, F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    placed = placed.join(blocks, same).drop("_source", "_block")
    shares = targets(sizes.select("source", "size")).withColumnRenamed("source", "_source")
    middle = F.col("block_start") + F.col("start") + F.col("size") / 2
    times = F.ceil((F.col("target") - F.col("middle")) / F.col("source_size"))
    taken = (
        placed.join(shares, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("middle", middle)
        .withColumn("times", F.when(F.col("source_size") > 0, F.greatest(times, F.lit(0))))
        .withColumn("times", F.least(F.coalesce("times", F.lit(0)), F.lit(MOST_EPOCHS)))
        .select(
            "row", "doc_id", "source", "text_hash", "size", "source_size", "target", "number",
            "middle", F.col("times").cast("int").alias("times"),
        )
    )
    documents = scratch.save(taken, "taken")
    share = (F.col("middle") + F.col("epoch") * F.col("source_size")) / F.col("target")
    order = (
        documents.where(F.col("times") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
        .withColumn("position", moment(share, curriculum()))
        .select("row", "doc_id", "text_hash", "source", "epoch", "position")
        .orderBy("position", "source", "doc_id", "epoch")
    )
    return documents, order


def mixed_documents(docs: DataFrame, order: DataFrame) -> DataFrame:
    """The documents in training order, each as often as it is taken, with all their columns.

    Equal rows of ``docs`` are one document here, taken as often as all of them together.
    """
    # The columns go along as one, so that their names do not matter.
    row = F.struct(*[docs[c] for c in docs.columns])
    d = docs.select(
        docs["doc_id"].alias("_id"),
        docs["source"].alias("_source"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("_hash"),
        row.alias("_row"),
    ).dropDuplicates(["_id", "_source", "_hash"])
    same = (
        d["_id"].eqNullSafe(order["doc_id"])
        & d["_source"].eqNullSafe(order["source"])
        & (d["_hash"] == order["text_hash"])
    )
    joined = d.join(order, same).orderBy("position", "source", "doc_id", "epoch")
    return joined.select("_row.*")
