"""Joins against a lookup table when a few keys hold much of the data."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PART = 1_000_000


def hot_keys(df: DataFrame, key: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``(key, _parts)`` of the keys with more rows than one task should get.

    Reads one column; the counts are combined before the shuffle. At most a millionth as many
    rows come out as go in (by ``rows_per_part``), so the result can be broadcast: for 10**12
    rows it is some tens of MB.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_rows"))
    return counts.where((F.col("_rows") > rows_per_part) & F.col(key).isNotNull()).select(
        key, F.ceil(F.col("_rows") / rows_per_part).cast("int").alias("_parts")
    )


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, hot: DataFrame, how: str = "left"
) -> DataFrame:
    """Equi-join of ``facts`` with a lookup table that has about one row per key.

    The rows of a hot key are dealt to its ``_parts`` parts, and only the lookup rows of hot keys
    are repeated, once per part. Every other key keeps the single part 0.
    ``how`` is ``left``, ``inner`` or ``left_semi``.

    The part follows from the row and the task it is in. So exact copies are spread as well, and
    a task that is repeated deals its rows the same way, in whatever order it gets them.
    """
    # Rows without a key match nothing; they only have to be spread over the shuffle.
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in facts.columns])
    dealt = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn(
            "_part",
            F.when(F.col(key).isNull(), F.pmod(spread, F.lit(tasks)))
            .when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts")))
            .otherwise(F.lit(0))
            .cast("int"),
        )
        .drop("_parts")
    )
    repeated = (
        lookup.join(F.broadcast(hot), key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_parts")
    )
    return dealt.join(repeated, [key, "_part"], how).drop("_part")
