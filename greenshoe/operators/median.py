"""Exact median per group for large groups, by radix selection.

Spark's exact ``median`` keeps all distinct values of a group in one task. Here every double is a
64-bit number that orders as it does, and the number is read from the top, some bits at a time. A
pass counts how many values of a group have each digit, at most 2 ** bits counters, and these tell
which digit a middle rank has. The next pass looks only at values that begin so far. After the last
digit the value itself is known, however the values are distributed and however many are equal.
"""

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from greenshoe.session import materialize

# Bits of a digit, as of 64 in a key.
BITS, KEY_BITS = 16, 64
# So many rows at most are sent to all tasks: two per group, of some tens of bytes.
MOST_TARGETS = 100_000
_MANTISSA, _BIAS, _LEAST = 52, 1023, -1022


def ordered_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """With a bigint column that orders as a column of doubles does; zeros are equal, NaN is last.

    It is the number that the bits of the double stand for, negative for negative values. Powers of
    two and products with them are exact, so it can be put together by arithmetic.
    """
    size, low = F.abs(value), F.floor(F.log2(F.abs(value)))
    # The logarithm is rounded; the power next to it may be the one below the value.
    guess = F.when(F.pow(F.lit(2.0), low) > size, low - 1).when(
        F.pow(F.lit(2.0), low + 1) <= size, low + 1
    )
    exponent = F.greatest(F.coalesce(guess, low), F.lit(_LEAST))
    is_number = (size < float("inf")) & (size > 0)
    one = F.lit(2.0**_MANTISSA)
    half = F.lit(2.0 ** ((_MANTISSA - _LEAST) // 2))
    normal = (F.col("_e") + _BIAS) * F.lit(2**_MANTISSA) + (
        (size / F.pow(F.lit(2.0), F.col("_e")) - 1) * one
    ).cast("bigint")
    small = (size * half * half).cast("bigint")
    infinite = F.lit((2 * _BIAS + 1) * 2**_MANTISSA)
    bits = (
        F.when(F.isnan(value), infinite + 1)
        .when(size == float("inf"), infinite)
        .when(size == 0, F.lit(0).cast("bigint"))
        .when(size < 2.0**_LEAST, small)
        .otherwise(normal)
    )
    return (
        df.withColumn("_e", F.when(is_number & ~F.isnan(value), exponent).cast("int"))
        .withColumn(name, F.when(F.col(value) < 0, -bits).otherwise(bits))
        .drop("_e")
    )


def _start(shift: int) -> Column:
    """What a key begins with, as a number that orders the same."""
    return F.shiftright("_key", shift) if shift else F.col("_key")


def _ranked(counts: DataFrame, by: list[str]) -> DataFrame:
    """Of the counted digits of each target the one that holds its rank.

    ``_rank`` counts from 1 within the values that are looked at, and is then taken on to the
    values with this digit. A task ranks the counters of a target, never its values.
    """
    running = Window.partitionBy(*by).orderBy("_digit")
    upto = F.sum("_c").over(running.rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("_to") - F.col("_c")
    found = counts.withColumn("_to", upto).where((before < F.col("_rank")) & (F.col("_to") >= F.col("_rank")))
    return found.withColumn("_rank", F.col("_rank") - before).drop("_to", "_c")


def _first_targets(known: DataFrame, bits: int) -> DataFrame:
    """Per group its mean and, for each middle rank, the first digit and the rank within it."""
    counts = known.groupBy("_g", _start(KEY_BITS - bits).alias("_digit")).agg(
        F.count("*").alias("_c"), F.sum("_v").alias("_sum")
    )
    whole = Window.partitionBy("_g")
    n = F.sum("_c").over(whole)
    middle = F.array_distinct(
        F.array(F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1)
    )
    counts = counts.select("*", n.alias("_n"), (F.sum("_sum").over(whole) / n).alias("_mean"))
    targets = counts.select("_g", "_digit", "_c", "_mean", F.posexplode(middle).alias("_which", "_rank"))
    return _ranked(targets, ["_g", "_which"])


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _cells(known: DataFrame, targets: DataFrame, bits: int, few: bool) -> DataFrame:
    """The distinct values that begin as a target does, with their number."""
    begin = targets.withColumnsRenamed({"_g": "_tg", "_digit": "_begin"})
    begins = _same("_g", "_tg") & (_start(KEY_BITS - bits) == F.col("_begin"))
    chosen = known.join(F.broadcast(begin) if few else begin, begins)
    return chosen.groupBy("_g", "_which", "_mean", "_rank", "_key").agg(
        F.count("*").alias("_c"), F.min("_v").alias("_v")
    )


def _next_digit(
    cells: DataFrame, chosen: DataFrame | None, shift: int, bits: int, few: bool
) -> DataFrame:
    """Per target the digit at ``shift`` that holds its rank, among values that begin as chosen."""
    if chosen is not None:
        begin = chosen.select(
            F.col("_g").alias("_tg"),
            F.col("_which").alias("_tw"),
            F.col("_digit").alias("_begin"),
            F.col("_rank").alias("_left"),
        )
        begins = (
            _same("_g", "_tg")
            & (F.col("_which") == F.col("_tw"))
            & (_start(shift + bits) == F.col("_begin"))
        )
        cells = cells.join(F.broadcast(begin) if few else begin, begins)
        cells = cells.withColumn("_rank", F.col("_left"))
    counts = cells.groupBy("_g", "_which", "_mean", "_rank", _start(shift).alias("_digit")).agg(
        F.sum("_c").alias("_c"), F.min("_v").alias("_v")
    )
    return _ranked(counts, ["_g", "_which"])


def exact_median(df: DataFrame, group: str, value: str, bits: int = BITS) -> DataFrame:
    """``(group, mean, median)`` over the non-NULL values; a NULL group is a group too.

    ``df`` is read twice, so pass a table, not a long plan. The second time only values that share
    a middle value's first digit are kept, counted together where they are equal, and written; the
    other digits are read from these. Where there are few groups, as of sectors, the values are not
    shuffled before they are counted.
    """
    known = df.where(F.col(value).isNotNull()).select(
        F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")
    )
    known = ordered_key(known, "_v", "_key")
    written = Observation("median-targets")
    targets = _first_targets(known, bits).observe(written, F.count("*").alias("n"))
    targets = materialize(targets, "median-targets")
    few = written.get.get("n", 0) <= MOST_TARGETS
    cells = materialize(_cells(known, targets, bits, few), "median-cells")
    chosen = None
    for shift in range(KEY_BITS - 2 * bits, -1, -bits):
        chosen = _next_digit(cells, chosen, shift, bits, few)
    # One value is left per middle rank. Minus zero is zero.
    medians = chosen.groupBy("_g").agg(
        F.first("_mean").alias("mean"), ((F.min("_v") + F.max("_v")) / 2).alias("median")
    )
    return medians.select(F.col("_g").alias(group), "mean", "median")
