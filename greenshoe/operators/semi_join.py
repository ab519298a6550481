"""Semi join of wide rows with the keys that are wanted, which are few of many.

A plain semi join shuffles every row before most of them are dropped. Here a Bloom filter of the
keys is sent to the rows first, so that only rows that are wanted, and about one in a thousand of
the others, move. The exact semi join follows. The filter has at most ``MOST_BLOCKS`` blocks,
whatever the number of keys: a fuller one lets more rows through and loses none.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenshoe.session import materialize

WORDS, WORD_BITS = 8, 64
# Bits per key, and bits that each key sets in its block.
BITS_PER_KEY, PROBES = 16, 4
# 16 MB of bits, some 40 MB as rows.
MOST_BLOCKS = 1 << 18


def _block(key: str, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def _place(key: str, probe: int) -> Column:
    """The bit of a block that a probe looks at; its bits of the hash are not those of the block."""
    mixed = F.xxhash64(key, F.lit("bit"))
    return F.shiftright(mixed, 9 * probe).bitwiseAND(F.lit(WORDS * WORD_BITS - 1)).cast("int")


def _word(place: Column) -> Column:
    return F.shiftright(place, 6)


def _bit(place: Column) -> Column:
    return place.bitwiseAND(F.lit(WORD_BITS - 1))


def n_blocks_for(n_keys: int) -> int:
    needed = -(-n_keys * BITS_PER_KEY // (WORDS * WORD_BITS))
    return min(MOST_BLOCKS, 1 << max(0, needed - 1).bit_length())


def key_filter(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """``(_block, _words)``: the blocks of the filter that hold a key."""
    places = F.array(*[_place(key, k) for k in range(PROBES)])
    set_bits = keys.select(_block(key, n_blocks).alias("_block"), F.explode(places).alias("_place"))
    one = F.lit(1).cast("bigint")
    words = set_bits.groupBy("_block", _word(F.col("_place")).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, _place & 63)")).alias("_bits")
    )
    by_word = F.map_from_entries(F.collect_list(F.struct("_word", "_bits")))
    zero = one - one
    whole = F.transform(
        F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.col("_map")[w], zero)
    )
    return words.groupBy("_block").agg(by_word.alias("_map")).select("_block", whole.alias("_words"))


def prefilter(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key the filter lets through: all that are wanted and few others. Map-only."""
    n_blocks = n_blocks_for(keys.count())
    blocks = F.broadcast(key_filter(keys, key, n_blocks))
    passes = F.lit(True)
    for probe in range(PROBES):
        place = _place(key, probe)
        word = F.get(F.col("_words"), _word(place))
        # The bit in question becomes the sign.
        shifted = F.call_function("shiftleft", word, F.lit(WORD_BITS - 1) - _bit(place))
        passes &= shifted < 0
    kept = df.withColumn("_block", _block(key, n_blocks)).join(blocks, "_block").where(passes)
    return kept.select(*df.columns)


def semi_join(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is among ``keys``.

    The keys are written once, as they are read for the filter and for the join. They are distinct,
    so an inner join does: Catalyst would push a semi join below the filter's join.
    """
    wanted = materialize(keys.select(key).where(F.col(key).isNotNull()).distinct(), "wanted-keys")
    return prefilter(df, wanted, key).join(wanted, key).select(*df.columns)
