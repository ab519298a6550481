"""Offering terms from a cover text: type, price and shares.

A pattern is tried with its first match only. When that match is out of bounds the next
pattern is tried, never the next match. "Readable" text has normalized whitespace and digits 0-9.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe.functions.dialect import let, regex

# Stands for "matched, but holds no digit", which makes the whole filing an error.
NO_DIGITS = -1


def offering_type(lower_cover: Column) -> Column:
    """spac, follow_on, ipo or unknown, from the cover as it is but lower-cased."""

    def has(signal: str) -> Column:
        return F.contains(lower_cover, F.lit(signal))

    def has_any(signals: list[str]) -> Column:
        found = has(signals[0])
        for signal in signals[1:]:
            found = found | has(signal)
        return found

    spac_hits = sum((has(s).cast("int") for s in V.SPAC_SIGNALS), F.lit(0))
    no_market = lower_cover.rlike(regex(V.NO_MARKET_PATTERN))
    return (
        F.when(spac_hits >= V.SPAC_SIGNALS_NEEDED, V.SPAC)
        .when(has_any(V.FOLLOW_ON_SIGNALS), V.FOLLOW_ON)
        .when(has_any(V.IPO_SIGNALS), V.IPO)
        .when(
            lower_cover.rlike(regex(V.UNDERWRITING_PATTERN)),
            F.when(no_market, V.IPO).otherwise(V.FOLLOW_ON),
        )
        .otherwise(V.UNKNOWN)
    )


def price(text: Column) -> Column:
    """``struct(low, high)`` from readable text, NULL when no pattern gives a price."""
    ranges = [_price_range(text, p) for p in V.PRICE_RANGE_PATTERNS]
    singles = [_single_price(text, p) for p in V.SINGLE_PRICE_PATTERNS]
    return F.coalesce(*ranges, *singles)


def shares(text: Column) -> Column:
    """Shares offered from readable text; NULL when not found, ``NO_DIGITS`` on an error."""
    return F.coalesce(*[_share_count(text, p) for p in V.SHARE_PATTERNS])


def _first_match(text: Column, java: str, group: int, accept) -> Column:
    """``accept`` of the first match. Without a match nothing is cast: a failed cast is slow."""
    found = F.regexp_extract(text, java, group)
    return let(found, lambda match: F.when(match != "", accept(match)))


def _price_range(text: Column, pattern: str) -> Column:
    java = regex(pattern, ignore_case=True)

    def accept(phrase: Column) -> Column:
        # Both numbers are cut from the short phrase, so the cover is searched once.
        low, high = (F.regexp_extract(phrase, java, g).try_cast("double") for g in (1, 2))
        pair = F.struct(low.alias("low"), high.alias("high"))
        return F.when(low.between(*V.RANGE_LOW_BOUNDS) & (low <= high), pair)

    return _first_match(text, java, 0, accept)


def _single_price(text: Column, pattern: str) -> Column:
    def accept(match: Column) -> Column:
        amount = match.try_cast("double")
        pair = F.struct(amount.alias("low"), amount.alias("high"))
        return F.when(amount.between(*V.SINGLE_PRICE_BOUNDS), pair)

    return _first_match(text, regex(pattern, ignore_case=True), 1, accept)


def _share_count(text: Column, pattern: str) -> Column:
    def accept(match: Column) -> Column:
        digits = F.replace(match, F.lit(","), F.lit(""))
        count = digits.try_cast("bigint")
        return F.when(digits == "", F.lit(NO_DIGITS).cast("bigint")).when(
            count.between(*V.SHARE_BOUNDS), count
        )

    return _first_match(text, regex(pattern, ignore_case=True), 1, accept)
