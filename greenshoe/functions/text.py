"""Text helpers: normalizing, masking, phrases, previews."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe.functions.dialect import regex

def normalize_whitespace(text: Column) -> Column:
    """Every run of whitespace becomes one space; the ends are not trimmed."""
    return F.regexp_replace(text, regex(V.WHITESPACE_PATTERN), " ")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, regex(r"^\s+|\s+$"), "")


def pad_key(cik: Column) -> Column:
    """Left-pad with zeros to the lookup width; longer keys stay whole (``lpad`` would cut them)."""
    width = F.greatest(F.lit(V.LOOKUP_KEY_WIDTH), F.length(cik))
    return F.call_function("lpad", cik, width, F.lit("0"))


def dollar_phrases(cover: Column) -> Column:
    return F.regexp_extract_all(cover, F.lit(regex(V.DOLLAR_PHRASE_PATTERN)), F.lit(0))


def share_phrases(cover: Column) -> Column:
    """The first ten phrases that look like a large share count."""
    pattern = regex(V.SHARE_PHRASE_PATTERN, ignore_case=True)
    phrases = F.regexp_extract_all(cover, F.lit(pattern), F.lit(0))
    return F.slice(phrases, 1, V.SHARE_PHRASES_KEPT)


def mask_numbers(phrase: Column) -> Column:
    masked = F.regexp_replace(phrase, regex(V.NUMBER_PATTERN), "#")
    return F.substring(masked, 1, V.FREQUENCY_MASK_CHARS)


def mask_digits(phrase: Column) -> Column:
    masked = F.regexp_replace(phrase, regex(V.DIGIT_PATTERN), "#")
    return F.substring(masked, 1, V.DISTINCT_MASK_CHARS)


def name_contains_any(name: Column, parts: list[str]) -> Column:
    """True where the name contains one of ``parts``, whatever the case."""
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(F.lower(name), F.lit(part.lower()))
    return found
