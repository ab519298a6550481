"""Turning the fixed patterns into Spark (Java) regular expressions."""

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# ``\s`` of the specification also covers the four separator control characters.
_SPACE = r"[\s\x1c-\x1f]"


def regex(pattern: str, ignore_case: bool = False) -> str:
    """Java form of a fixed pattern.

    ``U`` makes the classes Unicode-aware (a no-break space is a space) and ``d`` lets ``.`` stop
    at a line feed only.
    """
    flags = "(?dUi)" if ignore_case else "(?dU)"
    return flags + pattern.replace(r"\s", _SPACE)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def once(value: Column) -> Column:
    """``value`` as a generated column, for costly expressions that are filtered on later.

    Catalyst copies a projected expression into the filters above it and would evaluate it again
    there, once per use. It does not push a filter below the generator that made its column.
    The price: the value is computed even where only other columns of the row are wanted.
    """
    return F.explode(F.array(value))


def whole_number(text: Column) -> Column:
    """A JSON number as bigint, also where it is written with a fraction or an exponent."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def json_object(body: Column, schema: StructType, malformed: str | None = None) -> Column:
    """A JSON object by schema, strictly read: no single quotes, nothing after the object.

    NULL where the body is no object; ``malformed`` names a field of the schema for broken text.
    """
    options = {"allowSingleQuotes": "false"}
    if malformed:
        options["columnNameOfCorruptRecord"] = malformed
    return F.from_json(F.when(F.rtrim(body, F.lit(" \n\r\t")).endswith("}"), body), schema, options)


_DIGITS = "".join(chr(c) for c in range(128, sys.maxunicode) if unicodedata.category(chr(c)) == "Nd")
_ASCII_DIGITS = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def ascii_digits(text: Column) -> Column:
    """Digits of any script as 0-9, so that they can be cast. ``text`` is used three times."""
    has_others = text.rlike(r"[\p{Nd}&&[^0-9]]")
    return F.when(has_others, F.translate(text, _DIGITS, _ASCII_DIGITS)).otherwise(text)
