"""Text to number and boolean, where a bad value becomes null instead of an error.

A failed ``try_cast`` raises and catches an exception per row, which is slow where many values are bad
or empty. The patterns decide first, so that casts see only text they accept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to 18 digits always fit 64 bits.
_SHORT_INTEGER = r"^\s*[+-]?[0-9]{1,18}\s*\z"
_LONG_INTEGER = r"^\s*[+-]?[0-9]{19,}\s*\z"
_PLAIN = r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*\z"
_EXPONENT = r"^\s*[+-]?[0-9]+(\.[0-9]*)?[eE][+-]?[0-9]{1,2}\s*\z"

# The words Spark's own cast to boolean accepts.
_TRUE = ("true", "t", "yes", "y", "1")
_FALSE = ("false", "f", "no", "n", "0")


def to_long(col: Column) -> Column:
    """Whole part of a number given as text: '1.9' -> 1; text that is no number, or too big -> null."""
    text = col.cast("string")
    return F.when(text.rlike(_SHORT_INTEGER), text.cast("bigint")).when(
        text.rlike(_PLAIN), F.regexp_extract(text, _PLAIN, 1).try_cast("bigint")
    )


def to_long_or_zero(col: Column) -> Column:
    """Like ``to_long``, but also reads '1e3', and gives 0 instead of null."""
    text = col.cast("string")
    exponent = F.when(text.rlike(_EXPONENT), text.try_cast("decimal(38,6)").try_cast("bigint"))
    return F.coalesce(to_long(col), exponent, F.lit(0).cast("bigint"))


def to_boolean(col: Column) -> Column:
    word = F.lower(F.trim(col.cast("string")))
    return F.when(word.isin(*_TRUE), F.lit(True)).when(word.isin(*_FALSE), F.lit(False))


def api_int(col: Column) -> Column:
    """Counters of the nested payload: only whole numbers count, anything else ('1.5', 'x', absent) is 0."""
    number = F.when(col.rlike(_SHORT_INTEGER), col.cast("bigint")).when(col.rlike(_LONG_INTEGER), col.try_cast("bigint"))
    return F.coalesce(number, F.lit(0).cast("bigint"))


def digits_to_long(col: Column) -> Column:
    """An id is taken only if every character of it is a digit."""
    return F.when(col.rlike(r"^[0-9]+\z"), col.try_cast("bigint"))
