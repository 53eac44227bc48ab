"""Text to typed values; text that does not fit gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text such as "4.0", which counts as the whole number in front of the point.
_WITH_FRACTION = r"^\s*([+-]?\d+)\.\d*\s*$"

# Text such as "4.0", which is a whole number.
_WHOLE = r"^\s*([+-]?\d+)\.0*\s*$"

# How text begins or looks that a conversion may take: it skips blanks and control characters
# at both ends. A conversion that fails raises and catches an error, which costs thirty times
# what the pattern does.
_DIGITS = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"
_DATE = r"^[\x00-\x20\x7F]*[+-]?[0-9]{4}"


def _number(text: Column, kind: str, with_point: str) -> Column:
    """``text`` as ``kind``, or the number in front of the point of text like ``with_point``."""
    cut = F.when(text.rlike(with_point), F.regexp_extract(text, with_point, 1).try_cast(kind))
    # Most numbers of a delivery are one digit, which takes no pattern to see.
    digit = (F.length(text) == 1) & (text >= "0") & (text <= "9")
    return F.when(digit | text.rlike(_DIGITS), text.try_cast(kind)).otherwise(cut)


def whole_number(text: Column, kind: str) -> Column:
    """``text`` as ``int`` or ``bigint``; a fraction is cut off."""
    return _number(text, kind, _WITH_FRACTION)


def parsed(text: Column, kind: str) -> Column:
    """``text`` as ``kind``: text unchanged, whole numbers, or an ISO date."""
    if kind == "string":
        return text
    if kind in ("int", "bigint"):
        return whole_number(text, kind)
    return F.when(text.rlike(_DATE), text.try_cast(kind)) if kind == "date" else text.try_cast(kind)


def parsed_key(text: Column, kind: str) -> Column:
    """Like :func:`parsed`, but a fraction other than zeros gives NULL: cutting it off would merge two keys."""
    if kind in ("int", "bigint"):
        return _number(text, kind, _WHOLE)
    return parsed(text, kind)


def blank_to_null(text: Column, words: tuple[str, ...]) -> Column:
    """NULL where ``text`` is one of ``words``."""
    return F.when(~text.isin(*words), text) if words else text


def rejected(text: Column, value: Column) -> Column:
    """Number of values that hold ``text`` but gave no usable ``value``."""
    return counted(text.isNotNull() & value.isNull())


def counted(condition: Column) -> Column:
    """Number of rows that fulfil ``condition``.

    The planner works out what `count_if` counts in a projection before it, together with all
    else of a row. That code soon is longer than what the virtual machine compiles, and runs
    several times slower; a plain count keeps its condition to itself.
    """
    return F.count(F.when(condition, F.lit(1)))
