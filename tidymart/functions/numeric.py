"""Numeric coercion, ratios and range tests as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidymart.functions.text import whitespace

_BLANK = f"[{whitespace()}]*"
# Decimal notation of any length. Spark's own cast would also accept "12d", "NaN" and "0x1p3".
_NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
NUMBER_RE = rf"^{_BLANK}({_NUMBER}){_BLANK}\z"
WHOLE_RE = rf"^{_BLANK}([+-]?[0-9]+)(?:\.0*)?{_BLANK}\z"
INTEGER_RE = rf"^{_BLANK}([+-]?[0-9]+){_BLANK}\z"


def _part(c: Column, pattern: str, kind: str) -> Column:
    """Cast what the pattern finds; no match gives an empty text, and that casts to null."""
    return F.regexp_extract(c.cast("string"), pattern, 1).try_cast(kind)


def _plain(c: Column) -> Column:
    """The text begins and ends with a digit and has no x: if a cast reads it as a number, it is in decimal notation."""
    text = c.cast("string")
    ends = F.substring(text, 1, 1).between("0", "9") & F.substring(text, -1, 1).between("0", "9")
    return ends & ~F.contains(text, F.lit("x")) & ~F.contains(text, F.lit("X"))


def to_number(c: Column) -> Column:
    """Text to double; null when it is not in decimal notation or too large for a finite double.

    The pattern is only tried on texts with something around their digits, as it costs several times the cast.
    """
    value = F.when(_plain(c), c.cast("string").try_cast("double")).otherwise(_part(c, NUMBER_RE, "double"))
    return F.when(F.abs(value) < float("inf"), value)


def to_count(c: Column) -> Column:
    """Text to a whole count, cut toward zero; what is not a finite number counts as 0.

    A count beyond 64 bits fails the job: it can't be summed, and 0 would hide it.
    """
    value = to_number(c)
    beyond = F.raise_error(F.concat(F.lit("a count beyond 64 bits: "), c.cast("string"))).cast("bigint")
    cut = F.when(F.abs(value) < 2.0**63, value.cast("bigint")).when(value.isNotNull(), beyond)
    plain = F.when(_plain(c), c.cast("string").try_cast("bigint"))
    return F.coalesce(plain, _part(c, WHOLE_RE, "bigint"), cut, F.lit(0).cast("bigint"))


def to_year(c: Column) -> Column:
    """Text to a whole year; null when it is not a whole number."""
    value = to_number(c)
    unusual = F.when(value == F.floor(value), value.try_cast("bigint"))
    return F.coalesce(_part(c, WHOLE_RE, "bigint"), unusual)


def positive_flag(c: Column) -> Column:
    return F.coalesce(to_number(c) > 0, F.lit(False)).cast("int")


def round_half_even(c: Column, digits: int) -> Column:
    """Scale, round half to even, scale back (Spark's ``round`` rounds half up)."""
    scale = float(10**digits)
    return F.rint(c * scale) / F.lit(scale)


def safe_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded quotient, null when the denominator is 0."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return round_half_even(quotient, digits)


def percentage(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, null when the whole is 0."""
    return round_half_even(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 2)


def leading_int(c: Column, separator: str = ".") -> Column:
    """Integer before the first separator, null when there is none."""
    return _part(F.split_part(c, F.lit(separator), F.lit(1)), INTEGER_RE, "bigint")


def in_range(c: Column, low, high) -> Column:
    """Inclusive range test; null is outside."""
    return F.coalesce(c.between(low, high), F.lit(False))
