"""Numbers out of text: ids, integer cents and two-place decimals.

A cell is matched against a pattern before it is cast. Under ANSI mode a plain
cast of one dirty cell would end the job, and a ``try_cast`` that fails builds and
drops an exception, which costs more than the whole rest of a row. Behind the
pattern hardly any cast fails.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaseload.functions.text import BLANK_CELL_WORDS, _col, blank_to_null, squeeze

_NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_WHOLE_PART = r"^[+-]?[0-9]+(\.[0-9]*)?$"

RATE_TYPE = "decimal(12,2)"
# Below this many dollars a double holds every cent.
DOUBLE_CENTS = 9.0e13


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMERIC), text.try_cast("double"))


def _whole(text: Column) -> Column:
    return F.when(text.rlike(_WHOLE_PART), F.substring_index(text, ".", 1).try_cast("bigint")).otherwise(
        _number(text).try_cast("bigint")
    )


def number(value: Column | str) -> Column:
    """Text to double, null on anything that is not a plain finite number."""
    return _number(squeeze(value))


def whole_number(value: Column | str) -> Column:
    """Text to bigint, cutting any fraction ("779153.0" -> 779153).

    Digits before the point go straight to bigint, so an id keeps every digit; only
    exponents take the way over double. More digits than a bigint holds give null.
    """
    return _whole(squeeze(value))


def id_text(value: Column | str) -> Column:
    """An id as text without a decimal tail; ids that are not numbers stay as they are,
    and so do the digits of an id that no number type holds."""
    text = squeeze(value)
    digits = F.when(text.rlike(_WHOLE_PART), F.substring_index(text, ".", 1))
    return F.coalesce(_whole(text).cast("string"), digits, F.when(text != "", text))


def id_before_point(value: Column | str) -> Column:
    return F.nullif(F.substring_index(squeeze(value), ".", 1), F.lit(""))


def _without_money_marks(value: Column | str) -> Column:
    return squeeze(F.regexp_replace(squeeze(value), r"^\$+|,", ""))


def rounded_cents(amount: Column) -> Column:
    """Dollars as double to cents; rint rounds a tie to the even neighbour, round() would not.
    Null beyond the range of a bigint."""
    return F.rint(amount * F.lit(100.0)).try_cast("bigint")


def _cents_of(text: Column) -> Column:
    """Cents of a numeric text; null where they do not fit a bigint.

    A double holds every cent of the amounts below ``DOUBLE_CENTS``, and its rounding is
    the rule there; larger amounts go over a decimal, which keeps all their digits.
    """
    amount = text.try_cast("double")
    wide = (F.bround(text.try_cast("decimal(38,18)"), 2) * F.lit(100)).try_cast("bigint")
    return F.when(F.abs(amount) < DOUBLE_CENTS, rounded_cents(amount)).otherwise(wide)


def cents(value: Column | str) -> Column:
    """Integer cents, dollar sign and commas allowed. 0 where there is no number, null
    where the number does not fit, which is a reject and never a zero."""
    # Marks are rare: only a cell that is no number as it stands is searched for them.
    text, plain = squeeze(value), _without_money_marks(value)
    marked = F.when(plain.rlike(_NUMERIC), _cents_of(plain)).otherwise(F.lit(0).cast("bigint"))
    return F.when(text.rlike(_NUMERIC), _cents_of(text)).otherwise(marked)


def cents_or_null(value: Column | str) -> Column:
    """Integer cents without any mark removed; null where there is no number or it does not fit."""
    text = squeeze(value)
    return F.when(text.rlike(_NUMERIC), _cents_of(text))


def signed_cents(value: Column | str) -> Column:
    """Integer cents without any mark removed; 0 where there is no number, null where it does not fit."""
    text = squeeze(value)
    return F.when(text.rlike(_NUMERIC), _cents_of(text)).otherwise(F.lit(0).cast("bigint"))


def not_negative(amount: Column) -> Column:
    """Nothing below zero; null stays null (``greatest`` would make it zero)."""
    return F.when(amount < 0, F.lit(0).cast("bigint")).otherwise(amount)


def floored_cents(value: Column | str) -> Column:
    """Marks allowed, never below zero, 0 where there is no number, null where it does not fit."""
    return not_negative(cents(value))


def negative_cents(value: Column | str) -> Column:
    return -F.abs(signed_cents(value))


def dollars(value: Column | str, marks: bool = True) -> Column:
    """Two-place decimal, ties to even, 0 where there is no number; null where the
    number does not fit the type, which is a reject and never a zero."""
    text = _without_money_marks(value) if marks else squeeze(value)
    exact = F.bround(text.try_cast("decimal(38,18)"), 2).try_cast(RATE_TYPE)
    return F.when(text.rlike(_NUMERIC), exact).otherwise(F.lit(0).cast(RATE_TYPE))


def rate(value: Column | str) -> tuple[Column, Column]:
    """(two-place decimal or null, error text or null) for a strict rate cell."""
    text = blank_to_null(value, BLANK_CELL_WORDS)
    exact = F.when(text.rlike(_NUMERIC), text.try_cast("decimal(38,18)"))
    result = F.bround(exact, 2).try_cast(RATE_TYPE)
    return result, F.when(text.isNotNull() & result.isNull(), F.lit("rate is not a number"))


def zero_takes(value: Column, other: Column) -> Column:
    """``other`` where ``value`` is zero or null."""
    return F.when(F.coalesce(value, F.lit(0)) == 0, other).otherwise(value)


def total_cents(columns: list[Column | str]) -> Column:
    """Sum of many nullable dollar cells in cents, never below zero; null beyond a bigint."""
    zero = F.lit(0.0)
    total = reduce(lambda a, b: a + b, [F.coalesce(number(_col(c)), zero) for c in columns], zero)
    return not_negative(rounded_cents(total))
