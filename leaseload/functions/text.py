"""Text cleaning: blanks, names, truncation and joined text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for "no value" after trimming and lower-casing.
BLANK_WORDS = ("", "nan", "none")
BLANK_DATE_WORDS = ("", "nan", "nat", "none")
BLANK_CELL_WORDS = ("", "nan")
TRUE_WORDS = ("1", "true", "yes", "t", "y")

WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def squeeze(value: Column | str) -> Column:
    """Strip whitespace of every kind (tabs and line ends too) from both ends."""
    return F.btrim(_col(value), F.lit(WHITESPACE))


def folded(value: Column | str) -> Column:
    """Trimmed and lower-cased: the form in which closed vocabularies are compared."""
    return F.lower(squeeze(value))


def blank_to_null(value: Column | str, words: tuple[str, ...] = BLANK_WORDS) -> Column:
    text = squeeze(value)
    return F.when(~F.lower(text).isin(*words), text)


def clean_text(value: Column | str) -> Column:
    """Trimmed text, null where the cell holds nothing or a word for nothing."""
    return blank_to_null(value, BLANK_WORDS)


def has_value(value: Column | str) -> Column:
    """True where a cell counts as filled (never null itself)."""
    return F.coalesce(~folded(value).isin(*BLANK_DATE_WORDS), F.lit(False))


def is_empty(value: Column | str) -> Column:
    """True for null or whitespace only; words such as 'nan' count as filled."""
    return F.coalesce(squeeze(value) == "", F.lit(True))


def truthy(value: Column | str) -> Column:
    return F.coalesce(folded(value).isin(*TRUE_WORDS), F.lit(False))


def full_name(first: Column | str, middle: Column | str) -> Column:
    """First name with middle initial; no first name means no name at all."""
    head = clean_text(first)
    return F.when(head.isNotNull(), F.concat_ws(" ", head, clean_text(middle)))


def cut(value: Column, length: int) -> Column:
    return F.substring(value, 1, length)


def trimmed_or_null(value: Column | str) -> Column:
    """Trimmed text, null only where nothing is left."""
    return F.nullif(squeeze(value), F.lit(""))


def access_code(value: Column | str) -> Column:
    return cut(clean_text(value), 10)


def joined(separator: str, *parts: Column) -> Column:
    """Non-null parts joined by a separator, null where there is no part."""
    return F.nullif(F.concat_ws(separator, *parts), F.lit(""))


def last_comma_first(last: Column | str, first: Column | str) -> Column:
    return joined(", ", trimmed_or_null(last), trimmed_or_null(first))
