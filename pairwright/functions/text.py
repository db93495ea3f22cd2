"""Column expressions over text.  All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that standardized text keeps.
KEPT_CHARACTERS = "A-Z0-9ĄĆĘŁŃÓŚŹŻ "
POLISH_UPPER = "ĄĆĘŁŃÓŚŹŻ"
POLISH_FOLDED = "ACELNOSZZ"


def _other_than(kept: str) -> str:
    """A pattern for one character outside a class.

    ``[^...]`` means the same, but Java searches a text with it several times more slowly.
    """
    return rf"(?![{kept}])[\s\S]"


def standardize(value: Column) -> Column:
    """Upper case, then delete everything but letters, digits and spaces.

    Deleted characters leave no space behind (``37/36`` becomes ``3736``) and
    runs of spaces are kept.  Null stays null; numbers are read as text.
    """
    return F.regexp_replace(F.upper(value.cast("string")), _other_than(KEPT_CHARACTERS), "")


def clean_tokens(value: Column, keep_diacritics: bool = False) -> Column:
    """Turn every run of other characters into one space and trim.

    The default keeps ``A-Z0-9`` only, so Polish letters act as separators
    (``ŁÓDZKA`` becomes ``DZKA``); ``keep_diacritics`` keeps them.
    """
    kept = "A-Z0-9" + (POLISH_UPPER if keep_diacritics else "")
    return F.trim(F.regexp_replace(value, f"(?:{_other_than(kept)})++", " "))


def split_tokens(value: Column) -> Column:
    """Space-separated tokens in order, without the empty ones."""
    return F.filter(F.split(value, " "), lambda token: token > "")


def regex_full(value: Column, pattern: str, ignore_case: bool = False) -> Column:
    """True when the whole string matches; ``rlike`` alone only searches."""
    flags = "(?i)" if ignore_case else ""
    return value.rlike(rf"{flags}\A(?:{pattern})\z")


def regex_group(value: Column, pattern: str, group: int = 1, ignore_case: bool = True) -> Column:
    """A trimmed capture group of the first match, or null without a match."""
    flags = "(?i)" if ignore_case else ""
    return F.nullif(F.trim(F.regexp_extract(value, flags + pattern, group)), F.lit(""))


def soundex(value: Column, fold: bool = False) -> Column:
    """Soundex code; ``fold`` first maps Polish letters to their base letter.

    Without folding a value whose first character is not A-Z comes back as is.
    """
    return F.soundex(F.translate(value, POLISH_UPPER, POLISH_FOLDED) if fold else value)


def edit_score(left: Column, right: Column) -> Column:
    """1 minus edit distance over the longer length, as a double.

    Null when either side is null, and when both sides are empty.
    """
    longest = F.greatest(F.length(left), F.length(right))
    return F.lit(1.0) - F.try_divide(F.levenshtein(left, right).cast("double"), longest.cast("double"))


def edit_score_of_cores(left: Column, right: Column, left_core: Column, right_core: Column) -> Column:
    """:func:`edit_score` of two values, given both without some characters that all values begin and end with."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.lit(1.0) - F.try_divide(F.levenshtein(left_core, right_core).cast("double"), longest.cast("double"))


def edit_score_bound(left: Column, right: Column) -> Column:
    """An upper bound of :func:`edit_score` from the two lengths alone.

    The distance is at least the difference of the lengths.  The bound uses
    the same arithmetic as the score, so rounding cannot reverse the two.
    """
    longest = F.greatest(F.length(left), F.length(right))
    shortest = F.least(F.length(left), F.length(right))
    return F.lit(1.0) - F.try_divide((longest - shortest).cast("double"), longest.cast("double"))


def edit_score_same(value: Column) -> Column:
    """:func:`edit_score` of a value with itself: 1, or null for no text."""
    return F.when(F.length(value) > 0, F.lit(1.0))
