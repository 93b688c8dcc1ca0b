"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

#: A run of them, in ranges: a pattern tests every character against each part of a class.
_WHITESPACE_RUN = (r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029"
                   r"\u202f\u205f\u3000]+")
#: What an ASCII text holds if a run in it is not a single space.
_ASCII_RUNS = ["  ", *(w for w in WHITESPACE if w < "\x20")]

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove any Unicode whitespace at both ends (``trim`` removes spaces only)."""
    return F.btrim(column(c), F.lit(WHITESPACE))


def title(c: Column | str) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the rest.

    ``initcap`` starts words at spaces only and would leave ``Semi-cama``.
    """
    words = F.split(F.lower(column(c)), f"(?<=[^{_CASED}])(?=[{_CASED}])")
    return F.array_join(F.transform(words, capitalize_lowered), "")


def capitalize_lowered(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), word.substr(F.lit(2), F.length(word)))


def title_case(c: Column | str) -> Column:
    return title(strip(c))


def capitalized(c: Column | str) -> Column:
    """First character upper, all others lower, ends stripped."""
    return capitalize_lowered(F.lower(strip(c)))


def upper_case(c: Column | str) -> Column:
    return F.upper(strip(c))


def lower_case(c: Column | str) -> Column:
    return F.lower(strip(c))


def phone(c: Column | str) -> Column:
    """Drop all spaces; a missing number becomes the empty text."""
    digits = strip(F.translate(column(c), " ", ""))
    return F.coalesce(F.nullif(digits, F.lit("nan")), F.lit(""))


def passenger_name(c: Column | str) -> Column:
    """Fill a missing name, strip, squeeze whitespace runs, upper-case. An ASCII name whose
    only white space is single spaces has nothing to squeeze and needs no pattern."""
    filled = F.coalesce(column(c), F.lit("SIN REGISTRO"))
    single = F.octet_length(filled) == F.length(filled)
    for run in _ASCII_RUNS:
        single = single & ~F.contains(filled, F.lit(run))
    squeezed = F.regexp_replace(strip(filled), _WHITESPACE_RUN, " ")
    return F.upper(F.when(single, F.btrim(filled)).otherwise(squeezed))


def has_outer_space(c: Column | str) -> Column:
    return column(c) != strip(c)


def is_mixed_case(c: Column | str) -> Column:
    """Neither all upper nor all lower."""
    text = column(c)
    return (text != F.upper(text)) & (text != F.lower(text))


def is_irregular_case(c: Column | str) -> Column:
    """Neither all upper, all lower, nor title case."""
    text = column(c)
    return is_mixed_case(text) & (text != title(text))
