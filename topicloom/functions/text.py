"""Cleaning and tokenising: string column in, string or array column out."""

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as part of a word, and what counts as white space.
LETTER = "[a-zA-Z']"
SPACE = r"[\s\x0B\x85\p{Z}]"
NOT_SPACE = r"[^\s\x0B\x85\p{Z}]"

# The complement of LETTER written as ranges: the regex engine tests a plain
# class several times faster than a negated one.
NON_LETTER = r"[\x00-&(-@\[-`{-\x{10FFFF}]"

# LETTER with each letter by itself: the regex engine looks such a class up in one
# table and takes a call for each range otherwise. Camel case after a space.
_LOWER, _UPPER = string.ascii_lowercase, string.ascii_uppercase
_NOT_LETTERS = f"[^{_LOWER}{_UPPER}']++"
_CAMEL_CASE = f" [{_LOWER}']*+[{_UPPER}][{_LOWER}']*+[{_UPPER}][{_LOWER}{_UPPER}']*+"


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """Null, empty or white space only."""
    return ~F.coalesce(_column(c).rlike(NOT_SPACE), F.lit(False))


def trim_space(c) -> Column:
    """Trim every kind of white space, not only blanks.

    Tried once, at the start of the text; the last character to keep is looked for
    from the end.
    """
    return F.regexp_extract(_column(c), rf"(?s)\A{SPACE}*+(.*{NOT_SPACE})?", 1)


def extract_words(c, non_letter=NON_LETTER) -> Column:
    """Blank gives ''; else one leading space, and a space per non-letter."""
    c = _column(c)
    return F.when(is_blank(c), "").otherwise(
        F.concat(F.lit(" "), F.regexp_replace(c, non_letter, " "))
    )


def normalize_whitespace(c) -> Column:
    """Collapse each run of white space to its first character, then trim."""
    return trim_space(F.regexp_replace(_column(c), f"({SPACE}){SPACE}*", "$1"))


def has_more_than_one_word(c) -> Column:
    """More than one space, meant for the output of :func:`extract_words`."""
    return F.regexp_count(_column(c), F.lit(" ")) > 1


def drop_camel_case(c) -> Column:
    """Drop the tokens holding two or more upper-case letters."""
    return F.array_join(
        F.filter(F.split(_column(c), " "), lambda w: F.regexp_count(w, F.lit("[A-Z]")) <= 1), " "
    )


def clean_tokens(c, letter=LETTER) -> Column:
    """The words of a text without camel case, as an array in text order."""
    found = F.regexp_extract_all(F.coalesce(_column(c), F.lit("")), F.lit(f"{letter}+"), F.lit(0))
    return F.filter(found, lambda w: ~w.rlike("[A-Z][^A-Z]*[A-Z]"))


def clean_words(c, letter=LETTER) -> Column:
    """Extract, normalise and drop camel case without an array of words.

    After extraction only spaces are left between words, so one space for each run
    of other characters gives the same text. Other classes of letters take the runs
    of letters and join them.
    """
    if letter != LETTER:
        return F.array_join(clean_tokens(c, letter), " ")
    spaced = F.regexp_replace(F.coalesce(_column(c), F.lit("")), _NOT_LETTERS, " ")
    return F.trim(F.regexp_replace(F.concat(F.lit(" "), spaced), _CAMEL_CASE, ""))


def tokens(c) -> Column:
    """Split on single spaces."""
    return F.split(_column(c), " ")


def clean_value(c) -> Column:
    """Extract words and trim the ends; inner runs of spaces and null stay."""
    return F.trim(extract_words_or_null(c))


def extract_words_or_null(c) -> Column:
    c = _column(c)
    return F.when(c.isNotNull(), extract_words(c))
