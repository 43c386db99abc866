"""Scores, stop words and reading time."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import MIN_WORD_LENGTH, STOP_WORDS
from .text import _column

# Fixed value: reading speed behind the reading time texts.
WORDS_PER_MINUTE = 225.0


def inverse_document_frequency(doc_frequency, total, variant="outside") -> Column:
    """``ln(N+1)/(df+1)``; ``variant="smooth"`` takes the log of the quotient."""
    df, n = _column(doc_frequency), _column(total)
    if variant == "outside":
        return F.log(n + 1) / (df + 1)
    if variant == "smooth":
        return F.log((n + 1) / (df + 1))
    raise ValueError(f"unknown idf variant: {variant}")


def is_stop_word(word, stop_words=STOP_WORDS) -> Column:
    """Short or listed."""
    word = _column(word)
    return (F.length(word) < MIN_WORD_LENGTH) | word.isin(*stop_words)


def reading_time(word_count) -> Column:
    """Word count to a text such as ``12 minutes`` or ``1 hours and 3 minutes``."""
    minutes = _column(word_count) / F.lit(WORDS_PER_MINUTE)

    def whole(value):
        return F.floor(value).cast("string")

    hours = F.concat(whole(minutes / 60), F.lit(" hours"))
    rest = minutes % 60
    return (
        F.when(minutes <= 1, "< 1 minute")
        .when(minutes < 60, F.concat(whole(minutes), F.lit(" minutes")))
        .when(rest < 1, hours)
        .otherwise(F.concat(hours, F.lit(" and "), whole(rest), F.lit(" minutes")))
    )
