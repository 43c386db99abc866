import time

import pytest
from pyspark.sql import functions as F

from topicloom.functions import headings, scoring, text
from topicloom.functions.headings import title_trim
from topicloom.functions.stopwords import STOP_WORDS


@pytest.mark.parametrize(
    "given, want",
    [(None, ""), ("", ""), (" \t\n", ""), ("  ", ""), ("it's", " it's"),
     ("C# 8", " C   "), ("été", "  t "), ("a\U0001F600b", " a b")],
)
def test_extract_words(value, given, want):
    assert value(text.extract_words, given) == want


@pytest.mark.parametrize("given, want", [("foo", False), ("foo bar", True), ("foo-", True)])
def test_more_than_one_word(value, given, want):
    assert value(lambda c: text.has_more_than_one_word(text.extract_words(c)), given) is want


@pytest.mark.parametrize(
    "given, want",
    [("a  b\t\tc", "a b\tc"), ("  a \nb\u0085", "a b"), ("", ""), ("\v\fx", "x")],
)
def test_normalize_whitespace(value, given, want):
    assert value(text.normalize_whitespace, given) == want


def test_drop_camel_case(value):
    assert value(text.drop_camel_case, "Read the DataFrame API docs") == "Read the docs"
    assert value(text.drop_camel_case, "") == ""


@pytest.mark.parametrize("given", ["Read the DataFrame API docs", "", "  ", "d'été x1y 'Tis NASA", None, "aB-Cd"])
def test_clean_words_equals_its_steps(value, given):
    def steps(c):
        return text.drop_camel_case(text.normalize_whitespace(text.extract_words(c)))

    assert value(text.clean_words, given) == value(steps, given)


def test_clean_value_keeps_inner_spaces_and_null(value):
    assert value(text.clean_value, "1. C# & more!") == "C    more"
    assert value(text.clean_value, None) is None


@pytest.mark.parametrize(
    "given, want", [("1. Setup steps ", "Setup steps"), ("Über uns", "ber uns"), ("日本", "日本"), (" 1 2 ", "1 2")]
)
def test_title_trim(value, given, want):
    assert value(headings.title_trim, given) == want


@pytest.mark.parametrize(
    "word, stop",
    [("abc", True), ("about", True), ("running", True), ("appendix", True), ("spark", False), ("", True)],
)
def test_stop_words(value, word, stop):
    assert value(scoring.is_stop_word, word) is stop


def test_stop_word_list_size():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 127
    assert sum(len(w) >= 4 for w in STOP_WORDS) == 69


READING = [
    (225, "< 1 minute"), (226, "1 minutes"), (450, "2 minutes"), (13499, "59 minutes"),
    (13500, "1 hours"), (13724, "1 hours"), (13725, "1 hours and 1 minutes"), (27000, "2 hours"),
]


def test_reading_time(spark):
    df = spark.createDataFrame(READING, "n bigint, want string")
    assert df.filter(scoring.reading_time("n") != F.col("want")).count() == 0


def test_idf_variants(spark):
    row = spark.range(1).select(
        scoring.inverse_document_frequency(F.lit(2), F.lit(3)).alias("outside"),
        scoring.inverse_document_frequency(F.lit(2), F.lit(3), "smooth").alias("smooth"),
    ).first()
    assert row.outside == pytest.approx(0.4620981204)
    assert row.smooth == pytest.approx(0.2876820725)
    with pytest.raises(ValueError):
        scoring.inverse_document_frequency(F.lit(1), F.lit(1), "other")


@pytest.mark.parametrize("inner", [" ", "\t", "\u00a0"])
def test_trim_is_linear_in_inner_blanks(value, inner):
    long = "a" + inner * 1_000_000 + "b"
    started = time.time()
    assert value(text.trim_space, f" {long}  ") == long
    assert value(title_trim, f"1. {long}{inner}") == long
    assert time.time() - started < 10
