"""Step two: documents to top words, word count and reading time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import reading_time
from ..functions.sql import register_functions
from ..functions.stopwords import STOP_WORDS
from ..functions.text import clean_value, is_blank
from ..operators import terms
from ..operators.skew import join_salted
from ..schemas import ATTRIBUTES, HEADINGS, MODEL_INPUT
from ..session import materialize


def attributes(docs: DataFrame) -> DataFrame:
    """Distinct headings per document whose cleaned title is not blank.

    Made distinct before any join: what is joined later is unique per document.
    """
    return docs.select(*ATTRIBUTES).filter(~is_blank(clean_value("Title"))).dropDuplicates()


def document_words(docs: DataFrame, k: int = terms.TOP, stop_words=STOP_WORDS,
                   variant="outside") -> DataFrame:
    """Top words and word count, one row per document."""
    top = terms.top_words(terms.filtered_scores(docs, stop_words, variant), k)
    return terms.joined_top_words(top).join(terms.word_counts(docs), "File")


def model_input(docs: DataFrame, k: int = terms.TOP, stop_words=STOP_WORDS,
                variant="outside") -> DataFrame:
    """The *model input* table; documents without a ranked word are left out.

    Unsorted; order by File where a sorted output is wanted.
    """
    joined = join_salted(
        attributes(docs), document_words(docs, k, stop_words, variant), "File", HEADINGS
    )
    cleaned = {name: clean_value(name) for name in (*HEADINGS, "Top20Words")}
    return (
        joined.withColumns(cleaned)
        .withColumn("ReadingTime", reading_time("WordCount"))
        .select(*MODEL_INPUT.names)
    )


def register_views(spark, docs: DataFrame) -> None:
    """Offer the intermediate tables and the three functions by name to SQL.

    Terms and their scores are computed and stored once; a query over any of the
    views reads them and does not go through the texts again.
    """
    register_functions(spark)
    tf = materialize(terms.term_frequency(docs), "term-frequency")
    docs.createOrReplaceTempView("docs")
    tf.createOrReplaceTempView("termFrequency")
    terms.with_idf(terms.document_frequency(tf), docs).createOrReplaceTempView("documentFrequency")
    scores = materialize(terms.tf_idf(tf, docs), "scores")
    scores.createOrReplaceTempView("idfJoin")
    terms.word_counts(docs).createOrReplaceTempView("rollup")
    filtered = terms.drop_stop_words(scores).select("File", "word", terms.SCORE)
    filtered.createOrReplaceTempView("filteredWords")
    terms.rank_words(filtered).createOrReplaceTempView("top20")
