"""Term statistics and the top words of each document."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import inverse_document_frequency, is_stop_word, reading_time
from ..functions.stopwords import STOP_WORDS
from ..functions.text import is_blank, tokens
from .skew import join_weighted

SCORE = "termFreq_inverseDocFreq"
# Fixed value: words kept per document.
TOP = 20


def corpus_size(docs: DataFrame) -> DataFrame:
    """One row with the number of documents, repeated keys included."""
    return docs.agg(F.count(F.lit(1)).alias("total"))


def _tokens_or_null() -> Column:
    """Tokens of Words; a document without words has none (not one empty token)."""
    return F.when(~is_blank("Words"), tokens("Words"))


def words(docs: DataFrame) -> DataFrame:
    """One row per token, as written."""
    return docs.select("File", F.explode(_tokens_or_null()).alias("word"))


def term_frequency(docs: DataFrame) -> DataFrame:
    """Count of each lower-case word per document.

    Tokens are counted in the task that reads the text, by generated code, before
    anything is shuffled: what leaves is a row for each document and distinct word,
    so neither a frequent word nor a large document ends up in one task, and texts
    are not shuffled.
    """
    lowered = docs.select("File", F.lower("Words").alias("Words"))
    found = lowered.select("File", F.explode(_tokens_or_null()).alias("word"))
    return found.groupBy("File", "word").agg(F.count(F.lit(1)).alias("count"))


def document_frequency(tf: DataFrame) -> DataFrame:
    """Number of documents per word; ``tf`` is already distinct on both.

    Written over ``count`` so that this use of ``tf`` needs the same columns as
    the join to it: then both read one shuffle instead of making two.
    """
    return tf.groupBy("word").agg(F.count_if(F.col("count") > 0).alias("docFrequency"))


def with_idf(df: DataFrame, docs: DataFrame, variant="outside") -> DataFrame:
    """Add corpus size and inverse document frequency to document frequencies."""
    sized = df.withColumn("total", corpus_size(docs).scalar())
    return sized.withColumn(
        "inverseDocFrequency", inverse_document_frequency("docFrequency", "total", variant)
    )


def drop_stop_words(rows: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """Leave out short and listed words.

    A DataFrame with a ``word`` column may stand for a further list. It can be
    large, so it is meant for rows with one word each, such as document
    frequencies; :func:`filtered_scores` takes it there for term rows.
    """
    if isinstance(stop_words, DataFrame):
        return rows.filter(~is_stop_word("word")).join(
            stop_words.select("word").distinct(), "word", "left_anti"
        )
    return rows.filter(~is_stop_word("word", stop_words))


def tf_idf(tf: DataFrame, docs: DataFrame, variant="outside",
           listed: DataFrame | None = None) -> DataFrame:
    """Score of each word in each document of ``docs``, given its ``tf`` rows.

    Words of ``listed`` are left out. They are marked in the table with one row
    per word and leave after the join, so that frequent ones need no join of
    their own with the term rows.
    """
    idf = with_idf(document_frequency(tf), docs, variant).drop("total")
    if listed is not None:
        marks = listed.select("word").distinct().withColumn("_listed", F.lit(True))
        idf = idf.join(marks, "word", "left")
    joined = join_weighted(tf, idf, "word", "docFrequency", ["File"])
    if listed is not None:
        joined = joined.filter("_listed IS NULL")
    return joined.select(
        "File",
        "word",
        "docFrequency",
        "inverseDocFrequency",
        "count",
        (F.col("inverseDocFrequency") * F.col("count")).alias(SCORE),
    )


def filtered_scores(docs: DataFrame, stop_words=STOP_WORDS, variant="outside") -> DataFrame:
    """Scores without stop words.

    Stop words leave before counting: the document frequency of a word does not
    depend on other words, so the scores are the same with far fewer rows. A
    DataFrame with a ``word`` column is a list in addition to the default one.
    """
    listed = stop_words if isinstance(stop_words, DataFrame) else None
    known = STOP_WORDS if listed is not None else stop_words
    kept = drop_stop_words(term_frequency(docs), known)
    return tf_idf(kept, docs, variant, listed).select("File", "word", SCORE)


def rank_words(scores: DataFrame) -> DataFrame:
    """Number the words of a document by falling score, ties by word."""
    order = Window.partitionBy("File").orderBy(F.desc(SCORE), "word")
    return scores.withColumn("RowNumber", F.row_number().over(order))


def top_words(scores: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best words per document.

    The limit on the row number is applied before the shuffle too, so a map task
    sends at most ``k`` rows of a document.
    """
    return rank_words(scores).filter(F.col("RowNumber") <= k)


def joined_top_words(top: DataFrame) -> DataFrame:
    """The top words of a document as one string, best first.

    File leaves as a value of its group and not as the key: a later join on it would
    push its test for null down to one of the two uses of the term rows, which then
    no longer share one shuffle, and the texts would be split twice.
    """
    best = F.array_sort(F.collect_list(F.struct("RowNumber", "word")))
    text = F.concat_ws(" ", F.transform(best, lambda x: x["word"]))
    grouped = top.groupBy(F.col("File").alias("_file"))
    return grouped.agg(F.first("File").alias("File"), text.alias("Top20Words")).drop("_file")


def word_counts(docs: DataFrame) -> DataFrame:
    """Words per document, stop words included.

    The token count of a row is known without exploding it, so one number per
    row is shuffled and not one row per word.
    """
    counted = docs.select("File", F.size(_tokens_or_null()).cast("bigint").alias("n"))
    sums = counted.groupBy("File").agg(F.sum("n").alias("WordCount"))
    return sums.filter(F.col("WordCount").isNotNull())


def with_reading_time(counts: DataFrame) -> DataFrame:
    return counts.withColumn("ReadingTime", reading_time("WordCount"))
