"""Words, term statistics and model input."""

from pyspark.sql import functions as F

from ..functions import text
from ..functions.scoring import is_stop_word, reading_time
from ..functions.sql import register_functions
from ..operators import terms
from ..plans.rank import model_input, register_views
from . import corpus as c


def extract_words(spark, sf_dir):
    return c.texts(spark, sf_dir).select("File", text.extract_words("text").alias("words"))


def normalize_whitespace(spark, sf_dir):
    return c.texts(spark, sf_dir).select("File", text.normalize_whitespace("text").alias("words"))


def camel_case_filter(spark, sf_dir):
    spaced = text.normalize_whitespace(text.extract_words("text"))
    return c.texts(spark, sf_dir).select("File", text.drop_camel_case(spaced).alias("words"))


def clean_words(spark, sf_dir):
    return c.plain_docs(spark, sf_dir)


def multi_word_filter(spark, sf_dir):
    extracted = c.lines(spark, sf_dir).withColumn("words", text.extract_words("line"))
    kept = extracted.filter(text.has_more_than_one_word("words"))
    return kept.select("File", F.col("pos").cast("bigint").alias("pos"), "words")


def tokens(spark, sf_dir):
    found = terms.words(c.plain_docs(spark, sf_dir))
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def term_frequency(spark, sf_dir):
    return terms.term_frequency(c.plain_docs(spark, sf_dir))


def document_frequency(spark, sf_dir):
    return terms.document_frequency(terms.term_frequency(c.plain_docs(spark, sf_dir)))


def corpus_size(spark, sf_dir):
    return terms.corpus_size(c.plain_docs(spark, sf_dir))


def inverse_document_frequency(spark, sf_dir):
    docs = c.plain_docs(spark, sf_dir)
    return terms.with_idf(terms.document_frequency(terms.term_frequency(docs)), docs)


def smooth_idf(spark, sf_dir):
    docs = c.plain_docs(spark, sf_dir)
    df = terms.document_frequency(terms.term_frequency(docs))
    return terms.with_idf(df, docs, "smooth").select(
        "word", F.round("inverseDocFrequency", 9).alias("idf")
    )


def tfidf_scores(spark, sf_dir):
    docs = c.plain_docs(spark, sf_dir)
    return terms.tf_idf(terms.term_frequency(docs), docs)


def stop_word_filter(spark, sf_dir):
    return terms.filtered_scores(c.plain_docs(spark, sf_dir))


def user_stop_words(spark, sf_dir):
    """Words of the benchmark table as a further stop list."""
    items = c.table(spark, sf_dir, "benchmark", "text")
    listed = items.select(F.explode(text.clean_tokens(F.lower("text"))).alias("word"))
    df = terms.document_frequency(terms.term_frequency(c.plain_docs(spark, sf_dir)))
    return terms.drop_stop_words(df, listed).select("word", "docFrequency")


def top_words(spark, sf_dir):
    top = terms.top_words(terms.filtered_scores(c.plain_docs(spark, sf_dir)))
    return top.withColumn("RowNumber", F.col("RowNumber").cast("bigint"))


def joined_top_words(spark, sf_dir):
    top = terms.top_words(terms.filtered_scores(c.plain_docs(spark, sf_dir)))
    return terms.joined_top_words(top)


def word_count(spark, sf_dir):
    return terms.word_counts(c.plain_docs(spark, sf_dir))


def reading_times(spark, sf_dir):
    return terms.with_reading_time(terms.word_counts(c.plain_docs(spark, sf_dir)))


def long_reading_times(spark, sf_dir):
    """Reading time of larger counts, to reach the hour texts."""
    counts = terms.word_counts(c.plain_docs(spark, sf_dir))
    return counts.select("File", reading_time(F.col("WordCount") * 37).alias("ReadingTime"))


def model_input_rows(spark, sf_dir):
    return model_input(c.stored_docs(spark, sf_dir))


def page_model_input(spark, sf_dir):
    return model_input(c.page_docs(spark, sf_dir).drop("lang"))


def shared_file_key(spark, sf_dir):
    """Documents merged under one key per language: many rows, one word list."""
    docs = c.texts(spark, sf_dir).select(
        F.col("lang").alias("File"),
        F.concat(F.lit("Title of "), "File").alias("Title"),
        *[F.lit(None).cast("string").alias(f"Subtitle{i}") for i in range(1, 6)],
        text.clean_words("text").alias("Words"),
    )
    return model_input(docs)


def sql_functions(spark, sf_dir):
    """The three functions by name from SQL text."""
    register_functions(spark)
    docs = c.plain_docs(spark, sf_dir)
    df = terms.document_frequency(terms.term_frequency(docs))
    df.withColumn("total", terms.corpus_size(docs).scalar()).createOrReplaceTempView("frequencies")
    return spark.sql(
        "SELECT word, CalculateIdf(docFrequency, total) AS idf, "
        "CalculateReadingTime(docFrequency * 40) AS reading FROM frequencies WHERE NOT IsStopWord(word)"
    )


def term_views(spark, sf_dir):
    """Top words by SQL over the named views."""
    register_views(spark, c.plain_docs(spark, sf_dir))
    return spark.sql(
        "SELECT t.File, t.word, t.termFreq_inverseDocFreq, r.WordCount FROM top20 t "
        "INNER JOIN rollup r ON t.File = r.File WHERE t.RowNumber <= 20"
    )


QUERIES = {
    "extract_words": extract_words,
    "normalize_whitespace": normalize_whitespace,
    "camel_case_filter": camel_case_filter,
    "clean_words": clean_words,
    "multi_word_filter": multi_word_filter,
    "tokens": tokens,
    "term_frequency": term_frequency,
    "document_frequency": document_frequency,
    "corpus_size": corpus_size,
    "inverse_document_frequency": inverse_document_frequency,
    "smooth_idf": smooth_idf,
    "tfidf_scores": tfidf_scores,
    "stop_word_filter": stop_word_filter,
    "user_stop_words": user_stop_words,
    "top_words": top_words,
    "joined_top_words": joined_top_words,
    "word_count": word_count,
    "reading_time": reading_times,
    "long_reading_time": long_reading_times,
    "model_input": model_input_rows,
    "page_model_input": page_model_input,
    "shared_file_key": shared_file_key,
    "sql_functions": sql_functions,
    "term_views": term_views,
}

_SHARED = (
    'SELECT lang AS "File", \'Title of \' || "File" AS "Title", '
    + ", ".join(f'CAST(NULL AS VARCHAR) AS "Subtitle{i}"' for i in range(1, 6))
    + f', {c.sql_clean("text")} AS "Words" FROM texts'
)
c.define("shared", ("texts",), _SHARED)
c.define_terms("shared", "shared_")

SQL = {
    "extract_words": c.with_tables(
        f'SELECT "File", {c.sql_extract("text")} AS words FROM texts', "texts"
    ),
    "normalize_whitespace": c.with_tables(
        f'SELECT "File", {c.sql_normalize("text")} AS words FROM texts', "texts"
    ),
    "camel_case_filter": c.with_tables(
        f'SELECT "File", {c.sql_clean("text")} AS words FROM texts', "texts"
    ),
    "clean_words": c.with_tables("SELECT * FROM plain_docs", "plain_docs"),
    "multi_word_filter": c.with_tables(
        f'SELECT "File", pos, words FROM (SELECT "File", pos, {c.sql_extract("line")} AS words FROM lines) '
        "WHERE length(words) - length(replace(words, ' ', '')) > 1",
        "lines",
    ),
    "tokens": c.with_tables(
        "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(\"Words\", ' ')) AS word "
        "FROM plain_docs WHERE \"Words\" <> '') GROUP BY word",
        "plain_docs",
    ),
    "term_frequency": c.with_tables("SELECT * FROM tf", "tf"),
    "document_frequency": c.with_tables('SELECT word, "docFrequency" FROM df', "df"),
    "corpus_size": c.with_tables("SELECT count(*) AS total FROM plain_docs", "plain_docs"),
    "inverse_document_frequency": c.with_tables("SELECT * FROM df", "df"),
    "smooth_idf": c.with_tables(
        'SELECT word, round(ln((total + 1) / ("docFrequency" + 1)), 9) AS idf FROM df', "df"
    ),
    "tfidf_scores": c.with_tables("SELECT * FROM scores", "scores"),
    "stop_word_filter": c.with_tables("SELECT * FROM filtered", "filtered"),
    "user_stop_words": c.with_tables(
        f'SELECT word, "docFrequency" FROM df WHERE NOT {c.sql_stop("word")} AND word NOT IN ('
        "SELECT unnest(regexp_extract_all(lower(\"text\"), '[a-zA-Z'']+')) FROM benchmark)",
        "df",
    ),
    "top_words": c.with_tables('SELECT * FROM top', "top"),
    "joined_top_words": c.with_tables(
        "SELECT \"File\", string_agg(word, ' ' ORDER BY \"RowNumber\") AS \"Top20Words\" "
        'FROM top GROUP BY "File"',
        "top",
    ),
    "word_count": c.with_tables("SELECT * FROM rollup", "rollup"),
    "reading_time": c.with_tables(
        f'SELECT "File", "WordCount", {c.sql_reading_time(chr(34) + "WordCount" + chr(34))} '
        'AS "ReadingTime" FROM rollup',
        "rollup",
    ),
    "long_reading_time": c.with_tables(
        f'SELECT "File", {c.sql_reading_time("(37 * " + chr(34) + "WordCount" + chr(34) + ")")} '
        'AS "ReadingTime" FROM rollup',
        "rollup",
    ),
    "model_input": c.with_tables("SELECT * FROM doc_model_input", "doc_model_input"),
    "page_model_input": c.with_tables("SELECT * FROM page_model_input", "page_model_input"),
    "shared_file_key": c.with_tables("SELECT * FROM shared_model_input", "shared_model_input"),
    "sql_functions": c.with_tables(
        'SELECT word, "inverseDocFrequency" AS idf, '
        f'{c.sql_reading_time("(40 * " + chr(34) + "docFrequency" + chr(34) + ")")} AS reading '
        f"FROM df WHERE NOT {c.sql_stop('word')}",
        "df",
    ),
    "term_views": c.with_tables(
        'SELECT t."File", t.word, t."termFreq_inverseDocFreq", r."WordCount" '
        'FROM top t JOIN rollup r ON r."File" = t."File"',
        "top", "rollup",
    ),
}
