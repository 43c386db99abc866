"""Phrases, category names and the summary, with the page language as category."""

from pyspark.sql import functions as F

from ..operators import summary
from ..plans.rank import model_input
from ..session import materialize, release, spread_input
from . import corpus as c


def categorised_pages(spark, sf_dir):
    """Model input of the pages with their language."""
    pages = spread_input(materialize(c.page_docs(spark, sf_dir), "page-docs"))
    return model_input(pages.drop("lang")).join(pages.select("File", "lang"), "File")


def title_prefixes(spark, sf_dir):
    titles = c.page_docs(spark, sf_dir)
    rows = summary.title_prefixes(titles.select("File", "Title"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def _counts(spark, sf_dir):
    return _named_counts(categorised_pages(spark, sf_dir))


def _named_counts(rows, *sources):
    """Every phrase counted by its mark, with its text; the stored ``sources`` of the rows go."""
    texts = summary.numbered_texts(rows, "lang")
    release(*sources)
    return summary.with_phrases(summary.marked_counts(summary.marked_phrases(rows, "lang", texts)), rows, "lang", texts).drop("size", "a", "b")


def _ranked(rows, *sources):
    """Every phrase with its number, by marks, and its text; the stored ``sources`` of the rows go."""
    texts = summary.numbered_texts(rows, "lang")
    release(*sources)
    counts = summary.marked_counts(summary.marked_phrases(rows, "lang", texts))
    ranked = summary.with_phrases(summary.rank_marked_phrases(counts), rows, "lang", texts)
    return ranked.select("category", "cnt", "first_seen", "phrase", "weight", "rn")


def _flat(df):
    first = F.col("first_seen")
    return df.select(
        *[c for c in df.columns if c != "first_seen"],
        first["File"].alias("first_file"),
        first["src"].cast("bigint").alias("first_src"),
        first["pos"].cast("bigint").alias("first_pos"),
    )


def phrase_counts(spark, sf_dir):
    return _flat(_counts(spark, sf_dir))


def phrase_rank(spark, sf_dir):
    return _flat(_ranked(categorised_pages(spark, sf_dir)))


def phrase_weight_squared(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return counts.select(
        "category", "phrase", summary.phrase_weight("phrase", "cnt", "length_squared").alias("weight")
    )


def category_title(spark, sf_dir):
    return summary.category_titles(summary.best_phrases(materialize(categorised_pages(spark, sf_dir), "categorised"), "lang"))


def category_summary(spark, sf_dir):
    lines = summary.summary_lines(materialize(categorised_pages(spark, sf_dir), "categorised"), "lang")
    return summary.numbered_summary(lines).select(
        "category", F.col("ord").cast("bigint").alias("ord"), "line", "position"
    )


def _documents(spark, sf_dir):
    """Model input of the documents with their language, and the stored table it reads; titles are whole lines."""
    labels = c.texts(spark, sf_dir).select("File", "lang")
    docs = c.stored_docs(spark, sf_dir)
    return model_input(docs).join(labels, "File"), docs


def _document_counts(spark, sf_dir):
    return _named_counts(*_documents(spark, sf_dir))


def document_phrase_counts(spark, sf_dir):
    return _flat(_document_counts(spark, sf_dir))


def document_phrase_rank(spark, sf_dir):
    return _flat(_ranked(*_documents(spark, sf_dir)))


def document_title_prefixes(spark, sf_dir):
    rows = summary.title_prefixes(c.stored_docs(spark, sf_dir).select("File", "Title"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def document_category_summary(spark, sf_dir):
    rows, docs = _documents(spark, sf_dir)
    rows = materialize(rows, "categorised")
    release(docs)
    lines = summary.summary_lines(rows, "lang")
    return summary.numbered_summary(lines).select(
        "category", F.col("ord").cast("bigint").alias("ord"), "line", "position"
    )


QUERIES = {
    "title_prefixes": title_prefixes,
    "phrase_counts": phrase_counts,
    "phrase_rank": phrase_rank,
    "phrase_weight_squared": phrase_weight_squared,
    "category_title": category_title,
    "category_summary": category_summary,
    "document_title_prefixes": document_title_prefixes,
    "document_phrase_counts": document_phrase_counts,
    "document_phrase_rank": document_phrase_rank,
    "document_category_summary": document_category_summary,
}

_PREFIXES = (
    "SELECT \"File\", {key} i AS pos, array_to_string(p[1:i + 1], ' ') AS phrase FROM ("
    "SELECT \"File\", {key} p, unnest(range(len(p))) AS i FROM (SELECT \"File\", {key} "
    "string_split(\"Title\", ' ') AS p FROM {source})) WHERE regexp_matches(p[i + 1], '[a-zA-Z'']')"
)


def define_phrases(rows: str, select: str, needs: tuple[str, ...], prefix: str = "") -> None:
    """Phrase tables over ``rows`` (File, Title, Top20Words, lang), named with ``prefix``."""
    c.define(rows, needs, select)
    c.define(
        f"{prefix}phrases", (rows,),
        'SELECT lang AS category, "File", 0 AS src, pos, phrase FROM (SELECT lang, "File", '
        "unnest(range(len(string_split(\"Top20Words\", ' ')))) AS pos, "
        f"unnest(string_split(\"Top20Words\", ' ')) AS phrase FROM {rows}) WHERE trim(phrase) <> '' "
        "UNION ALL SELECT lang, \"File\", 1, pos, phrase FROM ("
        + _PREFIXES.format(key="lang,", source=rows)
        + ") WHERE trim(phrase) <> ''",
    )
    c.define(
        f"{prefix}counted", (f"{prefix}phrases",),
        'SELECT category, phrase, cnt, "File" AS first_file, src AS first_src, pos AS first_pos FROM ('
        'SELECT *, count(*) OVER (PARTITION BY category, phrase) AS cnt, row_number() OVER '
        '(PARTITION BY category, phrase ORDER BY "File", src, pos) AS place '
        f"FROM {prefix}phrases) WHERE place = 1",
    )
    c.define(
        f"{prefix}weighted", (f"{prefix}counted",),
        "SELECT *, xor(CAST(len(string_split(phrase, ' ')) AS BIGINT), 2 * cnt) AS weight "
        f"FROM {prefix}counted",
    )
    c.define(
        f"{prefix}ranked_phrases", (f"{prefix}weighted",),
        "SELECT *, row_number() OVER (PARTITION BY category ORDER BY cnt DESC, weight DESC, "
        f"first_file, first_src, first_pos, phrase) AS rn FROM {prefix}weighted",
    )
    c.define(
        f"{prefix}titles", (f"{prefix}ranked_phrases",),
        "SELECT category, string_agg(phrase, ',' ORDER BY length(phrase) DESC, rn) AS title "
        f"FROM {prefix}ranked_phrases WHERE rn <= 10 GROUP BY category",
    )
    c.define(
        f"{prefix}summary", (f"{prefix}titles", rows),
        'SELECT *, row_number() OVER (ORDER BY category, ord, line, "File") AS position FROM ('
        "SELECT category, 0 AS ord, 'Category ' || category || ': ' || title AS line, '' AS \"File\" "
        f"FROM {prefix}titles UNION ALL SELECT lang, 1, chr(9) || \"Title\", \"File\" FROM {rows})",
    )


define_phrases(
    "categorised",
    'SELECT m.*, p.lang FROM page_model_input m JOIN page_docs p ON p."File" = m."File"',
    ("page_model_input", "page_docs"),
)
define_phrases(
    "categorised_documents",
    'SELECT m.*, t.lang FROM doc_model_input m JOIN texts t ON t."File" = m."File"',
    ("doc_model_input", "texts"), "doc_",
)

SQL = {
    "title_prefixes": c.with_tables(_PREFIXES.format(key="", source="page_docs"), "page_docs"),
    "phrase_counts": c.with_tables("SELECT * FROM counted", "counted"),
    "phrase_rank": c.with_tables("SELECT * FROM ranked_phrases", "ranked_phrases"),
    "phrase_weight_squared": c.with_tables(
        "SELECT category, phrase, n * n * cnt AS weight FROM "
        "(SELECT *, len(string_split(phrase, ' ')) AS n FROM counted)",
        "counted",
    ),
    "category_title": c.with_tables("SELECT * FROM titles", "titles"),
    "category_summary": c.with_tables("SELECT category, ord, line, position FROM summary", "summary"),
    "document_title_prefixes": c.with_tables(_PREFIXES.format(key="", source="docs"), "docs"),
    "document_phrase_counts": c.with_tables("SELECT * FROM doc_counted", "doc_counted"),
    "document_phrase_rank": c.with_tables("SELECT * FROM doc_ranked_phrases", "doc_ranked_phrases"),
    "document_category_summary": c.with_tables(
        "SELECT category, ord, line, position FROM doc_summary", "doc_summary"
    ),
}
