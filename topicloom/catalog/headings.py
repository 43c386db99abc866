"""Heading rules over the lines of documents and over pages."""

from pyspark.sql import functions as F

from ..functions.headings import title_trim
from ..functions.text import clean_value, is_blank
from ..operators import headings
from ..schemas import HEADINGS
from ..sources.markdown_files import file_key, file_level
from . import corpus as c


def _bigint(df, *names):
    return df.withColumns({name: F.col(name).cast("bigint") for name in names})


def title_trim_lines(spark, sf_dir):
    trimmed = c.lines(spark, sf_dir).select("File", "pos", title_trim("line").alias("title"))
    return _bigint(trimmed, "pos")


def heading_dedup(spark, sf_dir):
    return _bigint(headings.dedup_headings(c.heading_rows(spark, sf_dir)), "pos", "level")


def heading_rank(spark, sf_dir):
    ranked = headings.rank_headings(headings.dedup_headings(c.heading_rows(spark, sf_dir)))
    return _bigint(ranked, "pos", "level", "rn")


def heading_fill(spark, sf_dir):
    ranked = headings.rank_headings(headings.dedup_headings(c.heading_rows(spark, sf_dir)))
    return headings.fill_headings(ranked)


def heading_fill_arrays(spark, sf_dir):
    """The same result without a shuffle, from the array functions."""
    return c.docs(spark, sf_dir).drop("Words")


def page_headings(spark, sf_dir):
    """Title (level 0) and all headers (1 to 6) of the pages."""
    pages = c.table(spark, sf_dir, "pages", "page_id", "html")
    rows = pages.select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".md")).alias("File"),
        F.posexplode(c.page_heading_array()).alias("pos", "h"),
    ).select("File", "pos", "h.level", "h.text")
    ranked = headings.rank_headings(headings.dedup_headings(rows))
    return _bigint(ranked, "pos", "level", "rn")


def drop_untitled(spark, sf_dir):
    """Documents that keep a title before and after the final cleaning."""
    titled = c.docs(spark, sf_dir).filter(~is_blank("Title")).filter(~is_blank(clean_value("Title")))
    return titled.select("File", clean_value("Title").alias("Title"))


def file_keys(spark, sf_dir):
    """Key and depth of the paths of page addresses."""
    urls = c.table(spark, sf_dir, "pages", "page_id", "url")
    paths = urls.select("page_id", F.regexp_replace("url", r"^https?://[^/]+/", "").alias("path"))
    return paths.select(
        "page_id",
        file_key("path").alias("file_key"),
        file_level("path").cast("bigint").alias("level"),
    )


QUERIES = {
    "title_trim": title_trim_lines,
    "heading_dedup": heading_dedup,
    "heading_rank": heading_rank,
    "heading_fill": heading_fill,
    "heading_fill_arrays": heading_fill_arrays,
    "page_headings": page_headings,
    "drop_untitled": drop_untitled,
    "file_key": file_keys,
}

SQL = {
    "title_trim": c.with_tables(
        f'SELECT "File", pos, {c.sql_title_trim("line")} AS title FROM lines', "lines"
    ),
    "heading_dedup": c.with_tables("SELECT * FROM dedup", "dedup"),
    "heading_rank": c.with_tables("SELECT * FROM ranked_headings", "ranked_headings"),
    "heading_fill": c.with_tables("SELECT * FROM filled", "filled"),
    "heading_fill_arrays": c.with_tables(
        'SELECT t."File", ' + ", ".join(f'"{n}"' for n in HEADINGS)
        + ' FROM texts t LEFT JOIN filled f ON f."File" = t."File"',
        "texts", "filled",
    ),
    "page_headings": c.with_tables(
        'SELECT "File", pos, CAST(level AS BIGINT) AS level, "text", rn FROM page_ranked_headings',
        "page_ranked_headings",
    ),
    "drop_untitled": c.with_tables(
        f'SELECT "File", trim({c.sql_extract(chr(34) + "Title" + chr(34))}) AS "Title" FROM filled '
        f"WHERE \"Title\" IS NOT NULL AND trim({c.sql_extract(chr(34) + 'Title' + chr(34))}) <> ''",
        "filled",
    ),
    "file_key": (
        "SELECT page_id, replace(path, '/', '-') AS file_key, len(string_split(path, '/')) AS level "
        "FROM (SELECT page_id, regexp_replace(url, '^https?://[^/]+/', '') AS path FROM pages)"
    ),
}
