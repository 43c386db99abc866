"""Sources and sinks: write what Spark derives from the tables, read it back."""

import pandas as pd
from pyarrow import fs
from pyspark.sql import functions as F

from ..functions.text import clean_value, is_blank
from ..operators import summary
from ..operators.ranking import number_rows
from ..plans.rank import model_input
from ..schemas import DOCS
from ..session import materialize, work_dir
from ..sources import tables
from ..sources.layout import SessionLayout
from ..sources.markdown_files import file_listing, scan_markdown, with_file_key
from . import corpus as c
from .summaries import categorised_pages


#: How the names of the file queries start: plain ones and those other readers hide.
NAMES = ["doc ", "_doc", ".doc"]


def _layout(spark, name):
    return SessionLayout(work_dir(spark, name), 1)


def docs_round_trip(spark, sf_dir):
    """Quoted text files and back; an empty value comes back as null."""
    layout = _layout(spark, "docs")
    tables.write_docs(c.docs(spark, sf_dir), layout.docs, "csv")
    return tables.read_docs(spark, layout.docs, "csv")


def docs_parquet_round_trip(spark, sf_dir):
    layout = _layout(spark, "docs")
    tables.write_docs(c.docs(spark, sf_dir), layout.docs)
    return tables.read_docs(spark, layout.docs)


def model_input_round_trip(spark, sf_dir):
    layout = _layout(spark, "model")
    rows = model_input(c.page_docs(spark, sf_dir).drop("lang")).orderBy("File")
    tables.write_model_input(rows, layout.model_input, "csv")
    return tables.read_model_input(spark, layout.model_input, "csv")


def categorized_round_trip(spark, sf_dir):
    """The quality label stands for a category."""
    layout = _layout(spark, "labelled")
    labels = c.table(spark, sf_dir, "labels", "doc_id", "quality").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".md")).alias("File"),
        (F.col("quality") + 1).cast("int").alias("PredictedLabel"),
    )
    rows = model_input(c.stored_docs(spark, sf_dir)).join(labels, "File")
    tables.write_categorized(rows, layout.categorized, "csv")
    back = tables.read_categorized(spark, layout.categorized, "csv")
    return back.withColumn("PredictedLabel", F.col("PredictedLabel").cast("bigint"))


def shared_sessions(spark, sf_dir):
    """Two sessions in one table, then three; the first is run again and replaces only its own part."""
    docs = c.stored_docs(spark, sf_dir)
    layouts = [SessionLayout(work_dir(spark, "sessions"), 1, partitioned=True)]
    layouts.append(SessionLayout(layouts[0].base, 2, partitioned=True))
    for layout in layouts:
        tables.write_docs(docs.withColumn("Title", F.concat(F.lit("first run: "), F.col("Title"))), layout.docs)
    tables.write_docs(docs.filter("length(Words) % 2 = 0"), layouts[0].docs)
    table = layouts[0].table("docs")
    more = docs.withColumn("session", F.when(F.length("Words") % 2 == 0, 3).otherwise(4))
    tables.write_sessions(more, table, DOCS)
    kept = tables.read_sessions(spark, table, DOCS, [1, 2, 4])
    return kept.select("session", "File", "Title", F.md5(F.encode("Words", "UTF-8")).alias("digest"))


def raw_lines_round_trip(spark, sf_dir):
    """Raw texts in every column of the text files: quotes, commas, back-slashes, line breaks."""
    layout = _layout(spark, "raw")
    odd = F.concat(F.lit('say "'), F.substring("text", 1, 40), F.lit('",\\ '))
    raw = c.texts(spark, sf_dir).select(
        "File", F.col("text").alias("Title"), odd.alias("Subtitle1"), F.lit("\\").alias("Subtitle2"),
        F.lit('"').alias("Subtitle3"), F.lit("a,b\r\nc").alias("Subtitle4"),
        F.substring("text", -30, 30).alias("Subtitle5"), F.col("text").alias("Words"),
    )
    tables.write_docs(raw, layout.docs, "csv")
    back = tables.read_docs(spark, layout.docs, "csv")
    return back.select("File", *(F.md5(F.encode(n, "UTF-8")).alias(n) for n in [*c.HEADINGS, "Words"]))


def summary_text(spark, sf_dir):
    layout = _layout(spark, "summary")
    lines = summary.summary_lines(categorised_pages(spark, sf_dir), "lang")
    tables.write_summary(lines, layout.summary)
    written = tables.read_summary(spark, layout.summary)
    # The place of a line: its file, in name order, and its offset there, as one task reads a part.
    found = written.select("line", F.col("_metadata.file_name").alias("part"),
                           F.col("_metadata.file_block_start").alias("block"),
                           F.monotonically_increasing_id().alias("at"))
    return number_rows(found, [], ["part", "block", "at"], "position").select("line", "position")


def _write_files(rows, root):
    """Put (path, text) rows into files below ``root``, from the tasks."""

    def write(batches):
        for batch in batches:
            system, base = fs.FileSystem.from_uri(root)
            for path, text in zip(batch["path"], batch["text"]):
                target = f"{base}/{path}"
                system.create_dir(target.rpartition("/")[0])
                with system.open_output_stream(target) as out:
                    out.write(text.encode("utf-8"))
            yield pd.DataFrame({"n": [len(batch)]})

    rows.mapInPandas(write, "n bigint").agg(F.sum("n")).collect()


def _files(spark, sf_dir, names):
    """Documents as files whose names and folders start in the given ways, in turn."""
    root = work_dir(spark, "files")
    start = F.get(F.array(*map(F.lit, names)), F.pmod("doc_id", F.lit(len(names))).cast("int"))
    rows = c.table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").select(
        F.concat(F.lit("_"), "lang", F.lit("/"), "source", F.lit("/"), start,
                 F.col("doc_id").cast("string"), F.lit(".md")).alias("path"),
        "text",
    )
    _write_files(rows, root if "://" in root else root.removeprefix("file:"))
    return root


def file_scan(spark, sf_dir):
    """Every document as a file, whatever its name: listing, key and content."""
    root = _files(spark, sf_dir, NAMES)
    files = with_file_key(scan_markdown(spark, root), root)
    # Read once, and stored without the contents.
    files = materialize(files.select(
        "path", "File", F.length("content").cast("bigint").alias("n_chars"),
        F.md5(F.encode("content", "UTF-8")).alias("digest"),
    ), "scanned")
    listing = file_listing(files, root).withColumnRenamed("file", "path")
    placed = number_rows(listing, [], [F.col("level"), F.col("path"), F.col("fileName")], "position")
    # Sizes of stored tables are those of packed paths: by these the driver would get a side with a row per file.
    return files.join(placed.hint("merge"), "path").select(
        F.col("level").cast("bigint").alias("level"), "position", "fileName", "File", "n_chars", "digest",
    )


def hidden_file_scan(spark, sf_dir):
    """Files whose names start with an underscore, which the native reader skips."""
    root = _files(spark, sf_dir, ["_doc"])
    files = with_file_key(scan_markdown(spark, root), root)
    return files.select("File", F.md5(F.encode("content", "UTF-8")).alias("digest"))


def blank_title_rows(spark, sf_dir):
    """Rows the final step leaves out for want of a letter in the title."""
    docs = c.docs(spark, sf_dir).filter(is_blank(clean_value("Title")))
    return docs.select("File")


QUERIES = {
    "docs_round_trip": docs_round_trip,
    "docs_parquet_round_trip": docs_parquet_round_trip,
    "model_input_round_trip": model_input_round_trip,
    "categorized_round_trip": categorized_round_trip,
    "raw_lines_round_trip": raw_lines_round_trip,
    "shared_sessions": shared_sessions,
    "summary_text": summary_text,
    "file_scan": file_scan,
    "hidden_file_scan": hidden_file_scan,
    "blank_title_rows": blank_title_rows,
}

_COLUMNS = [*c.ATTRIBUTES, "Words"]
SQL = {
    "docs_round_trip": c.with_tables(
        "SELECT " + ", ".join(f"nullif(\"{n}\", '') AS \"{n}\"" for n in _COLUMNS) + " FROM docs", "docs"
    ),
    "docs_parquet_round_trip": c.with_tables("SELECT * FROM docs", "docs"),
    "model_input_round_trip": c.with_tables("SELECT * FROM page_model_input", "page_model_input"),
    "categorized_round_trip": c.with_tables(
        "SELECT " + ", ".join(f"nullif(m.\"{n}\", '') AS \"{n}\"" for n in c.ATTRIBUTES)
        + ', "WordCount", "ReadingTime", "Top20Words", '
        'CAST(quality + 1 AS BIGINT) AS "PredictedLabel" FROM doc_model_input m '
        "JOIN labels l ON m.\"File\" = 'doc-' || l.doc_id || '.md'",
        "doc_model_input",
    ),
    "raw_lines_round_trip": c.with_tables(
        "SELECT \"File\", " + ", ".join(
            f"md5(regexp_replace({text}, '\\r\\n?|\\n', ' ', 'g')) AS \"{name}\""
            for name, text in [
                ("Title", "text"), ("Subtitle1", "'say \"' || substr(text, 1, 40) || '\",\\ '"), ("Subtitle2", "'\\'"),
                ("Subtitle3", "'\"'"), ("Subtitle4", "'a,b' || chr(13) || chr(10) || 'c'"),
                ("Subtitle5", "right(text, 30)"), ("Words", "text"),
            ]
        ) + " FROM texts",
        "texts",
    ),
    "shared_sessions": c.with_tables(
        "SELECT s AS session, \"File\", CASE WHEN s = 2 THEN 'first run: ' || \"Title\" ELSE \"Title\" END AS \"Title\", "
        "md5(\"Words\") AS digest FROM docs, (SELECT unnest([1, 2, 4]) AS s) "
        "WHERE s = 2 OR (s = 1) = (length(\"Words\") % 2 = 0)",
        "docs",
    ),
    "summary_text": c.with_tables(
        "SELECT line, position FROM summary", "summary",
    ),
    "file_scan": (
        "SELECT 3 AS level, row_number() OVER (ORDER BY p) AS position, replace(p, '/', '-') AS \"fileName\", "
        "replace(p, '/', '-') AS \"File\", length(\"text\") AS n_chars, md5(\"text\") AS digest FROM ("
        f"SELECT *, '_' || lang || '/' || \"source\" || '/' || {NAMES!r}[doc_id % {len(NAMES)} + 1] "
        "|| doc_id || '.md' AS p FROM documents)"
    ),
    "hidden_file_scan": (
        "SELECT '_' || lang || '-' || \"source\" || '-_doc' || doc_id || '.md' AS \"File\", "
        "md5(\"text\") AS digest FROM documents"
    ),
    "blank_title_rows": c.with_tables(
        f"SELECT \"File\" FROM docs WHERE coalesce(trim({c.sql_extract(chr(34) + 'Title' + chr(34))}), '') = ''",
        "docs",
    ),
}
