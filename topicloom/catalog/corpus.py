"""Corpora derived from the test tables, in both languages.

Each Spark function has an SQL text of the same meaning as a named table
expression; :func:`with_tables` puts those together.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headings import heading_slots, slot_columns, title_trim, top_headings
from ..functions.text import clean_words, is_blank
from ..schemas import ATTRIBUTES, HEADINGS
from ..session import materialize, spread_input


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spread_input(spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns))


# --- SQL of the scalar rules ------------------------------------------------

SPACE = r"[\s\x0B\x{85}\p{Z}]"
NOT_SPACE = r"[^\s\x0B\x{85}\p{Z}]"


def sql_blank(x):
    return f"(NOT coalesce(regexp_matches({x}, '{NOT_SPACE}'), false))"


def sql_trim(x):
    return rf"regexp_replace(regexp_replace({x}, '\A{SPACE}+', ''), '{SPACE}+\z', '')"


def sql_extract(x):
    return (
        f"CASE WHEN {sql_blank(x)} THEN '' "
        f"ELSE ' ' || regexp_replace({x}, '[^a-zA-Z'']', ' ', 'g') END"
    )


def sql_normalize(x):
    return sql_trim(rf"regexp_replace({x}, '({SPACE}){SPACE}*', '\1', 'g')")


def sql_drop_camel(x):
    return (
        f"array_to_string(list_filter(string_split({x}, ' '), "
        "lambda w: length(regexp_replace(w, '[^A-Z]', '', 'g')) <= 1), ' ')"
    )


def sql_clean(x):
    return sql_drop_camel(sql_normalize(f"({sql_extract(x)})"))


def sql_clean_value(x):
    return f"CASE WHEN {x} IS NOT NULL THEN trim({sql_extract(x)}) END"


def sql_title_trim(x):
    return sql_trim(
        rf"CASE WHEN regexp_matches({x}, '[A-Za-z]') "
        rf"THEN regexp_replace({x}, '\A[^A-Za-z]+', '') ELSE {x} END"
    )


def sql_capitals(x):
    return f"length(regexp_replace({x}, '[^A-Z]', '', 'g'))"


# --- named table expressions ------------------------------------------------

_TABLES: dict[str, tuple[tuple[str, ...], str]] = {}


def define(name: str, needs: tuple[str, ...], text: str) -> None:
    _TABLES[name] = (needs, text)


def with_tables(select: str, *names: str) -> str:
    """``WITH`` the named expressions and all they need, then ``select``."""
    ordered: list[str] = []

    def visit(name):
        if name not in ordered:
            for need in _TABLES[name][0]:
                visit(need)
            ordered.append(name)

    for name in names:
        visit(name)
    parts = ",\n".join(f"{name} AS ({_TABLES[name][1]})" for name in ordered)
    return f"WITH {parts}\n{select}"


# --- documents --------------------------------------------------------------


def texts(spark, sf_dir) -> DataFrame:
    """documents as (File, text, lang)."""
    return table(spark, sf_dir, "documents", "doc_id", "text", "lang").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".md")).alias("File"),
        "text",
        "lang",
    )


define(
    "texts", (),
    "SELECT 'doc-' || doc_id || '.md' AS \"File\", \"text\", lang FROM documents",
)


def lines(spark, sf_dir) -> DataFrame:
    """Lines of the documents as (File, pos, line)."""
    return texts(spark, sf_dir).select(
        "File", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )


define(
    "lines", ("texts",),
    'SELECT "File", unnest(range(len(l))) AS pos, unnest(l) AS line '
    'FROM (SELECT "File", string_split("text", chr(10)) AS l FROM texts)',
)


def heading_rows(spark, sf_dir) -> DataFrame:
    """Lines as headings of level 0 to 3: (File, pos, level, text)."""
    return lines(spark, sf_dir).filter(~is_blank("line")).select(
        "File", "pos", (F.col("pos") % 4).alias("level"), title_trim("line").alias("text")
    )


define(
    "heading_rows", ("lines",),
    f'SELECT "File", pos, pos % 4 AS level, {sql_title_trim("line")} AS "text" '
    f"FROM lines WHERE NOT {sql_blank('line')}",
)


def define_headings(rows: str, prefix: str = "") -> None:
    """Deduplicated, ranked and filled headings over ``rows``, named with ``prefix``."""
    define(
        f"{prefix}dedup", (rows,),
        'SELECT "File", min(pos) AS pos, level, "text" FROM ('
        f'SELECT *, max(level) OVER (PARTITION BY "File", "text") AS deepest FROM {rows}) '
        'WHERE level = deepest GROUP BY "File", level, "text"',
    )
    define(
        f"{prefix}ranked_headings", (f"{prefix}dedup",),
        'SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "File" '
        f'ORDER BY level, length("text") DESC, pos) AS rn FROM {prefix}dedup) WHERE rn <= 6',
    )
    define(
        f"{prefix}slots", (f"{prefix}ranked_headings",),
        'SELECT "File", shown, row_number() OVER (PARTITION BY "File" ORDER BY rn) AS slot FROM ('
        f"SELECT \"File\", rn, replace({sql_trim('text')}, '\"', '') AS shown FROM {prefix}ranked_headings) "
        "WHERE length(shown) >= 5",
    )
    define(
        f"{prefix}filled", (f"{prefix}slots", f"{prefix}ranked_headings"),
        'SELECT r."File", '
        + ", ".join(
            f'max(CASE WHEN slot = {i + 1} THEN shown END) AS "{name}"' for i, name in enumerate(HEADINGS)
        )
        + f' FROM (SELECT DISTINCT "File" FROM {prefix}ranked_headings) r '
        f'LEFT JOIN {prefix}slots s ON s."File" = r."File" GROUP BY r."File"',
    )


define_headings("heading_rows")


def docs(spark, sf_dir) -> DataFrame:
    """documents in the form of the *docs* table; the title comes from the lines."""
    numbered = F.transform(
        F.split("text", "\n"),
        lambda line, pos: F.struct((pos % 4).alias("level"), line.alias("line")),
    )
    found = F.transform(
        F.filter(numbered, lambda h: ~is_blank(h["line"])),
        lambda h: F.struct(h["level"].alias("level"), title_trim(h["line"]).alias("text")),
    )
    slots = texts(spark, sf_dir).select(
        "File", heading_slots(top_headings(found)).alias("_slots"), clean_words("text").alias("Words")
    )
    return slots.select("File", *slot_columns("_slots"), "Words")


define(
    "docs", ("texts", "filled"),
    'SELECT t."File", '
    + ", ".join(f'f."{name}"' for name in HEADINGS)
    + f", {sql_clean('t.text')} AS \"Words\" "
    'FROM texts t LEFT JOIN filled f ON f."File" = t."File"',
)


def stored_docs(spark, sf_dir) -> DataFrame:
    """:func:`docs` as the extraction step leaves it: a stored table."""
    return spread_input(materialize(docs(spark, sf_dir), "docs"))


def plain_docs(spark, sf_dir) -> DataFrame:
    """documents as (File, Words)."""
    return texts(spark, sf_dir).select("File", clean_words("text").alias("Words"))


define("plain_docs", ("texts",), f'SELECT "File", {sql_clean("text")} AS "Words" FROM texts')

# --- pages ------------------------------------------------------------------


#: The title (level 0) and the headers of a page; in text order, the title first.
_TITLE = "(?is)<(title)(?: [^>]*)?>([^<]*)</"
_HEADERS = "(?is)<h([1-6])(?: [^>]*)?>([^<]*)</"


def page_heading_array(html="html"):
    """Array of (level, text) of a page, texts trimmed, blank ones left out."""

    def found(pattern):
        tags = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
        texts = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
        return F.arrays_zip(tags.alias("tag"), texts.alias("text"))

    both = F.concat(found(_TITLE), found(_HEADERS))
    levelled = F.transform(
        both,
        lambda h: F.struct(
            F.when(h["tag"].rlike("^[1-6]$"), h["tag"].cast("int")).otherwise(0).alias("level"),
            title_trim(h["text"]).alias("text"),
        ),
    )
    return F.filter(levelled, lambda h: ~is_blank(h["text"]))


def page_docs(spark, sf_dir) -> DataFrame:
    """pages in the form of the *docs* table, plus the page language."""
    pages = table(spark, sf_dir, "pages", "page_id", "html").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".md")).alias("File"),
        heading_slots(top_headings(page_heading_array())).alias("_slots"),
        clean_words(F.regexp_replace("html", "<[^>]*>", " ")).alias("Words"),
        F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("lang"),
    )
    return pages.select("File", *slot_columns("_slots"), "Words", "lang")


define(
    "page_tags", (),
    'SELECT "File", unnest(range(len(found))) AS i, unnest(found) AS h FROM ('
    "SELECT 'page-' || page_id || '.md' AS \"File\", list_concat("
    f"list_zip(list_transform(regexp_extract_all(html, '{_TITLE}', 1), lambda x: 0), regexp_extract_all(html, '{_TITLE}', 2)), "
    f"list_zip(list_transform(regexp_extract_all(html, '{_HEADERS}', 1), lambda x: x::INTEGER), "
    f"regexp_extract_all(html, '{_HEADERS}', 2))) AS found FROM pages)",
)
define(
    "page_heading_rows", ("page_tags",),
    'SELECT "File", row_number() OVER (PARTITION BY "File" ORDER BY i) - 1 AS pos, level, "text" FROM ('
    f"SELECT \"File\", i, h[1] AS level, {sql_title_trim('h[2]')} AS \"text\" FROM page_tags "
    f"WHERE NOT {sql_blank('h[2]')})",
)
define_headings("page_heading_rows", "page_")
define(
    "page_docs", ("page_filled",),
    "SELECT p.\"File\", " + ", ".join(f'f."{name}"' for name in HEADINGS)
    + f", {sql_clean(chr(40) + 'regexp_replace(html, ' + chr(39) + '<[^>]*>' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')' + chr(41))} AS \"Words\", "
    "regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang "
    "FROM (SELECT *, 'page-' || page_id || '.md' AS \"File\" FROM pages) p "
    'LEFT JOIN page_filled f ON f."File" = p."File"',
)


# --- term statistics over any docs expression -------------------------------


def define_terms(docs_name: str, prefix: str) -> None:
    """Term tables over the expression ``docs_name``, named with ``prefix``."""
    stop = "(length(word) < 4 OR word IN (" + _stop_list() + "))"
    define(
        f"{prefix}tf", (docs_name,),
        f'SELECT "File", word, count(*) AS "count" FROM (SELECT "File", '
        f"unnest(string_split(lower(\"Words\"), ' ')) AS word FROM {docs_name} "
        "WHERE \"Words\" <> '') GROUP BY ALL",
    )
    define(
        f"{prefix}df", (f"{prefix}tf", docs_name),
        f'SELECT word, "docFrequency", total, ln(total + 1) / ("docFrequency" + 1) AS "inverseDocFrequency" '
        f'FROM (SELECT word, count(DISTINCT "File") AS "docFrequency", '
        f"(SELECT count(*) FROM {docs_name}) AS total FROM {prefix}tf GROUP BY word)",
    )
    define(
        f"{prefix}scores", (f"{prefix}tf", f"{prefix}df"),
        f'SELECT t."File", t.word, d."docFrequency", d."inverseDocFrequency", t."count", '
        f'd."inverseDocFrequency" * t."count" AS "termFreq_inverseDocFreq" '
        f"FROM {prefix}df d JOIN {prefix}tf t ON t.word = d.word",
    )
    define(
        f"{prefix}filtered", (f"{prefix}scores",),
        f'SELECT "File", word, "termFreq_inverseDocFreq" FROM {prefix}scores WHERE NOT {stop}',
    )
    define(
        f"{prefix}top", (f"{prefix}filtered",),
        f'SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "File" ORDER BY '
        f'"termFreq_inverseDocFreq" DESC, word) AS "RowNumber" FROM {prefix}filtered) '
        'WHERE "RowNumber" <= 20',
    )
    define(
        f"{prefix}rollup", (f"{prefix}tf",),
        f'SELECT "File", CAST(sum("count") AS BIGINT) AS "WordCount" FROM {prefix}tf GROUP BY "File"',
    )
    heads = ", ".join(f"{sql_clean_value('d.' + chr(34) + n + chr(34))} AS \"{n}\"" for n in HEADINGS)
    attrs = ", ".join(f'"{n}"' for n in ATTRIBUTES)
    title = 'd."Title"'
    define(
        f"{prefix}model_input", (docs_name, f"{prefix}top", f"{prefix}rollup"),
        f'SELECT d."File", {heads}, trim(w.words) AS "Top20Words", r."WordCount", '
        f"{sql_reading_time('r.' + chr(34) + 'WordCount' + chr(34))} AS \"ReadingTime\" "
        f"FROM (SELECT DISTINCT {attrs} FROM {docs_name}) d "
        f"JOIN (SELECT \"File\", ' ' || string_agg(word, ' ' ORDER BY \"RowNumber\") AS words "
        f'FROM {prefix}top GROUP BY "File") w ON w."File" = d."File" '
        f'JOIN {prefix}rollup r ON r."File" = d."File" '
        f"WHERE {title} IS NOT NULL AND trim({sql_extract(title)}) <> ''",
    )


def _stop_list():
    from ..functions.stopwords import STOP_WORDS

    return ", ".join(f"'{word}'" for word in STOP_WORDS)


def sql_stop(word):
    return f"(length({word}) < 4 OR {word} IN ({_stop_list()}))"


def sql_reading_time(words):
    m = f"({words} / 225.0::DOUBLE)"
    hours = f"CAST(CAST(floor({m} / 60) AS BIGINT) AS VARCHAR) || ' hours'"
    return (
        f"CASE WHEN {m} <= 1 THEN '< 1 minute' "
        f"WHEN {m} < 60 THEN CAST(CAST(floor({m}) AS BIGINT) AS VARCHAR) || ' minutes' "
        f"WHEN {m} % 60 < 1 THEN {hours} "
        f"ELSE {hours} || ' and ' || CAST(CAST(floor({m} % 60) AS BIGINT) AS VARCHAR) || ' minutes' END"
    )


define_terms("plain_docs", "")
define_terms("docs", "doc_")
define_terms("page_docs", "page_")
