"""Markdown rules over documents turned into Markdown.

The test tables hold no Markdown. Every line of a document with a letter becomes
one block; the kind of block follows from the position of the line. Characters
that would open a block or an inline part of their own are blanked, as they have no
escaped form here; all others stay. The checks know what each kind of block must
give and use no Markdown pattern at all.
"""

from pyspark.sql import functions as F

from ..functions import markdown as md
from ..functions.headings import title_trim
from ..functions.text import clean_words
from ..plans.extract import extract_documents, parse_markdown
from . import corpus as c

# Kind: parts of the Spark block, and SQL of the words it must give.
_TIP = "CASE WHEN regexp_matches(l, '[^a-zA-Z'']') THEN l || ' ' ELSE '' END || l"
KINDS = {
    "hash": (["# ", "L"], "l"),
    "paragraph": (["L"], "l"),
    "quote": (["> ", "L"], "l"),
    "fence": (["```\n", "L", "\n```"], "''"),
    "item": (["- ", "L"], "l"),
    "table": (["| ", "L", " | ", "L", " |"], "l || ' ' || l"),
    "link": (["[", "L", '](http://x.example/p "', "L", '")'], _TIP),
    "underline": (["L", "\n---"], "l"),
    "indent": (["    ", "L"], "''"),
    "inline": (["`", "L", "` and **", "L", "**"], "'and ' || l"),
    "image": (["![", "L", "](p.png)"], "l"),
    "bare": (["L", " http://x.example/p"], "l || ' http x example p'"),
    "definition": (["[ref]: http://x.example/p \"", "L", '"'], "CASE WHEN regexp_matches(l, '[^a-zA-Z'']') THEN l ELSE '' END"),
    "reference": (["[", "L", "][ref]"], "l"),
}
LEVELS = {"hash": 1, "underline": 2}

# Marks of inline parts, control characters and odd spaces, and the sign of an address.
BLANKED = r'[`\[\]()<>\\"~_*#\x00-\x09\x0B-\x1F\x7F-\x9F\p{Z}]|://'

# The characters of BLANKED one by one: the regex engine looks them up in one table and takes a call for each range otherwise.
_CONTROLS = "".join(rf"\x{i:02X}" for i in (*range(0x0A), *range(0x0B, 0x20), *range(0x7F, 0xA0)))
_BLANKED_CHARACTERS = rf'[`\[\]()<>\\"~_*#{_CONTROLS}\p{{Z}}]'

ALL = list(KINDS)
CODE = ["paragraph", "fence", "indent", "inline"]
LINKS = ["paragraph", "link", "image", "bare", "definition", "reference"]
CONTAINERS = ["quote", "table", "item", "paragraph"]


def lines(spark, sf_dir):
    """(File, ls): the usable lines of each document, in order."""
    allowed = F.regexp_replace(F.replace("text", F.lit("://"), F.lit(" ")), _BLANKED_CHARACTERS, " ")
    usable = F.filter(F.split(allowed, "\n"), lambda line: line.rlike("[A-Za-z]"))
    ready = F.transform(usable, title_trim)
    found = c.texts(spark, sf_dir).select("File", ready.alias("ls"))
    # Exploded, not filtered: a filter on the lines would make them twice.
    return found.select("File", F.explode(F.when(F.size("ls") > 0, F.array("ls"))).alias("ls"))


def markdown(spark, sf_dir, kinds, front=False):
    """(File, content) with one block per line."""

    def block(line, pos):
        expr = None
        for i, kind in enumerate(kinds):
            parts = [line if p == "L" else F.lit(p) for p in KINDS[kind][0]]
            hit = pos % len(kinds) == i
            expr = F.when(hit, F.concat(*parts)) if expr is None else expr.when(hit, F.concat(*parts))
        return expr

    content = F.array_join(F.transform("ls", block), "\n\n")
    if front:
        content = F.concat(
            F.lit("---\nauthor: nobody\nTitle : "), F.get("ls", F.lit(0)),
            F.lit("\ndescription: "), F.element_at("ls", -1), F.lit("\n---\n"), content,
        )
    return lines(spark, sf_dir).select("File", content.alias("content"))


def _words(spark, sf_dir, kinds):
    parsed = parse_markdown(markdown(spark, sf_dir, kinds))
    return parsed.select("File", clean_words("plain").alias("Words"))


def front_matter(spark, sf_dir):
    files = markdown(spark, sf_dir, ALL, front=True)
    block = files.select("File", md.front_matter("content").alias("block"))
    return block.select(
        "File",
        md.front_matter_value("block", "title").alias("title"),
        md.front_matter_value("block", "description").alias("description"),
    )


def header_extract(spark, sf_dir):
    parsed = parse_markdown(markdown(spark, sf_dir, ALL, front=True))
    found = F.coalesce("headings", F.array())
    rows = parsed.select("File", F.posexplode(found).alias("pos", "h"))
    return rows.select(
        "File", F.col("pos").cast("bigint").alias("pos"),
        F.col("h.level").cast("bigint").alias("level"), F.col("h.text").alias("text"),
    )


def code_strip(spark, sf_dir):
    return _words(spark, sf_dir, CODE)


def link_text(spark, sf_dir):
    return _words(spark, sf_dir, LINKS)


def table_quote_list_words(spark, sf_dir):
    return _words(spark, sf_dir, CONTAINERS)


def markdown_words(spark, sf_dir):
    return _words(spark, sf_dir, ALL)


def extracted_docs(spark, sf_dir):
    """All rules together: the *docs* table of the Markdown corpus."""
    return extract_documents(markdown(spark, sf_dir, ALL, front=True))


QUERIES = {
    "front_matter": front_matter,
    "header_extract": header_extract,
    "code_strip": code_strip,
    "link_text": link_text,
    "table_quote_list_words": table_quote_list_words,
    "markdown_words": markdown_words,
    "extracted_docs": extracted_docs,
}

_ALLOWED = f"regexp_replace(line, '{BLANKED}', ' ', 'g')"
c.define(
    "md_lines", ("lines",),
    'SELECT "File", row_number() OVER (PARTITION BY "File" ORDER BY pos) - 1 AS pos, l, '
    'count(*) OVER (PARTITION BY "File") AS n '
    f'FROM (SELECT "File", pos, {c.sql_title_trim("(" + _ALLOWED + ")")} AS l FROM lines) '
    "WHERE regexp_matches(l, '[A-Za-z]')",
)
c.define(
    "md_front", ("md_lines",),
    'SELECT a."File", a.l AS title, b.l AS description FROM md_lines a '
    'JOIN md_lines b ON a."File" = b."File" WHERE a.pos = 0 AND b.pos = b.n - 1',
)


def _sql_words(kinds):
    words = " ".join(
        f"WHEN pos % {len(kinds)} = {i} THEN {KINDS[kind][1]}" for i, kind in enumerate(kinds)
    )
    return (
        f"SELECT \"File\", string_agg(CASE {words} END, ' ' ORDER BY pos) AS plain "
        'FROM md_lines GROUP BY "File"'
    )


def _sql_clean_words(kinds):
    return c.with_tables(
        f'SELECT "File", {c.sql_clean("plain")} AS "Words" FROM ({_sql_words(kinds)})', "md_lines"
    )


_HEADS = " OR ".join(f"pos % {len(ALL)} = {ALL.index(k)}" for k in LEVELS)
_LEVEL = " ".join(f"WHEN pos % {len(ALL)} = {ALL.index(k)} THEN {v}" for k, v in LEVELS.items())
c.define(
    "md_headings", ("md_lines", "md_front"),
    'SELECT "File", row_number() OVER (PARTITION BY "File" ORDER BY place) - 1 AS pos, level, "text" FROM ('
    'SELECT "File", -2 AS place, 0 AS level, title AS "text" FROM md_front UNION ALL '
    'SELECT "File", -1, 2, description FROM md_front UNION ALL '
    f'SELECT "File", pos, CASE {_LEVEL} END, l FROM md_lines WHERE {_HEADS})',
)
c.define(
    "md_dedup", ("md_headings",),
    'SELECT "File", min(pos) AS pos, level, "text" FROM (SELECT *, max(level) OVER '
    '(PARTITION BY "File", "text") AS deepest FROM md_headings) WHERE level = deepest '
    'GROUP BY "File", level, "text"',
)
c.define(
    "md_slots", ("md_dedup",),
    'SELECT "File", "text", row_number() OVER (PARTITION BY "File" ORDER BY rn) AS slot FROM ('
    'SELECT *, row_number() OVER (PARTITION BY "File" ORDER BY level, length("text") DESC, pos) AS rn '
    'FROM md_dedup) WHERE rn <= 6 AND length("text") >= 5',
)

SQL = {
    "front_matter": c.with_tables("SELECT * FROM md_front", "md_front"),
    "header_extract": c.with_tables("SELECT * FROM md_headings", "md_headings"),
    "code_strip": _sql_clean_words(CODE),
    "link_text": _sql_clean_words(LINKS),
    "table_quote_list_words": _sql_clean_words(CONTAINERS),
    "markdown_words": _sql_clean_words(ALL),
    "extracted_docs": c.with_tables(
        'SELECT w."File", s.* EXCLUDE ("File"), '
        f"{c.sql_clean('(f.title || chr(32) || f.description || chr(32) || w.plain)')} AS \"Words\" "
        f'FROM ({_sql_words(ALL)}) w JOIN md_front f ON f."File" = w."File" JOIN (SELECT "File", '
        + ", ".join(f'max(CASE WHEN slot = {i + 1} THEN "text" END) AS "{n}"' for i, n in enumerate(c.HEADINGS))
        + ' FROM md_slots GROUP BY "File") s ON s."File" = w."File"',
        "md_front", "md_slots",
    ),
}
