r"""Markdown to headings and words with built-in regular expressions.

Every pattern is applied to one whole document inside its task, without a
shuffle and without Python. They are written to stay linear in the length of
the text: a class never crosses the character that must follow it, and repeated
groups are possessive, so that the regex engine loops over them instead of
recursing. ``(?d)`` makes ``\n`` the only line end.

Supported: front matter, both header styles, fenced and indented code, lists,
quotes, tables, inline code, inline and reference links, images, tooltips.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .headings import title_trim
from .text import _column, is_blank

FRONT_MATTER = r"(?dm)\A---[ \t]*\n((?s:.*?))^---[ \t]*(?:\n|\z)"

LIST_MARK = r"(?:[-*+]|[0-9]{1,9}[.)])"

_CONTAINER = rf"[ \t]*+(?:(?:>|{LIST_MARK}[ \t])[ \t]*+)*+"

# A fence may stand in quotes and list items, is of three marks or more, and is
# closed by a line of as many or more and nothing else.
FENCED_CODE = (
    rf"(?dm)^{_CONTAINER}(?:(`{{3,}}+)[^`\n]*+\n(?s:.*?)(?:^[ \t>]*+\1`*+[ \t]*+$|\z)"
    rf"|(~{{3,}}+)[^\n]*+\n(?s:.*?)(?:^[ \t>]*+\2~*+[ \t]*+$|\z))"
)

# An indented line is code after a blank line, unless a list item goes on there.
INDENTED_CODE = (
    rf"(?dm)(\A|^(?!{LIST_MARK}[ \t])[^ \t\n][^\n]*\n)"
    r"(?:(?<=\n)(?:[ \t]*\n)++|(?<!\n))(?=(?:[ ]{4}|\t)[ \t]*[^ \t\n])"
    r"(?:(?:[ ]{4}|\t)[^\n]*(?:\n|\z)|[ \t]*\n)++"
)

HEADER = (
    rf"(?dm)^{_CONTAINER}#[^\n]*$"
    rf"|^(?![ \t]*(?:$|[#>|]|{LIST_MARK}[ \t]))[^\n]+\n(?:=+|-+)[ \t]*$"
)

INLINE_CODE = r"``(?:[^`\n]++|`(?!`))*+``|`[^`\n]*`"

_LINK_TEXT = r"\[((?:[^\[\]\n]++|\n(?![ \t]*\n))*+)\]"
_URL = r'(?:[^()"\n]++|\([^()"\n]*\))*+'
# The tip is kept when it holds at least one non-letter.
_TIP = r"[a-zA-Z']*[^a-zA-Z'\"\n][^\"\n]*"

IMAGE_WITH_TIP = rf'!{_LINK_TEXT}\({_URL}"({_TIP})"[ \t]*\)'
IMAGE = rf'!{_LINK_TEXT}\({_URL}(?:"[^"\n]*"[ \t]*)?\)'
LINK_WITH_TIP = rf'{_LINK_TEXT}\({_URL}"({_TIP})"[ \t]*\)'
LINK = rf'{_LINK_TEXT}\({_URL}(?:"[^"\n]*"[ \t]*)?\)'
REFERENCE_LINK = rf"{_LINK_TEXT}\[[^\[\]\n]*\]"

_DEFINITION = r"(?dm)^ {0,3}\[[^\[\]\n]+\]:"
DEFINITION_WITH_TIP = rf'{_DEFINITION}[^\n"]*"({_TIP})"[^\n]*$'
DEFINITION = rf"{_DEFINITION}[^\n]*$"

BARE_URL = r"\b(?:https?|ftp)://[^\s<>\"]+"

# Inline parts that end a plain run of header text.
_MARKS = "|".join(
    [
        INLINE_CODE,
        "!?" + LINK,
        REFERENCE_LINK,
        BARE_URL,
        r"\*\*[^*\n]+\*\*",
        r"\*[^*\n]+\*",
        r"\b__[^_\n]+__\b",
        r"\b_[^_\n]+_\b",
        r"~~[^~\n]+~~",
    ]
)


def unix_lines(c) -> Column:
    """One kind of line end, and no byte order mark."""
    return F.regexp_replace(F.regexp_replace(_column(c), "\\A\ufeff", ""), "\r\n?", "\n")


def front_matter(c) -> Column:
    """The text between the opening pair of ``---`` lines, or ''."""
    return F.regexp_extract(_column(c), FRONT_MATTER, 1)


def front_matter_value(block, key) -> Column:
    """The first value of ``key``; keys ignore case and outer blanks."""
    return F.regexp_extract(
        _column(block), rf"(?dim)^[ \t]*{key}[ \t]*:[ \t]*([^\n]*)$", 1
    )


def drop_front_matter(c) -> Column:
    return F.regexp_replace(_column(c), FRONT_MATTER, "")


def drop_code_blocks(c) -> Column:
    """Remove fenced blocks, then indented ones."""
    fenced = F.regexp_replace(_column(c), FENCED_CODE, "\n")
    return F.regexp_replace(fenced, INDENTED_CODE, "$1\n")


def header_lines(c) -> Column:
    """Both header styles as an array, in document order."""
    return F.regexp_extract_all(_column(c), F.lit(HEADER), F.lit(0))


def header_level(line) -> Column:
    """1..6 for ``#`` headers; 1 and 2 for underlined ones."""
    line = _column(line)
    return (
        F.when(
            line.rlike(r"\n"),
            F.when(F.rtrim(line).endswith("="), 1).otherwise(2),
        )
        .otherwise(F.length(F.regexp_extract(line, r"\A[^#]*(#{1,6})", 1)))
        .cast("int")
    )


def header_text(line) -> Column:
    """First plain run of the header, cut at inline code, links and emphasis.

    A header that begins with such a part right away has its first run after
    it. Blank when there is none.
    """
    body = F.regexp_replace(
        _column(line), rf"\A{_CONTAINER}#{{1,6}}|\n(?:=++|-++)[ \t]*+\z|(?<!#)#++[ \t]*+\z", ""
    )
    runs = F.filter(
        F.split(F.regexp_replace(body, _MARKS, "\u0001"), "\u0001"), lambda run: run != ""
    )
    return F.coalesce(F.get(runs, F.lit(0)), F.lit(""))


def headings(block_title, block_description, body) -> Column:
    """Array of (level, text): front matter first, then the headers."""

    def entry(level, text):
        return F.struct(F.lit(level).cast("int").alias("level"), text.alias("text"))

    front = F.array(entry(0, _column(block_title)), entry(2, _column(block_description)))
    headers = F.transform(
        header_lines(body),
        lambda line: F.struct(header_level(line).alias("level"), header_text(line).alias("text")),
    )
    found = F.filter(F.concat(front, headers), lambda h: ~is_blank(h["text"]))
    return F.transform(
        found, lambda h: F.struct(h["level"].alias("level"), title_trim(h["text"]).alias("text"))
    )


def strip_inline_code(c) -> Column:
    return F.regexp_replace(_column(c), INLINE_CODE, " ")


def flatten_definitions(c) -> Column:
    """Keep the tip of a link definition if it has several words, drop the rest."""
    return F.regexp_replace(
        F.regexp_replace(_column(c), DEFINITION_WITH_TIP, " $1 "), DEFINITION, " "
    )


def flatten_links(c) -> Column:
    """Keep link text and tips of several words, drop addresses.

    Images go first, as a link may wrap one.
    """
    c = _column(c)
    for pattern, kept in (
        (IMAGE_WITH_TIP, " $2 $1 "),
        (IMAGE, " $1 "),
        (LINK_WITH_TIP, " $2 $1 "),
        (LINK, " $1 "),
        (REFERENCE_LINK, " $1 "),
    ):
        c = F.regexp_replace(c, pattern, kept)
    return c


def plain_text(body) -> Column:
    """Text of a body without code; marks of lists, quotes, tables and emphasis
    are no letters, so word extraction turns them into spaces."""
    return flatten_links(flatten_definitions(strip_inline_code(body)))
