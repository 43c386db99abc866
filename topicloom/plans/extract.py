"""Step one: whole Markdown texts to documents with headings and words."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import markdown as md
from ..functions.headings import heading_slots, slot_columns, top_headings
from ..functions.text import clean_words, is_blank
from ..schemas import DOCS


def parse_markdown(files: DataFrame, content: str = "content") -> DataFrame:
    """Replace ``content`` by its headings and clean text; empty content is dropped.

    A row never leaves its task. Each step is used more than once by the next
    ones, so the optimizer keeps it as a projection of its own.
    """
    keep = [c for c in files.columns if c != content]
    text = files.filter(F.length(content) > 0).select(
        *keep, md.unix_lines(content).alias("_text")
    )
    parts = text.select(
        *keep,
        md.front_matter("_text").alias("_front"),
        md.drop_code_blocks(md.drop_front_matter("_text")).alias("_body"),
    )
    parts = parts.select(
        *keep,
        "_body",
        md.front_matter_value("_front", "title").alias("_title"),
        md.front_matter_value("_front", "description").alias("_description"),
    )
    return parts.select(
        *keep,
        md.headings("_title", "_description", "_body").alias("headings"),
        F.concat_ws(" ", "_title", "_description", md.plain_text("_body")).alias("plain"),
    )


def fill_documents(parsed: DataFrame) -> DataFrame:
    """Title, subtitles and words of parsed documents; those without a title go.

    They go by exploding an array of one or no element. A filter on the title
    would be pushed below the projections, and the optimizer would then repeat
    the whole parse inside its condition.
    """
    keep = [c for c in parsed.columns if c not in ("headings", "plain")]
    slots = parsed.select(
        *keep, "plain", heading_slots(top_headings("headings")).alias("_slots")
    )
    titled = ~is_blank("File") & ~is_blank(F.get("_slots", F.lit(0)))
    kept = slots.select(
        *keep, "plain", F.explode(F.when(titled, F.array("_slots"))).alias("_slots")
    )
    return kept.select(*keep, *slot_columns("_slots"), clean_words("plain").alias("Words"))


def extract_documents(files: DataFrame) -> DataFrame:
    """(File, content) to the *docs* table."""
    return fill_documents(parse_markdown(files)).select(*DOCS.names)
