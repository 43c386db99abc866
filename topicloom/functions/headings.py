"""From the headings of one document to its title and subtitles."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import HEADINGS
from .text import _column, trim_space

# Headings kept per document and the shortest one shown.
KEEP = 6
MIN_HEADING_LENGTH = 5


def title_trim(c) -> Column:
    """Drop what stands before the first ASCII letter, then trim."""
    c = _column(c)
    return trim_space(F.regexp_replace(c, r"\A[^A-Za-z]+(?=[A-Za-z])", ""))


def top_headings(headings) -> Column:
    """Rank the headings of a document and keep the first six.

    ``headings`` is an array of (level, text) in document order. A text keeps
    its deepest level, at that level's first place. The order is level, then
    longer texts, then place.

    Sorting by text brings equal texts together with the deepest one first, so
    a single fold that remembers the last text and six candidates is enough;
    no heading is compared with every other one.
    """
    keyed = F.transform(
        _column(headings),
        lambda h, i: F.struct(
            h["text"].alias("text"), (-h["level"]).alias("up"), i.alias("pos")
        ),
    )
    ranked = "struct<level:int,shortness:int,pos:int,text:string>"
    start = F.struct(
        F.lit(None).cast("string").alias("last"), F.array().cast(f"array<{ranked}>").alias("best")
    )

    def fold(acc, h):
        candidate = F.struct(
            (-h["up"]).cast("int").alias("level"),
            (-F.length(h["text"])).cast("int").alias("shortness"),
            h["pos"].cast("int").alias("pos"),
            h["text"].alias("text"),
        )
        best = F.slice(F.sort_array(F.concat(acc["best"], F.array(candidate))), 1, KEEP)
        return F.when(acc["last"].eqNullSafe(h["text"]), acc).otherwise(
            F.struct(h["text"].alias("last"), best.alias("best"))
        )

    return F.aggregate(
        F.sort_array(keyed),
        start,
        fold,
        lambda acc: F.transform(acc["best"], lambda h: h["text"]),
    )


def heading_slots(texts) -> Column:
    """Trim, remove double quotes and leave out what is too short."""
    shown = F.transform(_column(texts), lambda t: F.replace(trim_space(t), F.lit('"'), F.lit("")))
    return F.filter(shown, lambda t: F.length(t) >= MIN_HEADING_LENGTH)


def slot_columns(slots) -> list[Column]:
    """Title and Subtitle1..5 of an array made by :func:`heading_slots`."""
    slots = _column(slots)
    return [F.get(slots, F.lit(i)).alias(name) for i, name in enumerate(HEADINGS)]
