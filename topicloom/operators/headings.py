"""Heading rules over rows of (File, pos, level, text).

The same rules as the array functions, for headings that already are a table.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.headings import KEEP, heading_slots, slot_columns


def dedup_headings(rows: DataFrame) -> DataFrame:
    """Per document and text keep the deepest level and its first place there."""
    deepest = F.min(F.struct((-F.col("level")).alias("up"), "pos"))
    return (
        rows.groupBy("File", "text")
        .agg(deepest.alias("first"))
        .select("File", F.col("first.pos").alias("pos"), (-F.col("first.up")).alias("level"), "text")
    )


def rank_headings(rows: DataFrame, keep: int = KEEP) -> DataFrame:
    """Order by level, longer texts, place; keep the first six."""
    order = Window.partitionBy("File").orderBy("level", F.desc(F.length("text")), "pos")
    return rows.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= keep)


def fill_headings(ranked: DataFrame) -> DataFrame:
    """Fill Title and Subtitle1..5 from the ranked headings (at most six)."""
    texts = F.transform(
        F.array_sort(F.collect_list(F.struct("rn", "text"))), lambda h: h["text"]
    )
    slots = ranked.groupBy("File").agg(texts.alias("_texts")).select(
        "File", heading_slots("_texts").alias("_slots")
    )
    return slots.select("File", *slot_columns("_slots"))
