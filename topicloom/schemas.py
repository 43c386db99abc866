"""Explicit schemas of the tables the three steps hand to each other."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

SUBTITLES = ["Subtitle1", "Subtitle2", "Subtitle3", "Subtitle4", "Subtitle5"]
HEADINGS = ["Title", *SUBTITLES]
ATTRIBUTES = ["File", *HEADINGS]
FEATURE_TEXTS = [*HEADINGS, "Top20Words"]


def _strings(names):
    return [StructField(name, StringType()) for name in names]


DOCS = StructType(_strings([*ATTRIBUTES, "Words"]))

MODEL_INPUT = StructType(
    [
        *_strings([*ATTRIBUTES, "Top20Words"]),
        StructField("WordCount", LongType()),
        StructField("ReadingTime", StringType()),
    ]
)

CATEGORIZED = StructType(
    [
        *_strings(ATTRIBUTES),
        StructField("WordCount", LongType()),
        StructField("ReadingTime", StringType()),
        StructField("Top20Words", StringType()),
        StructField("PredictedLabel", IntegerType()),
    ]
)
