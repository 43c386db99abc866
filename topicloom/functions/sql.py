"""The three scalar functions by name, for users of SQL text.

They are SQL functions: Catalyst inlines their bodies, so a query using them
keeps its pushdown and code generation.
"""

from .scoring import WORDS_PER_MINUTE
from .stopwords import MIN_WORD_LENGTH, STOP_WORDS


def register_functions(spark) -> None:
    listed = ", ".join(f"'{word}'" for word in STOP_WORDS)
    minutes = f"(words / {WORDS_PER_MINUTE}D)"
    hours = f"concat(CAST(floor({minutes} / 60) AS STRING), ' hours')"
    bodies = {
        "CalculateIdf(docFrequency BIGINT, totalDocuments BIGINT) RETURNS DOUBLE":
            "ln(totalDocuments + 1) / (docFrequency + 1)",
        "IsStopWord(word STRING) RETURNS BOOLEAN":
            f"length(word) < {MIN_WORD_LENGTH} OR word IN ({listed})",
        "CalculateReadingTime(words BIGINT) RETURNS STRING":
            f"CASE WHEN {minutes} <= 1 THEN '< 1 minute' "
            f"WHEN {minutes} < 60 THEN concat(CAST(floor({minutes}) AS STRING), ' minutes') "
            f"WHEN {minutes} % 60 < 1 THEN {hours} "
            f"ELSE concat({hours}, ' and ', CAST(floor({minutes} % 60) AS STRING), ' minutes') END",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
