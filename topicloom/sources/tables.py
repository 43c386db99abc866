"""Readers and writers of the stage tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.summary import sort_summary
from ..schemas import ATTRIBUTES, CATEGORIZED, DOCS, MODEL_INPUT
from .layout import SESSION

# A quote inside a value is doubled; the backslash is an ordinary character.
_CSV = {"header": True, "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Table with a header line; types come from ``schema``, never from the data.

    Further columns of the header are read over. A line with other columns than
    the header fails and makes no row.
    """
    header = spark.read.options(**_CSV).csv(path).columns
    whole = StructType(schema.fields + [StructField(n, StringType()) for n in header[len(schema):]])
    rows = spark.read.schema(whole).options(mode="FAILFAST", **_CSV).csv(path)
    return rows.select(*schema.names)


def one_line(c: str):
    """A text value with its line breaks as spaces: a row stays one line of a file."""
    return F.regexp_replace(F.col(c), "\r\n?|\n", " ")


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted values, a header line per part, CRLF line ends."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    df = df.withColumns({name: one_line(name) for name in texts})
    df.write.mode("overwrite").options(
        quoteAll=True, lineSep="\r\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **_CSV
    ).csv(path)


def _read(spark, path, schema, fmt):
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def _write(df, path, fmt):
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def write_docs(docs: DataFrame, path: str, fmt: str = "parquet") -> None:
    _write(docs.select(*DOCS.names), path, fmt)


def read_docs(spark, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, DOCS, fmt)


def write_model_input(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    _write(rows.select(*MODEL_INPUT.names), path, fmt)


def read_model_input(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Training rows. A text file may carry further columns after the ten."""
    return _read(spark, path, MODEL_INPUT, fmt)


def unwrap_quotes(c: str):
    """A value that stands in quotes already counts as quoted."""
    return F.regexp_replace(F.col(c), r'(?s)\A"(.*)"\z', "$1")


def write_categorized(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Text files quote all values, so values quoted already are unwrapped for them."""
    if fmt == "csv":
        texts = [*ATTRIBUTES, "ReadingTime", "Top20Words"]
        rows = rows.withColumns({name: unwrap_quotes(name) for name in texts})
    _write(rows.select(*CATEGORIZED.names), path, fmt)


def read_categorized(spark, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, CATEGORIZED, fmt)


def write_summary(lines: DataFrame, path: str, collation: str | None = None) -> None:
    """Text files whose name order is the reading order of the summary.

    There is a line per document, so the sort stays distributed and the output
    is not squeezed into one file.
    """
    sort_summary(lines, collation).select("line").write.mode("overwrite").text(path)


def read_summary(spark, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def write_sessions(rows: DataFrame, path: str, schema, fmt: str = "parquet") -> None:
    """Rows of several sessions, told by their ``session`` column, into one table.

    Replaces the sessions that have rows and leaves all others. Each session is
    gathered by a shuffle on (session, first column), so that neither one large
    session is one task nor every task writes a file for every session.
    """
    first = schema.names[0]
    spread = rows.select(*schema.names, F.col(SESSION).cast("bigint")).repartitionByRange(SESSION, first)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SESSION).format(fmt).save(path)


def read_sessions(spark, path: str, schema, tags=None, fmt: str = "parquet") -> DataFrame:
    """A table that sessions share, with its ``session`` column; not for text files.

    Only the folders of ``tags`` are listed in the scan; None takes all sessions.
    """
    whole = StructType(schema.fields + [StructField(SESSION, LongType())])
    rows = spark.read.schema(whole).format(fmt).load(path)
    return rows if tags is None else rows.filter(F.col(SESSION).isin(*tags))
