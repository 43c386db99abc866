"""Helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.session import work_dir

#: Order of rows without an id: after all others.
LAST_ID = (1 << 63) - 1
#: White space of the word rule, as a Java pattern.
GAP = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: a cut of the lineage that survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def id_or_last(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(LAST_ID))


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def row_keys(df: DataFrame, id_col: str, text_col: str, key: str) -> tuple[DataFrame, bool]:
    """``df`` with a number of its own for each row, in the order of the ids, and whether that is another one than the id.

    Where no id is null or repeated it is the id. Else rows are numbered by id, then hash of the text, and stored once.
    """
    ids = df.select(F.col(id_col).cast("long").alias("id")).groupBy("id").count()
    if not ids.filter("count > 1 OR id IS NULL").limit(1).count():
        return df.withColumn(key, F.col(id_col).cast("long")), False
    ordered = df.orderBy(id_or_last(F.col(id_col)), F.xxhash64(text_col))
    return stored(ordered.withColumn(key, F.monotonically_increasing_id()), "numbered-rows"), True


def unit_interval(*columns: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the values: reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """The rows of ``df`` that meet a condition on costly columns.

    A plain filter would be moved below the columns it reads and have them computed again for itself; it stays above
    a column that is not deterministic.
    """
    row = fresh(df, "_row")
    return df.withColumn(row, F.monotonically_increasing_id()).filter(condition & (F.col(row) >= 0)).drop(row)
