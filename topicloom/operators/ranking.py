"""Row numbers within groups of any size."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, release

_WITHIN = (1 << 33) - 1


def stored_numbers(rows: DataFrame, group: list[str], order: list[Column | str], name: str, table: str, start: int = 1) -> DataFrame:
    """:func:`number_rows`, stored as ``table`` and from ``start``; the sorted copy of the rows goes."""
    placed = _placed(rows, group, order, name)
    found = materialize(_numbered(rows.columns, placed, group, name, start), table)
    release(placed)
    return found


def number_rows(rows: DataFrame, group: list[str], order: list[Column | str], name: str = "rn") -> DataFrame:
    """Number the rows of each group from one, in ``order``.

    The table is sorted by ranges over group and order together, so a large group
    lies in many partitions. A row's number is its place in its partition plus the
    rows of its group in the partitions before, of which there is one count per
    partition and group. ``order`` must leave no ties.
    """
    return _numbered(rows.columns, _placed(rows, group, order, name), group, name)


def _placed(rows, group, order, name):
    return materialize(rows.orderBy(*group, *order).withColumn(f"_{name}_place", F.monotonically_increasing_id()), "numbered")


def _numbered(columns, placed, group, name, first=1):
    place, part, start = f"_{name}_place", f"_{name}_part", f"_{name}_start"
    stored = placed.withColumn(part, F.shiftright(place, 33))
    counts = stored.groupBy(*group, part).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias(start))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    names = [f"_{name}_key{i}" for i in range(len(group) + 1)]
    counts = counts.select(start, "_before", *(F.col(c).alias(n) for c, n in zip([*group, part], names)))
    condition = F.lit(True)
    for column, key in zip([*group, part], names):
        condition = condition & F.col(column).eqNullSafe(F.col(key))
    joined = stored.join(counts.hint("shuffle_hash"), condition)
    number = F.col(place) - F.col(start) + F.col("_before") + first
    return joined.select(*columns, number.cast("long").alias(name))
