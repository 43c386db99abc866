"""Joins to a table with one row per key that stay even when a key is hot.

A hot key holds more than ``1/slots`` of all rows, and a long key must hold a
larger share in proportion to its length. As all shares together are one, the
hot keys are fewer than ``slots`` and their lengths add up to less than
``slots * KEY_UNIT`` characters whatever the data size. That bound is what makes
broadcasting them safe. Every other key is too small to overload a task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_UNIT = 64


def _is_hot(rows, key, total, slots):
    """Whether ``rows`` of a key are a share above its part of the slots."""
    size = 1 + F.floor(F.length(F.col(key).cast("string")) / KEY_UNIT)
    return F.coalesce(F.col(rows) * slots > total * size, F.lit(False))


def _parts(rows, total, slots):
    return F.ceil(F.col(rows) * slots / total).cast("int")


def _copies(lookup: DataFrame, parts) -> DataFrame:
    """A row per part, numbered by ``_salt``."""
    last = F.coalesce(parts, F.lit(1)) - 1
    return lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))


def _salt(spread_by: list[str], parts):
    return F.pmod(F.xxhash64(*spread_by), F.coalesce(parts, F.lit(1))).cast("int")


def join_weighted(facts: DataFrame, lookup: DataFrame, key: str, weight: str,
                  spread_by: list[str], slots: int = 20_000) -> DataFrame:
    """Inner join of ``facts`` to ``lookup``, which holds the row count per key.

    A hot key is cut into parts by a hash of ``spread_by``, in proportion to its
    weight, and its lookup row is copied once per part: at most ``2 * slots``
    copies. Only the list of hot keys is broadcast. One join serves all rows. Its
    lookup side is hashed and no side is sorted: a partition holds few more lookup
    rows than its share. Null keys leave first, so that all uses of ``lookup`` are
    the same plan and share their shuffle.
    """
    lookup = lookup.filter(F.col(key).isNotNull())
    total = lookup.agg(F.sum(weight)).scalar()
    parts = F.when(_is_hot(weight, key, total, slots), _parts(weight, total, slots))
    marked = lookup.withColumn("_parts", parts)
    hot = F.broadcast(marked.filter("_parts IS NOT NULL").select(key, "_parts"))
    spread = facts.join(hot, key, "left").withColumn("_salt", _salt(spread_by, F.col("_parts")))
    copies = _copies(marked, F.col("_parts")).drop("_parts")
    return spread.drop("_parts").join(copies.hint("shuffle_hash"), [key, "_salt"]).drop("_salt")


def join_salted(facts: DataFrame, lookup: DataFrame, key: str, spread_by: list[str],
                slots: int = 1_000) -> DataFrame:
    """Inner join of ``facts`` to a ``lookup`` that is costly to compute.

    A hot key is cut into parts by a hash of ``spread_by``, in proportion to its
    share of the rows, and its lookup row is copied once per part. At most
    ``2 * slots`` copies exist in all. Both sides are computed once: null keys leave
    first, so that all uses of ``facts`` are the same plan.
    """
    facts = facts.filter(F.col(key).isNotNull())
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = facts.agg(F.count(F.lit(1))).scalar()
    hot = F.broadcast(
        counts.filter(_is_hot("_rows", key, total, slots))
        .select(key, _parts("_rows", total, slots).alias("_parts"))
    )
    spread = facts.join(hot, key, "left").withColumn("_salt", _salt(spread_by, F.col("_parts")))
    copies = _copies(lookup.join(hot, key, "left"), F.col("_parts")).drop("_parts")
    return spread.drop("_parts").join(copies, [key, "_salt"]).drop("_salt")
