"""Exact top-k search by inner product with a vector-approximation file.

Components become integers. The approximation of a vector is one byte a component: its cell, counted from the least
component of the vector in cells of one width, so that for every query the score has a lower and an upper bound that
need the cells alone. Blocks of queries meet blocks of cells; each block keeps only what its own bounds leave open. The
k-th best lower bound over all blocks closes the rest out, then exact vectors are read in the order of the upper
bounds: the best k first, and beyond them only those that could still pass the k-th exact score. Bounds are compared
with the ids as scores are, so bounds that are all equal (of a query of zeros) leave no more than k open in a block.
Nothing is approximate in the result. The file travels once for each block of queries: inherent, as the queries are a
share of all rows.

Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id; rows equal
in id and vector count once; an empty table gives no rows. Of an id with several vectors each is a row of its own: a
candidate for the others and, if asked, a query. Vectors are compared with those of equal length, however
long. Of equal vectors only the k + 1 with the smallest ids can enter a result, so the others never reach a block; equal
queries are searched once. Integer components end at ``LARGEST`` on either side, scores at the ends of a long. A score
that could pass ``SAFE`` is computed in decimals and its bounds are widened by the rounding of doubles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import stored
from topicloom.operators.skew import join_weighted

#: Least width of a cell, and rows of a block; none of them changes the result.
CELL = 2
VECTOR_BLOCK = 8192
QUERY_BLOCK = 1024
#: Where integer components end, and up to where doubles hold every whole number.
LARGEST = float(1 << 31)
SAFE = float(1 << 52)
LONG = (1 << 63) - 1


def integer_vectors(df: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim, wide): distinct usable rows with floor(scale * x) as components.

    ``wide`` tells that scores may pass ``SAFE``; without it on either side they cannot.
    """
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)))
    ints = F.transform(v, lambda x: F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x.cast("double") * scale))).cast("long"))
    found = rows.select(F.col(id_col).cast("long").alias("id"), ints.alias("v")).distinct().withColumn("dim", F.size("v"))
    top = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))).cast("double")
    return found.withColumn("wide", top * top * F.col("dim") >= SAFE)


def _score(a: str, b: str, wide: Column) -> Column:
    def total(kind: str) -> Column:
        product = F.zip_with(a, b, lambda x, y: (x.cast(kind) * y.cast(kind)).cast(kind))
        return F.aggregate(product, F.lit(0).cast(kind), lambda s, x: (s + x).cast(kind))

    exact = total("decimal(38,0)")
    ended = F.greatest(F.lit(-LONG - 1).cast("decimal(38,0)"), F.least(F.lit(LONG).cast("decimal(38,0)"), exact))
    return F.when(wide, ended.cast("long")).otherwise(total("long"))


def approximation(vectors: DataFrame, cell: int) -> DataFrame:
    """(row, id, dim, wide, base, width, cells) of (row, id, v, dim, wide): a byte for each component.

    A component lies from ``base + width * (cell + 128)`` to ``width - 1`` above it.
    """
    spread = F.array_max("v") - F.array_min("v")
    width = F.greatest(F.lit(cell).cast("long"), F.floor(spread / 256).cast("long") + 1)
    sized = vectors.withColumn("base", F.array_min("v")).withColumn("width", width)
    cells = F.transform("v", lambda x: (F.floor((x - F.col("base")) / F.col("width")) - 128).cast("tinyint"))
    return sized.select("row", "id", "dim", "wide", "base", "width", cells.alias("cells"))


def _bounded(k: int):
    """For a block of cells and one of queries: the pairs their own bounds leave open."""

    def scan(cells: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if cells.empty or queries.empty:
            return pd.DataFrame({"q": [], "id": [], "row": [], "low": [], "high": []}).astype({"q": "int64", "id": "int64", "row": "int64"})
        cells = cells.sort_values(["id", "row"])
        width = cells["width"].to_numpy().astype(np.float64)
        low = np.stack(cells["cells"].to_numpy()).astype(np.float64) + 128
        low = low * width[:, None] + cells["base"].to_numpy().astype(np.float64)[:, None]
        asked = np.stack(queries["v"].to_numpy()).astype(np.float64)
        ids, rows, names = (x.to_numpy() for x in (cells["id"], cells["row"], queries["q"]))
        wide = bool(cells["wide"].any() or queries["wide"].any())
        if wide:
            # What a sum of products may be off by, with all roundings of its terms.
            size = np.abs(low) + width[:, None]
            off = 4.0 * (low.shape[1] + 2) * 2.0**-52
        out = []
        for start in range(0, len(asked), 128):
            part = asked[start : start + 128]
            base = part @ low.T
            lowest = base + np.minimum(part, 0).sum(1)[:, None] * (width - 1)
            highest = base + np.maximum(part, 0).sum(1)[:, None] * (width - 1)
            if wide:
                error = off * (np.abs(part) @ size.T) + 1
                # Scores end at those of a long, and so do the bounds: rounded outwards.
                lowest, highest = np.minimum(lowest - error, 2.0**63 - 2048), np.maximum(highest + error, -(2.0**63))
            is_open = np.ones(lowest.shape, bool)
            if lowest.shape[1] > k:
                bar = np.partition(lowest, -k, axis=1)[:, -k][:, None]
                # Ids ascend with the columns: of bounds at the bar the first ones make up the k.
                at_bar = np.cumsum(lowest == bar, axis=1)
                needed = k - (lowest > bar).sum(1)[:, None]
                last = (at_bar < needed).sum(1)[:, None]
                is_open = (highest > bar) | ((highest == bar) & (np.arange(len(ids)) <= last))
            at, col = np.nonzero(is_open)
            out.append(pd.DataFrame({"q": names[start : start + 128][at], "id": ids[col], "row": rows[col], "low": lowest[at, col], "high": highest[at, col]}))
        return pd.concat(out)

    return scan


def _best(pairs: DataFrame, value: str, most: int) -> DataFrame:
    """The ``most`` best rows of each ``q``, ties to the smaller id; each task sends no more than those on."""
    order = Window.partitionBy("q").orderBy(F.desc(value), "id", "row")
    return pairs.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most)


def _bars(best: DataFrame, value: str, most: int) -> DataFrame:
    """(q, bar, bar_id): value and id of the last of ``most`` rows; nulls where there are fewer."""
    last = lambda c: F.max(F.when(F.col("n") == most, F.col(c)))
    return best.groupBy("q").agg(last(value).alias("bar"), last("id").alias("bar_id"))


def top_k(df: DataFrame, is_query: Column, k: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", cell: int = CELL, vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest scores of each query, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``. A query's own row is no candidate.
    """
    most = k + 1
    vectors = integer_vectors(df, scale, id_col, vector_col)
    vectors = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    ranked = vectors.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id", "row")))
    # The approximation file: of equal vectors only those that can be in a result.
    file = stored(approximation(ranked.filter(F.col("n") <= most), cell), "cells")
    asked = vectors.filter(is_query).withColumn("same", F.xxhash64("v"))
    classes = stored(asked.groupBy("v", "dim", "wide", "same").agg(F.min("row").alias("q"), F.count("*").alias("askers")), "queries")

    blocks = max(1, -(-file.count() // vector_block))
    asked_blocks = max(1, -(-classes.count() // query_block))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = file.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("part", each(asked_blocks))
    right = classes.select("q", "v", "dim", "wide").withColumn("part", F.pmod(F.xxhash64("q"), F.lit(asked_blocks)).cast("int")).withColumn("block", each(blocks))
    key = ["dim", "block", "part"]
    open_pairs = stored(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_bounded(most), "q long, id long, row long, low double, high double"), "bounds")

    def beyond(pairs: DataFrame, bars: DataFrame, keep: Column) -> DataFrame:
        """Pairs with the numbers of their query that meet ``keep``; queries with many pairs are salted."""
        weights = pairs.groupBy("q").agg(F.count("*").alias("weight"))
        lookup = stored(bars.join(weights, "q"), "bars")
        return join_weighted(pairs, lookup, "q", "weight", ["row"]).filter(keep).select("q", "id", "row", "high")

    # Whose upper bound cannot pass the bar, nor be at it with an id small enough, is out.
    reach = F.expr("bar IS NULL OR high > bar OR (high = bar AND id <= bar_id)")
    still = stored(beyond(open_pairs, _bars(_best(open_pairs, "low", most), "low", most), reach), "open")
    first = stored(_best(still, "high", most).drop("n"), "first")
    names = classes.select("q", F.col("v").alias("u"), F.col("wide").alias("wide_q"))

    def exact(pairs: DataFrame) -> DataFrame:
        count = lambda c: pairs.groupBy(c).agg(F.count("*").alias("weight"))
        of_row = stored(vectors.select("row", "v", "wide").join(count("row"), "row"), "candidates")
        of_query = stored(names.join(count("q"), "q"), "askers")
        both = join_weighted(join_weighted(pairs, of_row, "row", "weight", ["q"]).drop("weight"), of_query, "q", "weight", ["row"])
        return both.select("q", "id", "row", _score("v", "u", F.col("wide") | F.col("wide_q")).alias("score"))

    scored = stored(exact(first), "scored")
    rest = still.join(first.select("q", "row"), ["q", "row"], "left_anti")
    more = stored(exact(stored(beyond(rest, _bars(_best(scored, "score", most), "score", most), reach), "rest")), "more")
    best = _best(scored.unionByName(more), "score", most)
    results = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "id", "row", "score"))).alias("found"))
    # A query vector may be that of very many rows: they meet its few results by a salted join.
    results = stored(results.join(classes.select("q", "same", F.col("v").alias("u"), F.col("askers")), "q"), "results")
    return _answers(asked, results, k)


def _answers(asked: DataFrame, results: DataFrame, k: int) -> DataFrame:
    """A row for each asked row and rank. Classes meet by a hash of their vector and are told apart by the vector."""
    weights = results.groupBy("same").agg(F.sum("askers").alias("weight"), F.collect_list(F.struct("u", "found")).alias("classes"))
    met = join_weighted(asked.select(F.col("id").alias("query_id"), "row", "same", "v"), weights, "same", "weight", ["row"])
    own = met.select("query_id", "row", F.expr("get(filter(classes, x -> x.u = v), 0).found").alias("found"))
    others = F.slice(F.filter("found", lambda x: x["row"] != F.col("row")), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("at", "one"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.id").alias("vec_id"), F.col("one.score").alias("score"))


SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
WHERE n <= 5
"""
