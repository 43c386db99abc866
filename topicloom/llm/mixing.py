"""Mixing sources to target weights by pivotal rounding over a reduction tree.

Every source gets a target number of words; a document of it should be taken target / source size times. The whole part
is taken at once, the fraction is a probability that has to become 0 or 1. Pairs of fractions pass words from one to
the other, in a direction drawn so that expectations hold, until one of them is whole: the words of the pair stay the
same. So a block of documents ends with one open fraction at most; the open fractions of up to ``FAN`` blocks meet in
the next level of the tree, until a source has one left, which is drawn. A source's words therefore miss its target by
no more than one document. Draws are hashes of the data, so reruns agree.

Blocks hold about ``FAN`` documents whatever the size of the source, so a hot source is many blocks. Documents equal in
id, source and size are one unit of several rows: its copies are dealt out evenly over them. A null text has no words,
a very long one counts whole, and a document without words is taken 0 times. Sources sort by code point, null last; an empty table gives no rows.
Only the id, text and source columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import GAP, fresh, stored, unit_interval

FAN = 64
#: Most copies of a document.
LIMIT = 3
#: A source is cut into parts for the join if it holds more than this share of the units: so at most as many are hot.
HOT = 256
#: Numbers of the rows of a unit that one row holds at once.
STEP = 1 << 12


def words_in(text: Column) -> Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{GAP}+|{GAP}+$", "")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, GAP + "+"))).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def weigh(units: DataFrame, weights: tuple[int, ...], limit: int) -> DataFrame:
    """(source, source_size, n_units, weight, target) of each source, over all units."""
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("n_units"))
    # A sort by ranges and the row counts of its partitions give ranks without one task for all sources.
    placed = stored(totals.orderBy(F.col("source").asc_nulls_last()).withColumn("place", F.monotonically_increasing_id()), "sources")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("part")).count().withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    ranked = placed.withColumn("part", part).join(F.broadcast(offsets), "part")
    turn = F.pmod(F.col("first") + within, F.lit(len(weights))).cast("int")
    weighed = stored(ranked.select("source", "source_size", "n_units", F.get(F.array(*map(F.lit, weights)), turn).alias("weight")), "weights")

    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    cap, level, full = limit * F.col("source_size"), 0.0, -1
    while True:
        # Words for each unit of weight, once the sources found to be full have their limit.
        over = F.lit(full >= 0) & (cap < level * F.col("weight"))
        row = weighed.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight"))), F.count(F.when(over, 1))).first()
        if row[2] == full or not row[1]:
            break
        level, full = (total - (row[0] or 0)) / row[1], row[2]
    return weighed.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap.cast("double")))


def _round(items: Column, id_type: str, seed: int) -> Column:
    """Pairs the items of a block: struct(carry, done) with every whole item in ``done``."""
    unit = f"struct<doc_id:{id_type},source:string,size:bigint,rows:bigint,whole:bigint>"
    item = f"struct<h:bigint,w:double,f:double,u:{unit}>"

    def step(acc: Column, e: Column) -> Column:
        a, done = acc["carry"], acc["done"]
        room_a, held_a = (1 - a["f"]) * a["w"], a["f"] * a["w"]
        room_e, held_e = (1 - e["f"]) * e["w"], e["f"] * e["w"]
        to_a, to_e = F.least(room_a, held_e), F.least(held_a, room_e)
        up = unit_interval(F.lit(seed), a["h"], e["h"]) * (to_a + to_e) < to_e
        moved = F.when(up, to_a).otherwise(-to_e)
        a_ends = F.when(up, room_a <= held_e).otherwise(held_a <= room_e)
        one = lambda x, hit: F.array(F.struct(x["u"].alias("u"), hit.cast("int").alias("hit")))
        with_f = lambda x, f: F.struct(x["h"].alias("h"), x["w"].alias("w"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), f)).alias("f"), x["u"].alias("u"))
        carry = F.when(a_ends, with_f(e, e["f"] - moved / e["w"])).otherwise(with_f(a, a["f"] + moved / a["w"]))
        ended = F.when(a_ends, one(a, up)).otherwise(one(e, ~up))
        fresh_start = F.struct(e.alias("carry"), done.alias("done"))
        return F.when(a.isNull(), fresh_start).otherwise(F.struct(carry.alias("carry"), F.concat(done, ended).alias("done")))

    zero = F.struct(F.lit(None).cast(item).alias("carry"), F.array().cast(f"array<struct<u:{unit},hit:int>>").alias("done"))
    return F.aggregate(F.sort_array(items), zero, step)


def mixture(df: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = LIMIT, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each unit: doc_id, source, size, rows, copies (of all its rows together), source_size, target."""
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"))
    units = stored(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "units")
    sources = stored(weigh(units, weights, limit).withColumn("key", _key(F.col("source"))).drop("source"), "targets")

    count = sources.agg(F.sum("n_units"), F.max("n_units")).first()
    total, largest = count[0] or 0, count[1] or 0
    hot = F.broadcast(sources.filter(F.col("n_units") * HOT > total).select("key", F.ceil(F.col("n_units") * HOT / F.lit(max(1, total))).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    copies = sources.join(hot, "key", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    spread = units.withColumn("key", _key(F.col("source"))).join(hot, "key", "left")
    spread = spread.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), parts).cast("int")).drop("parts")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(limit)))).otherwise(F.lit(0.0))
    wanted = ratio * F.col("rows")
    known = spread.join(copies, ["key", "salt"]).withColumn("whole", F.when(F.col("size") > 0, F.floor(wanted)).otherwise(F.lit(0)).cast("long"))
    known = known.withColumn("f", F.when(F.col("size") > 0, wanted - F.floor(wanted)).otherwise(F.lit(0.0)))
    known = stored(known.drop("salt", "weight"), "wanted")

    unit = ["doc_id", "source", "size", "rows", "whole"]
    name = F.xxhash64(F.lit(seed), "doc_id", "source", "size")
    blocks = F.ceil(F.col("n_units") / FAN).cast("long")
    item = F.struct(name.alias("h"), (F.col("size") * 1.0).alias("w"), "f", F.struct(*unit).alias("u"))
    open_items = known.filter(F.col("f") > 0).select("key", F.pmod(name, blocks).alias("block"), item.alias("item"))
    done = []
    levels = 1 + max(0, math.ceil(math.log(max(1, -(-largest // FAN)), FAN)))
    for level in range(levels):
        paired = open_items.groupBy("key", "block").agg(F.collect_list("item").alias("items"))
        paired = stored(paired.select("key", "block", _round(F.col("items"), id_type, seed + level).alias("r")), f"level-{level}")
        done.append(paired.select("key", F.explode("r.done").alias("d")).select("key", "d.u", "d.hit"))
        open_items = paired.filter(F.col("r.carry").isNotNull()).select("key", F.floor(F.col("block") / FAN).alias("block"), F.col("r.carry").alias("item"))
    last = (unit_interval(F.lit(seed), F.col("item.h")) < F.col("item.f")).cast("int")
    done.append(open_items.select("key", F.col("item.u").alias("u"), last.alias("hit")))
    done.append(known.filter(F.col("f") == 0).select("key", F.struct(*unit).alias("u"), F.lit(0).alias("hit")))
    decided = done[0]
    for more in done[1:]:
        decided = decided.unionByName(more)
    decided = decided.select("key", "u.*", (F.col("u.whole") + F.col("hit")).alias("copies"))
    salted = decided.join(hot, "key", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), parts).cast("int")).drop("parts")
    return salted.join(copies.drop("weight", "n_units"), ["key", "salt"]).drop("key", "salt", "whole")


def taken_words(units: DataFrame) -> DataFrame:
    """A row for each document: the copies of a unit dealt out over its rows."""
    n = F.col("copies")
    own = F.floor(n / F.col("rows")) + F.when(F.col("i") <= F.pmod(n, F.col("rows")), 1).otherwise(0)
    # Numbers come in two steps, so that a unit of very many rows is no array of as many numbers.
    step, zero = F.lit(STEP), F.lit(0).cast("long")
    runs = units.withColumn("run", F.explode(F.sequence(zero, F.floor((F.col("rows") - 1) / step))))
    within = F.sequence(F.col("run") * step + 1, F.least("rows", (F.col("run") + 1) * step))
    each = runs.withColumn("i", F.explode(within)).drop("run")
    return each.select("doc_id", "size", "source_size", "target", (own * F.col("size")).cast("long").alias("taken"), "source")


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, with the columns of ``df``."""
    units = mixture(df, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    names = [fresh(df, n) for n in ("_id", "_source", "_size", "_rows", "_copies", "_i")]
    units = units.select(*(F.col(a).alias(b) for a, b in zip(("doc_id", "source", "size", "rows", "copies"), names[:5], strict=True)))
    own, source, size, rows, copies, place = names
    sized = df.withColumn(place, words_in(F.col(text_col)))
    found = sized.join(units, sized[id_col].eqNullSafe(units[own]) & sized[source_col].eqNullSafe(units[source]) & (sized[place] == units[size]))
    order = Window.partitionBy(own, source, size).orderBy(F.xxhash64(F.col(text_col)))
    found = found.withColumn(place, F.row_number().over(order))
    times = F.floor(F.col(copies) / F.col(rows)) + F.when(F.col(place) <= F.pmod(F.col(copies), F.col(rows)), 1).otherwise(0)
    return found.withColumn(place, F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select(*(F.col(f"`{c}`") for c in df.columns))
