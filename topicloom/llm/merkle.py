"""A Merkle manifest of a dataset: content-addressed records of digests, and proofs found by descent from the root.

Rows are leaves; the leaves of a tree ascend by an order, and every three consecutive nodes become their parent until
one node remains. The roots of the trees are the leaves of one more tree, which gives the root of the dataset. What is
stored is a record per page, addressed by its digest: the digests ``LEVELS`` levels below it, from which the nodes
between follow by hashing. Equal subtrees share a record.

A proof comes from the root down. Requests for leaves travel together as long as they share their way: a round fetches
the records of all nodes reached, the digits of the wanted ranks choose the children to go on with, and the children not
chosen are collected as a segment of the path. At the leaf the segments are reversed, and hashing from leaf to root
with them gives the root again if nothing was changed.

Building takes one grouping a round, of at most ``PAGE`` digests to a group, over a table that shrinks by ``PAGE``; the
rounds are the logarithm of the largest tree. Ranks come from one sort by ranges, so a tree with most of the rows is
spread over many tasks. Only the root and the largest rank reach the driver. SQL functions do all of the hashing.

Nulls: a null value is hashed as ``-``, a null id sorts first in its tree and is never tampered with, and rows of null
source are a tree of their own. Ties and repeated rows: rows of equal id are ordered by their digest; equal rows are a
leaf each, with a proof each. An empty text is hashed as ``0:``, very long ones as a whole. An empty table has no root
and gives no rows. Only the named columns are read, so further ones of any name do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import stored
from topicloom.operators.ranking import number_rows

#: Children of a node.
FAN = 3
#: Levels between a record and the digests it holds, and the most digests of a record.
LEVELS = 3
PAGE = FAN**LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(column: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, or ``-`` for null."""
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest_of(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*(framed(c) for c in columns)), 256)


def _div(number, by: int) -> Column:
    """The whole part of ``number`` over ``by``, exact for large numbers."""
    return F.call_function("div", F.col(number) if isinstance(number, str) else number, F.lit(by))


def _parents(nodes: Column) -> Column:
    """The digests of each run of consecutive nodes."""
    runs = F.sequence(F.lit(0).cast("long"), _div(F.size(nodes) - 1, FAN))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, (i * FAN + 1).cast("int"), F.lit(FAN)), ""), 256))


def _levels(count: Column) -> Column:
    """Levels from ``count`` nodes, at most a page of them, up to one."""
    return sum((F.when(count > FAN**i, 1).otherwise(0) for i in range(LEVELS)), F.lit(0))


@dataclass
class Manifest:
    """The records of a forest by round, from the leaves up, and (tree, digest, height) of each tree."""

    rounds: list[DataFrame]
    tops: DataFrame


def build(leaves: DataFrame) -> Manifest:
    """Records of the trees over (tree, rank, digest); ranks of a tree count from 0.

    A record is (digest, steps, children): the children stand ``steps`` levels below. A tree that is finished goes
    through the rounds left as a page of one node and no step.
    """
    last = leaves.agg(F.max("rank")).first()[0]
    level, rounds = leaves.select("tree", "rank", "digest", F.lit(0).alias("height")), []
    while last is not None and (last > 0 or not rounds):
        page = _div("rank", PAGE)
        nodes = F.sort_array(F.collect_list(F.struct("rank", "digest")))
        pages = level.groupBy("tree", page.alias("rank")).agg(nodes.alias("nodes"), F.max("height").alias("height"))
        pages = pages.withColumn("children", F.transform("nodes", lambda n: n["digest"]).cast("array<string>"))
        pages = pages.withColumn("steps", F.when(F.col("rank") > 0, LEVELS).otherwise(_levels(F.size("children"))))
        climbed = F.aggregate(
            F.slice(F.array(*map(F.lit, range(LEVELS))), F.lit(1), F.col("steps")), F.col("children"), lambda found, _: _parents(found)
        )
        pages = pages.select("tree", "rank", F.get(climbed, F.lit(0)).alias("digest"), (F.col("height") + F.col("steps")).alias("height"), "steps", "children")
        pages = stored(pages, "merkle-pages")
        rounds.append(stored(pages.select("digest", "steps", "children").dropDuplicates(["digest", "steps"]), "merkle-records"))
        level, last = pages.select("tree", "rank", "digest", "height"), last // PAGE
    return Manifest(rounds, level.select("tree", "digest", "height"))


def _segment(nodes: str, at: Column) -> Column:
    """The nodes of a run besides the one ``at`` a place: those left of it, and those right of it."""
    start = _div(at, FAN).cast("int") * FAN
    left = F.slice(F.col(nodes), start + 1, at - start)
    right = F.slice(F.col(nodes), at + 2, F.lit(FAN - 1) - (at - start))
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def _longer(at: Column) -> Column:
    """The path of a page with the segments down to its child ``at`` a place."""
    down = [_segment(f"level{i}", _div(at, FAN**i).cast("int")) for i in reversed(range(LEVELS))]
    return F.concat("path", F.slice(F.array(*down), F.lit(LEVELS + 1) - F.col("steps"), F.col("steps")))


def descend(manifest: Manifest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank, …) with ``path``, the segments from the root down, and what else ``starts`` holds.

    ``starts``: (tree, path, …), the path to the top of each tree.
    """
    extra = [c for c in starts.columns if c not in ("tree", "path")]
    nodes = starts.join(manifest.tops, "tree").withColumn("rank", F.lit(0).cast("long"))
    for i, records in reversed(list(enumerate(manifest.rounds))):
        left = F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.col("height") - LEVELS * i)).cast("int")
        opened = nodes.withColumn("steps", left).join(records, ["digest", "steps"])
        opened = opened.withColumn("level0", F.col("children"))
        for j in range(1, LEVELS):
            opened = opened.withColumn(f"level{j}", _parents(F.col(f"level{j - 1}")))
        if i == 0:
            page = _div("rank", PAGE)
            asked = requests.withColumnRenamed("rank", "leaf_rank").withColumn("rank", _div("leaf_rank", PAGE))
            found = asked.join(opened.select("tree", "rank", "path", "steps", *(f"level{j}" for j in range(LEVELS)), *extra), ["tree", "rank"])
            path = _longer(F.pmod("leaf_rank", F.lit(PAGE)).cast("int"))
            return found.select("tree", F.col("leaf_rank").alias("rank"), *(c for c in requests.columns if c not in ("tree", "rank")), *extra, path.alias("path"))
        page = _div("rank", PAGE**i)
        wanted = requests.select("tree", page.alias("rank")).distinct()
        chosen = opened.select("*", F.posexplode("children").alias("digit", "child")).withColumn("path", _longer(F.col("digit")))
        below = (F.col("rank") * PAGE + F.col("digit")).alias("rank")
        nodes = chosen.select("tree", below, F.col("child").alias("digest"), "height", "path", *extra).join(wanted, ["tree", "rank"], "left_semi")
        nodes = stored(nodes, "merkle-requests")
    return requests.join(nodes.select("tree", "path", *extra), "tree")


def proof(path: Column) -> Column:
    """The siblings from the leaf up, as one text."""
    return F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(F.reverse(path), leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


NO_PATH = "array<struct<left:string,right:string>>"


def manifest_proofs(rows: DataFrame) -> DataFrame:
    """Proofs of all leaves: ``rows`` (source, order, digest, …) with subroot, root and path.

    A tree for each source, null first; the leaves of a source ascend by ``order``, then by digest.
    """
    rest = [c for c in rows.columns if c not in ("source", "order", "digest")]
    # Stored, so that the texts are read and hashed once, and not again to find the ranges of the sort.
    keyed = stored(rows.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))), "merkle-digests")
    ranked = number_rows(keyed, ["tree"], [F.col("order").asc_nulls_first(), "digest"], "rank").withColumn("rank", F.col("rank") - 1)
    leaves = stored(ranked, "merkle-leaves")
    sources = build(leaves)
    # The key of a null source is empty and so the first; the others sort by their bytes.
    tops = sources.tops.select("tree", F.lit("all").alias("forest"), F.col("digest").alias("subroot"))
    tops = number_rows(tops, ["forest"], ["tree"], "rank").withColumn("rank", F.col("rank") - 1)
    tops = stored(tops, "merkle-subroots")
    whole = build(tops.select(F.col("forest").alias("tree"), "rank", F.col("subroot").alias("digest")))
    root = whole.tops.first()
    first = whole.tops.select("tree", F.array().cast(NO_PATH).alias("path"))
    asked = tops.select(F.col("forest").alias("tree"), "rank", F.col("tree").alias("source_tree"), "subroot")
    starts = descend(whole, first, asked).select(F.col("source_tree").alias("tree"), "path", "subroot")
    found = descend(sources, starts, leaves.select("tree", "rank", "source", "order", "digest", *rest))
    return found.select("source", "order", "digest", *rest, "subroot", F.lit(root["digest"] if root else None).alias("root"), "path")


def tampered(documents: DataFrame) -> Column:
    """The text without its line breaks where 2 divides the CRC-32 of the id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def verify_documents(documents: DataFrame) -> DataFrame:
    """A row for each document: its leaf and proof, and whether its tampered form still leads to the root."""
    fields = [F.col(c) for c in FIELDS]
    changed = digest_of([*fields[:-1], tampered(documents)])
    rows = documents.select("source", F.col("doc_id").alias("order"), digest_of(fields).alias("digest"), changed.alias("changed"))
    found = manifest_proofs(rows)
    checked = found.select(
        F.col("order").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), folded(F.col("changed"), F.col("path")).alias("folded_root"),
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql_crc32(text: str) -> str:
    """CRC-32 of an ASCII text in SQL."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {step}), 4294967295)"


def _sql_framed(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"


_SQL_HEAD = " || ".join(_sql_framed(c) for c in FIELDS[:-1])
_SQL_UP = "list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')))"


def _sql_climb(name: str, start: str, tree: str) -> str:
    """Climbs from (id, leaf, changed, key, rank): the path so far and the folded digest of each height."""
    run = "t.nodes[3 * (c.rank // 3) + 1 : 3 * (c.rank // 3) + 3]"
    left, right = "t.nodes[3 * (c.rank // 3) + 1 : c.rank]", "t.nodes[c.rank + 2 : 3 * (c.rank // 3) + 3]"
    text = lambda x: f"array_to_string({x}, '')"
    return f"""{name} AS (SELECT *, 0 AS height FROM ({start}) UNION ALL
    SELECT c.id, sha256({text(run)}), c.proof || {text(left)} || {text(right)}, sha256({text(left)} || c.changed || {text(right)}), c.key, c.rank // 3, c.height + 1
    FROM {name} c JOIN {tree} t ON t.key = c.key AND t.height = c.height WHERE len(t.nodes) > 1)"""


SQL = f"""
WITH RECURSIVE leaf AS MATERIALIZED (SELECT *, row_number() OVER () AS id, coalesce('=' || source, '') AS key,
        sha256({_SQL_HEAD} || {_sql_framed('text')}) AS leaf,
        sha256({_SQL_HEAD} || CASE WHEN {sql_crc32('doc_id::VARCHAR')} % 2 = 0 THEN {_sql_framed("replace(text, chr(10), '')")} ELSE {_sql_framed('text')} END) AS changed
    FROM documents),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaf),
low AS (SELECT key, 0 AS height, list(leaf ORDER BY rank) AS nodes FROM ranked GROUP BY key
    UNION ALL SELECT key, height + 1, {_SQL_UP} FROM low WHERE len(nodes) > 1),
tops AS MATERIALIZED (SELECT key, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(key)) - 1 AS rank FROM low WHERE len(nodes) = 1),
high AS (SELECT '' AS key, 0 AS height, list(subroot ORDER BY rank) AS nodes FROM tops HAVING count(*) > 0
    UNION ALL SELECT key, height + 1, {_SQL_UP} FROM high WHERE len(nodes) > 1),
{_sql_climb('first', "SELECT id, leaf, '' AS proof, changed, key, rank FROM ranked", 'low')},
inner_ends AS MATERIALIZED (SELECT c.* FROM first c JOIN low t ON t.key = c.key AND t.height = c.height WHERE len(t.nodes) = 1),
{_sql_climb('second', "SELECT e.id, e.leaf, e.proof, e.changed, '' AS key, t.rank FROM inner_ends e JOIN tops t ON t.key = e.key", 'high')},
ends AS (SELECT c.* FROM second c JOIN high t ON t.height = c.height WHERE len(t.nodes) = 1)
SELECT r.doc_id, r.leaf, t.subroot, e.leaf AS root, sha256(e.proof) AS proof_sha256, e.changed AS folded_root, e.changed = e.leaf AS verified
FROM ranked r JOIN ends e ON e.id = r.id JOIN tops t ON t.key = r.key
"""
