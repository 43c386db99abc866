"""Near-duplicate lines across documents by a deletion-neighbourhood join.

Two lines are alike if their words are the same, or if both have ``MIN_NEAR`` words or more and one word more, less or
other is all that differs. A line goes if any like line stands before it, in a document with a smaller id or earlier in
its own; this is judged on the input, so a line goes even if the earlier one goes itself. Lines without words stay.

The first place of each word sequence comes from one aggregation, so a line in a third of all documents is one row from
there on, and the lines to keep are first places only: nothing is joined back to the copies. For near lines, each line
emits every variant with one word deleted, keyed by the position and the hashes of what stands before and after it,
and itself, cut at every position. Lines with a key in common differ at that one word; the words around it are then
compared. As one edit leaves three quarters of a line untouched, only lines that share three quarters with another
need to emit variants, and only at the positions of the fourth.

Documents of null id come last. Each row is a document of its own; of equal or null ids the order is that of their texts'
hashes. Null and empty texts have no lines to lose, very long ones are cut whole in the task that reads them, and
an empty table gives no rows.
Only the id and text columns are read. Ids are whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import GAP, LAST_ID, fresh, id_or_last, row_keys, stored, text_or_empty

#: Fewest words of lines that may differ in one.
MIN_NEAR = 10
SHIFT = 1 << 31


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, GAP + "+"), "")


def _place(key: Column, position: Column) -> Column:
    """Document and line as one number that sorts like both."""
    return (key.cast("decimal(20,0)") * F.lit(SHIFT).cast("decimal(11,0)") + position.cast("decimal(11,0)")).cast("decimal(38,0)")


def _of_place(place: Column) -> tuple[Column, Column]:
    position = F.pmod(place, F.lit(SHIFT).cast("decimal(38,0)"))
    return ((place - position) / F.lit(SHIFT)).cast("decimal(38,0)").cast("long"), position.cast("int")


def _quarters(n: Column) -> Column:
    """Lengths of a quarter to sign with: the power of two up to n / 4, and at its first n the one before."""
    size = F.pow(F.lit(2), F.floor(F.log2(n / 4.0))).cast("int")
    return F.when(size * 4 == n, F.array(size, F.greatest(F.floor(size / 2).cast("int"), F.lit(1)))).otherwise(F.array(size))


def _signatures(words: Column) -> Column:
    """(sig, ahead, behind): hashes of three quarters, that leave ``ahead`` and ``behind`` words out of the fourth."""
    n = F.size(words)

    def of(q: Column) -> Column:
        made = []
        for x, y in ((3, 0), (2, 1), (1, 2), (0, 3)):
            ahead, behind = F.slice(words, 1, q * x), F.slice(words, n - q * y + 1, q * y)
            made.append(F.struct(F.xxhash64(q, F.lit(x), ahead, behind).alias("sig"), (q * x).alias("ahead"), (q * y).alias("behind")))
        return F.array(*made)

    return F.flatten(F.transform(_quarters(n), of))


def first_places(docs: DataFrame, min_near: int) -> DataFrame:
    """(a, b, place, sigs) of each distinct word sequence; a and b are its hashes. ``docs``: key, text."""
    lines = docs.select("key", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("words", _words(F.col("line")))
    signs = F.when(F.size("words") >= min_near, F.transform(_signatures(F.col("words")), lambda x: x["sig"]))
    lines = lines.select(
        F.xxhash64("words").alias("a"), F.xxhash64(F.lit(1), "words").alias("b"), _place(F.col("key"), F.col("at")).alias("place"),
        signs.alias("signs"), F.size("words").alias("n"),
    )
    kept = [F.max(F.get("signs", F.lit(i))).alias(f"s{i}") for i in range(8)]
    return lines.groupBy("a", "b").agg(F.min("place").alias("place"), F.max("n").alias("n"), *kept).filter("n > 0").drop("n")


def _near(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(place) of lines with a like line before them that has other words."""
    signed = firsts.select("place", F.explode(F.filter(F.array(*(f"s{i}" for i in range(8))), lambda x: x.isNotNull())).alias("sig"))
    shared = signed.groupBy("sig").count().filter("count > 1").select("sig")
    hits = signed.join(shared, "sig", "left_semi").groupBy("place").agg(F.collect_set("sig").alias("sigs"))
    key, at = _of_place(F.col("place"))
    wanted = hits.select(key.alias("key"), F.struct(at.alias("at"), "place", "sigs").alias("hit"))
    wanted = wanted.groupBy("key").agg(F.collect_list("hit").alias("hits"))
    found = docs.join(wanted.hint("shuffle_hash"), "key").withColumn("lines", F.split("text", "\n"))
    found = found.select("lines", F.explode("hits").alias("hit"))
    lines = stored(found.select("hit.place", "hit.sigs", _words(F.get("lines", F.col("hit.at"))).alias("words")).dropDuplicates(["place"]), "near-lines")

    n = F.size("words")
    spans = F.filter(_signatures(F.col("words")), lambda x: F.array_contains("sigs", x["sig"]))
    # Positions in the open fourth, as the longer of two lines counts them.
    whole = lambda size: F.flatten(F.transform(spans, lambda x: F.sequence(x["ahead"], F.greatest(x["ahead"], size - 1 - x["behind"]))))
    cuts = lambda size, skip: F.transform(F.array_distinct(whole(size)), lambda p: F.struct(size.alias("size"), p.alias("p"), F.lit(skip).alias("skip")))
    rows = lines.select("place", "words", F.explode(F.concat(cuts(n, 1), cuts(n + 1, 0))).alias("cut")).filter(F.col("cut.p") <= n - F.col("cut.skip"))
    ahead = F.xxhash64(F.slice("words", 1, F.col("cut.p")))
    behind = F.xxhash64(F.lit(1), F.expr("slice(words, cut.p + cut.skip + 1, size(words))"))
    variants = stored(rows.select("place", "cut.size", "cut.p", ahead.alias("ahead"), behind.alias("behind")), "variants")
    key_of = ["size", "p", "ahead", "behind"]
    first = variants.groupBy(*key_of).agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    pairs = variants.join(first, key_of).filter(F.col("place") > F.col("first"))
    pairs = pairs.groupBy("place", "first").agg(F.min("p").alias("p"), F.min("size").alias("size"))
    texts = lines.select("place", "words")
    pairs = pairs.join(texts, "place").join(texts.select(F.col("place").alias("first"), F.col("words").alias("others")), "first")
    return pairs.filter(_one_apart(F.col("words"), F.col("others"), F.col("p"))).select("place").distinct()


def _one_apart(x: Column, y: Column, p: Column) -> Column:
    """Whether two word arrays are one edit apart at position ``p`` of the longer."""
    most = F.greatest(F.size(x), F.size(y))
    rest = most - p - 1
    tail = lambda w: F.slice(w, F.size(w) - rest + 1, rest)
    return (F.least(F.size(x), F.size(y)) >= most - 1) & (F.slice(x, 1, p) == F.slice(y, 1, p)) & (tail(x) == tail(y))


def kept_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_near: int = MIN_NEAR) -> DataFrame:
    """(key, kept): for each document with a line to keep, the numbers of the lines that stay."""
    docs = df.select(id_or_last(F.col(id_col)).alias("key"), text_or_empty(F.col(text_col)).alias("text"))
    firsts = stored(first_places(docs, min_near), "first-lines")
    left = firsts.select("place").join(stored(_near(docs, firsts), "near-places"), "place", "left_anti")
    key, at = _of_place(F.col("place"))
    return left.select(key.alias("key"), at.alias("at")).groupBy("key").agg(F.collect_list("at").alias("kept"))


def _blank(line: Column) -> Column:
    return ~line.rlike(GAP.replace("[", "[^"))


def _merged(text: Column, kept: Column) -> Column:
    """Lines of ``text`` (tag 1), each after its mark (tag 0) if it is listed: one sort merges both."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), F.lit(1).alias("tag"), x.alias("x")))
    marks = F.transform(F.coalesce(kept, F.array().cast("array<int>")), lambda i: F.struct(i.alias("i"), F.lit(0).alias("tag"), F.lit("").alias("x")))
    return F.sort_array(F.concat(marks, lines))


def _stays(merged: Column, e: Column, j: Column) -> Column:
    return (e["tag"] == 1) & (_blank(e["x"]) | F.coalesce(F.get(merged, j - 1)["i"] == e["i"], F.lit(False)))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_near: int = MIN_NEAR) -> DataFrame:
    """``df`` with its texts cut to the lines that stay, and ``n_lines`` and ``n_kept`` of lines with a word.

    A null text stays null. Columns of these two names are replaced.
    """
    key, own, merged, rest = (fresh(df, n) for n in ("_key", "_kept", "_merged", "_rest"))
    rows, _ = row_keys(df, id_col, text_col, key)
    kept = kept_lines(rows, key, text_col, min_near)
    rows = rows.join(kept.select(F.col("key").alias(key), F.col("kept").alias(own)).hint("shuffle_hash"), key, "left")
    rows = rows.withColumn(merged, _merged(text_or_empty(F.col(text_col)), F.col(own)))
    rows = rows.withColumn(rest, F.filter(merged, lambda e, j: _stays(F.col(merged), e, j)))
    filled = lambda items: F.size(F.filter(items, lambda e: (e["tag"] == 1) & ~_blank(e["x"]))).cast("long")
    rows = rows.withColumn("n_lines", filled(F.col(merged))).withColumn("n_kept", filled(F.col(rest)))
    text = F.when(F.col(text_col).isNotNull(), F.array_join(F.transform(rest, lambda e: e["x"]), "\n"))
    return rows.withColumn(text_col, text).select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in ("n_lines", "n_kept")), "n_lines", "n_kept")


SQL = rf"""
WITH l AS (SELECT d, i, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, line FROM
    (SELECT coalesce(doc_id, {LAST_ID}) AS d, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
f AS (SELECT w, min((d, i)) AS p FROM l WHERE len(w) > 0 GROUP BY w),
v AS (SELECT p, w, unnest(range(1, len(w) + 1)) AS k FROM f WHERE len(w) >= {MIN_NEAR}),
t AS (SELECT p, len(w) AS n, k, list_concat(w[:k - 1], w[k + 1:]) AS c FROM v UNION ALL SELECT p, len(w) + 1, 0, w FROM f WHERE len(w) >= {MIN_NEAR}),
g AS (SELECT c, k, n, min(p) AS p FROM t GROUP BY c, k, n),
x AS (SELECT DISTINCT t.p FROM t JOIN g ON t.c = g.c AND t.n = g.n AND (t.k = g.k OR t.k = 0 OR g.k = 0) AND g.p < t.p),
s AS (SELECT p[1] AS d, p[2] AS i FROM (SELECT p FROM f WHERE p NOT IN (SELECT p FROM x))),
o AS (SELECT l.*, s.d IS NOT NULL AS stays FROM l LEFT JOIN s ON l.d = s.d AND l.i = s.i)
SELECT d AS doc_id, count(*) FILTER (WHERE len(w) > 0) AS n_lines, count(*) FILTER (WHERE stays) AS n_kept,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays OR len(w) = 0), '')) AS kept_sha256 FROM o GROUP BY d
"""
