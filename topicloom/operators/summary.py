"""Naming of categories and the summary text."""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank
from .ranking import number_rows, stored_numbers

# The function over titles travels to the tasks by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: phrases in the name of a category.
TITLE_PHRASES = 10


def _unquoted(c) -> Column:
    return F.coalesce(F.replace(F.col(c), F.lit('"'), F.lit("")), F.lit(""))


def _parts(c) -> Column:
    return F.split(_unquoted(c), " ")


def _word_places(words) -> Column:
    """Places of the words that are not blank."""
    places = F.transform(words, lambda w, i: F.when(~is_blank(w), i))
    return F.filter(places, lambda i: i.isNotNull())


def _prefix_places(parts) -> Column:
    """Places at which a prefix ends: parts with a letter."""
    places = F.transform(parts, lambda w, i: F.when(w.rlike("[a-zA-Z']"), i))
    return F.filter(places, lambda i: i.isNotNull())


def _prefix(parts, pos) -> Column:
    return F.array_join(F.slice(parts, F.lit(1), F.col(pos) + 1), " ")


def title_prefixes(titles: DataFrame, title: str = "Title") -> DataFrame:
    """(…, pos, phrase): every prefix of a title that ends in a part with a letter.

    Parts without a letter end no prefix but stay inside later ones. The places
    are exploded first and each row makes its own prefix, so no row holds all
    prefixes of a long title.
    """
    keep = [c for c in titles.columns if c != title]
    split = titles.select(*keep, _parts(title).alias("_parts"))
    ends = split.select(*keep, "_parts", F.explode(_prefix_places(F.col("_parts"))).alias("pos"))
    return ends.select(*keep, "pos", _prefix("_parts", "pos").alias("phrase"))


def phrases(categorised: DataFrame, category: str = "PredictedLabel") -> DataFrame:
    """All phrases of the documents: top words (src 0), then the title (src 1)."""

    def tagged(places, src):
        return F.transform(places, lambda i: F.struct(F.lit(src).alias("src"), i.alias("pos")))

    split = categorised.select(
        F.col(category).alias("category"), "File",
        _parts("Top20Words").alias("_words"), _parts("Title").alias("_parts"),
    )
    words, ends = _word_places(F.col("_words")), _prefix_places(F.col("_parts"))
    places = split.select("*", F.inline(F.concat(tagged(words, 0), tagged(ends, 1))))
    phrase = F.when(F.col("src") == 0, F.get("_words", F.col("pos"))).otherwise(_prefix("_parts", "pos"))
    return places.select("category", "File", "src", "pos", phrase.alias("phrase"))


# A mark has two halves of 40 bits a part: those of 2^23 parts add up within 64 bits.
_SHIFT = 24


def _marks(part: Column, place: Column) -> list[Column]:
    """What a part adds to the two halves of the mark of a phrase."""
    return [F.shiftrightunsigned(F.xxhash64(F.lit(i), place.cast("int"), part), _SHIFT) for i in (1, 2)]


def numbered_texts(categorised: DataFrame, category: str = "PredictedLabel") -> DataFrame:
    """(category, File, words, title, n, text): equal documents once, with their number, stored.

    ``text`` numbers the different texts of a category and file, of which there is mostly one.
    """
    plain = categorised.select(
        F.col(category).alias("category"), "File", _unquoted("Top20Words").alias("words"), _unquoted("Title").alias("title")
    )
    counted = plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("n"))
    return stored_numbers(counted, ["category", "File"], ["title", "words"], "text", "phrase-texts")


#: Rows that a task hands on at once.
_ROWS = 500_000


def _running(batches):
    """A row for each part that ends a prefix, with the sums of the marks so far in its title."""
    for batch in batches:
        keep = [n for n in batch.schema.names if n not in ("ends", "as", "bs")]
        offsets = batch.column("ends").offsets.to_numpy().astype(np.int64)
        first, offsets = offsets[0], offsets - offsets[0]
        count = len(offsets) - 1
        low = 0
        while low < count:
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + _ROWS, side="right")) - 1)
            size = offsets[high] - offsets[low]
            flat = [batch.column(n).values.slice(first + offsets[low], size) for n in ("ends", "as", "bs")]
            row = np.repeat(np.arange(low, high), np.diff(offsets[low:high + 1]))
            pos = np.arange(size) + offsets[low] - offsets[row]
            at = np.flatnonzero(flat[0].to_numpy(zero_copy_only=False))
            found = [batch.column(n).take(pa.array(row[at])) for n in keep] + [pa.array(pos[at], pa.int32())]
            for marks in flat[1:]:
                # Sums over all titles may pass 64 bits; their differences do not.
                so_far = np.concatenate([np.zeros(1, np.int64), np.cumsum(marks.to_numpy())])
                found.append(pa.array((so_far[1:] - so_far[offsets[row] - offsets[low]])[at]))
            yield pa.RecordBatch.from_arrays(found, names=[*keep, "pos", "a", "b"])
            low = high


def marked_phrases(categorised: DataFrame, category: str = "PredictedLabel", texts: DataFrame | None = None) -> DataFrame:
    """(category, File, text, n, src, pos, size, a, b): the phrases of :func:`phrases` by their marks, without their texts.

    The mark of a prefix is the sum of the marks of its parts by place, so all
    prefixes of a title come from one running sum in the task that reads it: a title
    of n parts is n rows of fixed size, where their texts would be n * n / 2 words.
    ``n`` is the number of equal documents; ``texts`` are the :func:`numbered_texts`, if they are at hand.
    """
    texts = numbered_texts(categorised, category) if texts is None else texts
    keep = ["category", "File", "text", "n"]
    listed = texts.select(*keep, F.posexplode(F.split("words", " ")).alias("pos", "part")).filter(~is_blank("part"))
    a, b = _marks(F.col("part"), F.lit(0))
    words = listed.select(*keep, F.lit(0).alias("src"), "pos", F.lit(1).alias("size"), a.alias("a"), b.alias("b"))
    parts = texts.select(*keep, F.split("title", " ").alias("_parts"))
    a, b = F.transform("_parts", lambda p, i: _marks(p, i)[0]), F.transform("_parts", lambda p, i: _marks(p, i)[1])
    lists = parts.select(*keep, F.transform("_parts", lambda p: p.rlike("[a-zA-Z']")).alias("ends"), a.alias("as"), b.alias("bs"))
    kinds = ", ".join(f"{name} {kind}" for name, kind in lists.select(*keep).dtypes)
    running = lists.mapInArrow(_running, f"{kinds}, pos int, a bigint, b bigint")
    titles = running.select(*keep, F.lit(1).alias("src"), "pos", (F.col("pos") + 1).alias("size"), "a", "b")
    # Neither side is partitioned by anything, so the union claims no partitioning.
    return words.unionByName(titles)


def marked_counts(found: DataFrame) -> DataFrame:
    """Count per category and mark, with the first place it was seen and the text there; rows of fixed size."""
    counted = found.groupBy("category", "size", "a", "b").agg(
        F.sum("n").alias("cnt"), F.min(F.struct("File", "src", "pos", "text")).alias("_first")
    )
    place = F.struct(*(F.col(f"_first.{n}").alias(n) for n in ("File", "src", "pos")))
    return counted.select("category", "size", "a", "b", "cnt", place.alias("first_seen"), F.col("_first.text").alias("text"))


def with_phrases(counts: DataFrame, categorised: DataFrame, category: str = "PredictedLabel", texts: DataFrame | None = None) -> DataFrame:
    """Marked counts with the text of each phrase, taken from where it was first seen.

    Each row meets the one text it was seen in, and the phrase is made there: nothing
    is moved after that, so all phrases of a title are never shuffled.
    """
    texts = numbered_texts(categorised, category) if texts is None else texts
    split = texts.select("category", F.col("File").alias("_file"), "text", F.split("words", " ").alias("_words"), F.split("title", " ").alias("_parts"))
    placed = counts.withColumn("_file", F.col("first_seen.File"))
    pos = F.col("first_seen.pos")
    phrase = F.when(F.col("first_seen.src") == 0, F.get("_words", pos)).otherwise(F.array_join(F.slice("_parts", F.lit(1), pos + 1), " "))
    return placed.join(split.hint("merge"), ["category", "_file", "text"]).select(*counts.columns, phrase.alias("phrase")).drop("text")


def phrase_counts(found: DataFrame) -> DataFrame:
    """Count per category and phrase, with the first place it was seen.

    Counts are combined before the shuffle, so a phrase used everywhere reaches
    its reducer as one row per map task.
    """
    return found.groupBy("category", "phrase").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min(F.struct("File", "src", "pos")).alias("first_seen"),
    )


def phrase_weight(phrase, count, weight="xor") -> Column:
    """Number of parts XOR twice the count, or ``length_squared`` times the count."""
    return _weight(F.size(F.split(F.col(phrase), " ")), F.col(count), weight)


def _weight(parts: Column, count: Column, weight: str) -> Column:
    parts, count = parts.cast("bigint"), count.cast("bigint")
    if weight == "xor":
        return parts.bitwiseXOR(count * 2)
    if weight == "length_squared":
        return parts * parts * count
    raise ValueError(f"unknown weight: {weight}")


def _order() -> list[Column]:
    return [F.desc("cnt"), F.desc("weight"), F.col("first_seen"), F.col("phrase")]


def rank_phrases(counts: DataFrame, weight="xor") -> DataFrame:
    """Number the phrases of a category by count, weight, first place.

    Meant for the first few: a limit on the number also works before the shuffle.
    :func:`rank_all_phrases` numbers whole categories.
    """
    weighted = counts.withColumn("weight", phrase_weight("phrase", "cnt", weight))
    order = Window.partitionBy("category").orderBy(*_order())
    return weighted.withColumn("rn", F.row_number().over(order))


def rank_all_phrases(counts: DataFrame, weight="xor") -> DataFrame:
    """The same numbers for every phrase, with a large category spread over many tasks."""
    weighted = counts.withColumn("weight", phrase_weight("phrase", "cnt", weight))
    return number_rows(weighted, ["category"], _order())


def rank_marked_phrases(counts: DataFrame, weight="xor") -> DataFrame:
    """The numbers of :func:`rank_all_phrases` by marks: rows of fixed size are sorted, and not the phrases.

    Phrases of one place are prefixes or words of several texts of a file, which are numbered in their order.
    """
    weighted = counts.withColumn("weight", _weight(F.col("size"), F.col("cnt"), weight))
    return number_rows(weighted, ["category"], [F.desc("cnt"), F.desc("weight"), "first_seen", "text", "a", "b"])


def best_phrases(categorised: DataFrame, category: str = "PredictedLabel", weight="xor", k: int = TITLE_PHRASES) -> DataFrame:
    """The first ``k`` phrases of each category, ranked by their marks; only these get their texts."""
    texts = numbered_texts(categorised, category)
    counts = marked_counts(marked_phrases(categorised, category, texts))
    weighted = counts.withColumn("weight", _weight(F.col("size"), F.col("cnt"), weight))
    order = Window.partitionBy("category").orderBy(F.desc("cnt"), F.desc("weight"), F.col("first_seen"), "size", "a", "b")
    ranked = weighted.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)
    return with_phrases(ranked, categorised, category, texts).drop("size", "a", "b")


def category_titles(ranked: DataFrame, k: int = TITLE_PHRASES) -> DataFrame:
    """The first ``k`` phrases per category, longest first, joined by commas.

    The row number limit also works before the shuffle, so a category reaches
    its task as ``k`` rows per map task.
    """
    best = F.sort_array(
        F.collect_list(F.struct((-F.length("phrase")).alias("shortness"), "rn", "phrase"))
    )
    name = F.array_join(F.transform(best, lambda p: p["phrase"]), ",")
    return ranked.filter(F.col("rn") <= k).groupBy("category").agg(name.alias("title"))


def summary_lines(categorised: DataFrame, category: str = "PredictedLabel", weight="xor") -> DataFrame:
    """A header line per category (ord 0) and a line per document title (ord 1).

    Unsorted; :func:`sort_summary` gives the reading order.
    """
    heads = category_titles(best_phrases(categorised, category, weight)).select(
        "category",
        F.lit(0).alias("ord"),
        F.concat(F.lit("Category "), F.col("category").cast("string"), F.lit(": "), "title").alias("line"),
        F.lit("").alias("File"),
    )
    titles = categorised.select(
        F.col(category).alias("category"),
        F.lit(1).alias("ord"),
        F.concat(F.lit("\t"), "Title").alias("line"),
        "File",
    )
    # A row per category. In one partition it shares no partitioning with the
    # titles, which the union could otherwise wrongly claim for its rows.
    return heads.repartition(1).unionByName(titles)


def sort_summary(lines: DataFrame, collation: str | None = None) -> DataFrame:
    """Sort by category, header first, then title.

    The sort ranges over all columns, so one large category, or one title shared
    by many documents, spreads over many tasks. ``collation`` (such as
    ``UNICODE``) asks for a linguistic order.
    """
    line = F.col("line")
    keys = ["category", "ord", *([F.collate(line, collation)] if collation else []), "line", "File"]
    return lines.orderBy(*keys)


def numbered_summary(lines: DataFrame) -> DataFrame:
    """The lines with ``position``, their place in reading order."""
    return number_rows(lines, [], ["category", "ord", "line", "File"], "position")
