"""Quality rules: base counts and the divergence of a document from its language.

Each document gives two histograms: character classes (and the bytes by which its characters are wider than one), and the common words of its language against all others. A
language's reference is the sum of these histograms over all of its documents that are long enough and hold few
symbols. A document goes if the Jensen-Shannon distance of its classes to the reference (base 2, from 0 to 1) is above
``CLASS_DISTANCE``, or if both distances are above the lower pair ``BOTH_DISTANCES``. Small histograms scatter, so
each rule has a guard: the least number of words. ``BANDS`` adds rules by length, in which the word distance can reject
alone, and classes are judged in every language: a null or rare one, with fewer than ``RARE`` documents in the reference
or less than one in ``MOST_LANGUAGES``, is held against the whole corpus. Without ``bands`` languages without a list of
common words are not judged this way. The base rules hold for all. The thresholds lie above all documents labelled good
in sf0.01, sf0.1 and check_s.

Everything is a column expression over one row; the reference has at most ``MOST_LANGUAGES`` rows, so it is safe to
broadcast. Rows keep their multiplicity and their ids, null or not. A null or empty text counts as having no words; a very long one is
measured whole; an empty table has no references and gives no rows. Clashing columns of the input are not read; ``judge`` needs only the id, text and language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import GAP, fresh, stored, where_computed

# Common words by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "with", "on", "as", "was"],
    "de": ["der", "die", "und", "den", "das", "von", "zu", "mit", "ist", "ein", "nicht", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "que", "pour", "dans"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "con"],
}
#: A character of a word.
WORD_START = GAP.replace("[", "[^")
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
CLASS_DISTANCE = 0.3
#: Of classes and words together, for documents of at least so many words.
BOTH_DISTANCES = (0.18, 0.24)
BOTH_WORDS = 100
#: From so many words on: most of the class distance, of the word distance, and of both together.
BANDS = (
    (50, 0.28, 0.296, (0.14, 0.275)),
    (75, 0.24, 0.29, (0.2, 0.2)),
    (100, 0.22, 0.27, (0.15, 0.235)),
    (200, 0.215, 0.24, (0.15, 0.235)),
    (300, 0.195, 0.21, (0.15, 0.2)),
    (1000, 0.17, 0.12, (0.15, 0.1)),
)
#: Fewest documents of a language with a reference of its own, and most of such languages.
RARE = 20
MOST_LANGUAGES = 10_000


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeats(df: DataFrame, words: str) -> DataFrame:
    """Adds the number of words inside three-word windows that occur twice or more."""
    grams, placed = fresh(df, "_grams"), fresh(df, "_placed")
    w = F.col(words)
    df = df.withColumn(
        grams,
        F.when(F.size(w) >= 3, F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<string>")),
    )
    # Most texts repeat nothing and need no sort.
    df = df.withColumn(
        placed,
        F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))),
    )
    p = F.col(placed)
    same = lambda x, other: F.coalesce(other["g"] == x["g"], F.lit(False))
    twice = F.filter(p, lambda x, j: same(x, F.get(p, j - 1)) | same(x, F.get(p, j + 1)))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(grams, placed)


def measures(df: DataFrame, text_col: str = "text", lang_col: str = "lang", repeats: bool = True) -> DataFrame:
    """``df`` with the counts of the base rules, ``classes`` and ``common`` (histograms).

    Columns of these names must not be in ``df``.
    """
    text, lines, words = (fresh(df, n) for n in ("_text", "_lines", "_words"))
    t = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn(text, t).withColumn(words, F.array_remove(F.split(text, GAP + "+"), ""))
    df = df.withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_START)))
    df = (
        df.withColumn("n_words", F.size(words).cast("long"))
        .withColumn("word_chars", F.length(F.array_join(words, "")).cast("long"))
        .withColumn("n_symbols", _count(F.col(text), SYMBOLS).cast("long"))
        .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
        .drop(lines)
    )
    if repeats:
        df = _repeats(df, words)
    sparse = [_count(F.col(text), p).cast("long") for p in ("[A-Z]", "[0-9]", "[.,;:!?]")]
    wide = (F.octet_length(text) - F.length(text)).cast("long")
    blank = F.length(text).cast("long") - F.col("word_chars")
    rest = F.length(text).cast("long") - blank - F.col("n_symbols") - sum(sparse[1:], sparse[0])
    lists = [[F.lit(x) for x in COMMON_WORDS[lang]] for lang in COMMON_WORDS]
    own = F.when(F.lit(False), F.array(*lists[0]))
    for lang, entries in zip(COMMON_WORDS, lists, strict=True):
        own = own.when(F.col(lang_col) == lang, F.array(*entries))
    common = fresh(df, "_common")
    df = df.withColumn(common, own)
    hits = [(F.size(words) - F.size(F.array_remove(words, F.get(common, F.lit(i))))).cast("long") for i in range(len(lists[0]))]
    return (
        df.withColumn("classes", F.array(blank, F.col("n_symbols"), *sparse, wide, rest))
        .withColumn("common", F.when(F.col(common).isNotNull(), F.array(*hits)))
        .drop(common, words, text)
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _measured(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return measures(df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), repeats=False)


def references(m: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each language with a word list: its summed histograms and words, over all measured documents.

    Documents under the guard, or with a symbol for every ten words or more, say nothing about their language.
    """
    m = where_computed(m, F.col("lang").isin(*COMMON_WORDS) & (F.col("n_words") >= min_words) & (10 * F.col("n_symbols") < F.col("n_words")))
    total = lambda name, n: F.array(*(F.sum(F.get(name, F.lit(i))) for i in range(n)))
    return m.groupBy(F.col("lang").alias("ref_lang")).agg(
        total("classes", 7).alias("ref_classes"), total("common", 12).alias("ref_common"), F.sum("n_words").alias("ref_words")
    )


def all_references(m: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """As :func:`references`, of every language that is not rare, and one row (whole_classes) of the whole corpus."""
    m = where_computed(m, (F.col("n_words") >= min_words) & (10 * F.col("n_symbols") < F.col("n_words")))
    total = lambda name, n: F.array(*(F.sum(F.get(name, F.lit(i))) for i in range(n)))
    by_lang = m.groupBy(F.col("lang").alias("ref_lang")).agg(
        total("classes", 7).alias("ref_classes"), total("common", 12).alias("ref_common"), F.sum("n_words").alias("ref_words"), F.count("*").alias("docs")
    )
    by_lang = stored(by_lang, "language-references")
    whole = by_lang.agg(total("ref_classes", 7).alias("whole_classes"), F.sum("docs").alias("all_docs"))
    own = by_lang.filter(F.col("ref_lang").isNotNull() & (F.col("docs") >= RARE)).crossJoin(F.broadcast(whole.select("all_docs")))
    return own.filter(F.col("docs") * MOST_LANGUAGES >= F.col("all_docs")).drop("docs", "all_docs"), whole.drop("all_docs")


def _of_band(bands: tuple, pick) -> Column:
    """The threshold for the number of words of a row; null below the first band."""
    found = F.when(F.lit(False), F.lit(0.0))
    for band in sorted(bands, reverse=True):
        found = found.when(F.col("n_words") >= band[0], F.lit(pick(band)))
    return found


def distance(own: Column, own_total: Column, ref: Column, ref_total: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms given as arrays of counts."""

    def part(a: Column, b: Column) -> Column:
        p, q = a / own_total, b / ref_total
        m = (p + q) / 2
        one, two = (F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0)) for x in (p, q))
        return one + two

    return F.sqrt(F.greatest(F.aggregate(F.zip_with(own, ref, part), F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _sum(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)


def judge(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_words: int = MIN_WORDS, class_distance: float = CLASS_DISTANCE, both_distances: tuple[float, float] = BOTH_DISTANCES, both_words: int = BOTH_WORDS, bands: tuple = BANDS) -> DataFrame:
    """``df`` with the base counts, the two distances (null where not judged), ``base_failed`` and ``kept``.

    Texts are measured once for the references and once for their own verdict, so that rows need not be stored.
    """
    ref = _measured(df, text_col, lang_col)
    return verdicts(measures(df, text_col, lang_col), ref, lang_col, min_words, class_distance, both_distances, both_words, bands)


def judge_stored(df: DataFrame, text_col: str = "text", lang_col: str = "lang", **rules) -> DataFrame:
    """As :func:`judge` without the texts: their measures are stored, small as they are, and each text is read once."""
    m = stored(measures(df, text_col, lang_col).drop(text_col), "measures")
    return verdicts(m, m.withColumnRenamed(lang_col, "lang"), lang_col, **rules)


def verdicts(m: DataFrame, of: DataFrame, lang_col: str = "lang", min_words: int = MIN_WORDS, class_distance: float = CLASS_DISTANCE, both_distances: tuple[float, float] = BOTH_DISTANCES, both_words: int = BOTH_WORDS, bands: tuple = BANDS) -> DataFrame:
    """Measured rows ``m`` with distances to the references of the measured rows ``of`` and verdicts, without the histograms."""
    ref, whole = all_references(of, min_words) if bands else (references(of, min_words), None)
    m = m.join(F.broadcast(ref), m[lang_col] == ref["ref_lang"], "left")
    if bands:
        m = m.crossJoin(F.broadcast(whole)).withColumn("ref_classes", F.coalesce("ref_classes", "whole_classes")).drop("whole_classes")
    judged = F.get("ref_classes", F.lit(0)).isNotNull() & (F.col("n_words") >= min_words)
    others = lambda counts, total: F.concat(counts, F.array(total - _sum(F.col(counts))))
    classes = distance(F.col("classes"), _sum(F.col("classes")), F.col("ref_classes"), _sum(F.col("ref_classes")))
    words = distance(others("common", F.col("n_words")), F.col("n_words"), others("ref_common", F.col("ref_words")), F.col("ref_words"))
    m = m.withColumn("class_distance", F.when(judged, classes)).withColumn("word_distance", F.when(judged & F.col("common").isNotNull() & F.col("ref_words").isNotNull(), words))
    both = (F.col("n_words") >= both_words) & (F.col("class_distance") > both_distances[0]) & (F.col("word_distance") > both_distances[1])
    far = F.coalesce((F.col("class_distance") > class_distance) | both, F.lit(False))
    if bands:
        above = lambda name, pick: F.coalesce(F.col(name) > _of_band(bands, pick), F.lit(False))
        far = far | above("class_distance", lambda b: b[1]) | above("word_distance", lambda b: b[2])
        far = far | (above("class_distance", lambda b: b[3][0]) & above("word_distance", lambda b: b[3][1]))
    # Verdicts read a column that is not deterministic: a filter on them stays above the counts.
    row = fresh(m, "_row")
    known = F.col(row) >= 0
    return (
        m.withColumn(row, F.monotonically_increasing_id())
        .withColumn("base_failed", base_failed() & known)
        .withColumn("kept", known & ~base_failed() & ~far)
        .drop(row, "classes", "common", "ref_lang", "ref_classes", "ref_common", "ref_words")
    )


_S = r"[\x20\x09-\x0D]"
_LISTS = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in COMMON_WORDS.items()) + " END"
_COUNT = r"length(t) - length(regexp_replace(t, '{}', '', 'g'))"
_JS = "sqrt(greatest(list_sum(list_transform(list_zip({a}, {b}), lambda z: (CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END) + (CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END))) / 2, 0))"


def _sql_band(*at) -> str:
    def pick(band):
        for i in at:
            band = band[i]
        return band

    return "CASE " + " ".join(f"WHEN n_words >= {band[0]} THEN {pick(band)}" for band in sorted(BANDS, reverse=True)) + " END"


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM g),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM h, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
m AS (SELECT w.r, doc_id, lang, len(words) AS n_words, list_sum(list_transform(words, lambda x: length(x))) AS chars,
    {_COUNT.format(SYMBOLS)} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    length(t) AS n_chars, {_COUNT.format('[A-Z]')} AS u, {_COUNT.format('[0-9]')} AS dg, {_COUNT.format('[.,;:!?]')} AS st,
    strlen(t) - length(t) AS wide, strlen(t) AS n_bytes,
    list_transform({_LISTS}, lambda x: len(list_filter(words, lambda y: y = x))) AS common FROM w LEFT JOIN c USING (r)),
n AS (SELECT *, coalesce(chars, 0)::BIGINT AS word_chars,
    [n_chars - coalesce(chars, 0), n_symbols, u, dg, st, wide, coalesce(chars, 0) - n_symbols - u - dg - st] AS classes FROM m),
f AS (SELECT * FROM n WHERE n_words >= {MIN_WORDS} AND 10 * n_symbols < n_words),
s AS (SELECT lang, count(*) AS docs, sum(n_words) AS ref_words,
    {', '.join(f'sum(classes[{i}]) AS c{i}' for i in range(1, 8))}, {', '.join(f'sum(common[{i}]) AS w{i}' for i in range(1, 13))} FROM f GROUP BY lang),
a AS (SELECT sum(docs) AS all_docs, {', '.join(f'sum(c{i}) AS a{i}' for i in range(1, 8))} FROM s),
o AS (SELECT s.* FROM s CROSS JOIN a WHERE lang IS NOT NULL AND docs >= {RARE} AND docs * {MOST_LANGUAGES} >= all_docs),
j AS (SELECT n.*, ref_words, [{', '.join(f'coalesce(c{i}, a{i})' for i in range(1, 8))}] AS rc, [{', '.join(f'w{i}' for i in range(1, 13))}] AS rw,
    n_words >= {MIN_WORDS} AND a1 IS NOT NULL AS judged FROM n LEFT JOIN o USING (lang) CROSS JOIN a),
p AS (SELECT *, list_transform(classes, lambda x: x / n_bytes) AS p1, list_transform(rc, lambda x: x / list_sum(rc)) AS q1,
    list_transform(list_append(common, n_words - list_sum(common)::BIGINT), lambda x: x / n_words) AS p2,
    list_transform(list_append(rw, ref_words - list_sum(rw)), lambda x: x / ref_words) AS q2 FROM j),
x AS (SELECT *, CASE WHEN judged THEN {_JS.format(a='p1', b='q1')} END AS dc,
    CASE WHEN judged AND common IS NOT NULL AND ref_words IS NOT NULL THEN {_JS.format(a='p2', b='q2')} END AS dw FROM p),
k AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    coalesce(dc > {CLASS_DISTANCE}, false) OR coalesce(n_words >= {BOTH_WORDS} AND dc > {BOTH_DISTANCES[0]} AND dw > {BOTH_DISTANCES[1]}, false)
        OR coalesce(dc > {_sql_band(1)}, false) OR coalesce(dw > {_sql_band(2)}, false) OR coalesce(dc > {_sql_band(3, 0)} AND dw > {_sql_band(3, 1)}, false) AS far FROM x)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
    n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept FROM k
"""
