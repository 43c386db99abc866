"""License scan by diagonal voting.

Every run of consecutive words of a text is hashed and joined to the places of the same run in the license templates.
A hit votes for its diagonal, the place in the text less the place in the template: the words of a copy lie on one
diagonal, and words put in or left out move the rest to a neighbouring one. Votes are added up by text, template and
diagonal before they are shuffled, neighbouring diagonals are merged, and a span counts by the share of the template's
words that its hits cover. Words are compared with those of the template where hashes meet, so no collision counts.

Templates of ``RUN`` words or more vote by runs of ``RUN`` words; shorter ones and phrases by pairs, on one diagonal each.
The hits of a text are found in the row of the text, which is read once; each text sends one row on, and one for each
diagonal with a vote. The templates are the only broadcast; a list of more than ``MOST_WORDS`` words in all is shuffled
instead.

Words are runs of ASCII letters and digits and of all further characters, in lower case. Null and empty texts have no
words and no spans. Texts are read whole, however long; the votes of a text are no more than its words times the places
of a run in the templates. Repeated rows and rows of equal or null id are each scanned and each give a row. Labels are
sorted, so ties do not matter. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Words of a run of a long template and of a phrase.
RUN, PAIR = 3, 2
#: Diagonals of a long template that are this close are merged.
NEAR = 4
#: A span counts if it covers this share of its template.
COVERED = 0.75
#: Words of all templates up to which they are broadcast.
MOST_WORDS = 100_000

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words that point to a license. A phrase must stand as it is, other templates may be changed a little."""

    label: str
    text: str
    phrase: bool = False


# The phrases of the base rule.
PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)

# Wordings of common licenses and of the notices that name them.
NOTICES = (
    Template("mit", "released under the mit license"),
    Template("mit", (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions"
    )),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("apache", (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org "
        "licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied"
    )),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version"
    )),
    Template("lgpl", (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation"
    )),
    Template("bsd", (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"
    )),
    Template("isc", (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies"
    )),
    Template("mpl", (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
        "with this file you can obtain one at http mozilla org mpl 2 0"
    )),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
)

TEMPLATES = PHRASES + NOTICES


def words_of(text):
    """The words of a text column, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAPS), "")


def _run_length(template: Template) -> int:
    n_words = len(template.text.split())
    if n_words < PAIR:
        raise ValueError(f"a template needs {PAIR} words: {template.text!r}")
    return PAIR if template.phrase or n_words < RUN else RUN


def _places(spark, templates) -> dict[int, DataFrame]:
    """By run length: (hash, places), where places lists (template, at, words) of each run with that hash."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(" ".join(t.text.split())).alias("text"), F.lit(_run_length(t)).alias("run")) for i, t in enumerate(templates)]
    listed = spark.range(1).select(F.inline(F.array(*rows))).withColumn("all", F.split("text", " "))
    runs = listed.select("template", "run", "all", F.explode(F.sequence(F.lit(0), F.size("all") - F.col("run"))).alias("at"))
    runs = runs.select("template", "run", "at", F.slice("all", F.col("at") + 1, F.col("run")).alias("words"))
    bounded = sum(len(t.text.split()) for t in templates) <= MOST_WORDS
    found = {}
    for run in (PAIR, RUN):
        key = F.xxhash64(*(F.get("words", F.lit(i)) for i in range(run)))
        table = runs.filter(F.col("run") == run).groupBy(key.alias(f"hash{run}"))
        table = table.agg(F.collect_list(F.struct("template", "at", "words")).alias(f"places{run}"))
        found[run] = F.broadcast(table) if bounded else table
    return found


def votes(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(row, doc_id, n_words, template, diagonal, hits) of each text; a text without votes has a row of null template.

    ``hits`` are the places in the template that voted, each once.
    """
    places = _places(docs.sparkSession, templates)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("w0"))
    texts = texts.withColumn("n_words", F.size("w0").cast("long"))
    for i in range(1, RUN):
        texts = texts.withColumn(f"w{i}", F.slice("w0", F.lit(i + 1), F.size("w0")))
    w = [f"w{i}" for i in range(RUN)]
    runs = texts.select("row", "doc_id", "n_words", F.posexplode_outer(F.arrays_zip(*w)).alias("at", "run"))
    runs = runs.select("row", "doc_id", "n_words", "at", *(F.col("run")[x].alias(x) for x in w))
    for run in (PAIR, RUN):
        runs = runs.withColumn(f"hash{run}", F.xxhash64(*w[:run])).join(places[run], f"hash{run}", "left")
    # The first run of a text stands for it, also without a hit.
    kept = runs.filter(F.expr(f"places{PAIR} IS NOT NULL OR places{RUN} IS NOT NULL OR at IS NULL OR at = 0"))
    none = F.array().cast(kept.schema[f"places{RUN}"].dataType)

    def met(run):
        return F.filter(F.coalesce(f"places{run}", none), lambda place: place["words"] == F.array(*w[:run]))

    hits = kept.select("row", "doc_id", "n_words", "at", F.explode_outer(F.concat(met(PAIR), met(RUN))).alias("hit"))
    diagonal = F.when(F.col("hit").isNotNull(), F.col("at") - F.col("hit.at"))
    by = ["row", "doc_id", "n_words", F.col("hit.template").alias("template"), diagonal.alias("diagonal")]
    return hits.groupBy(*by).agg(F.collect_set("hit.at").alias("hits"))


def spans(found: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(row, doc_id, n_words, spans): of each text its spans by place, as (label, phrase, start, end, score).

    ``score`` is the share of the template's words that the hits of the span cover.
    """
    lengths = [len(t.text.split()) for t in templates]
    per = lambda values: F.get(F.array(*map(F.lit, values)), F.col("template"))
    run = per([_run_length(t) for t in templates])
    near = per([0 if t.phrase else NEAR for t in templates])
    text = ["row", "doc_id", "n_words"]
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    starts = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > near, F.lit(True))
    merged = found.withColumn("starts", starts.cast("int")).withColumn("span", F.sum("starts").over(order))
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda at: F.sequence(at, at + run - 1))))
    lines = merged.withColumn("covered", covered).withColumn("first", F.col("diagonal") + F.array_min("hits"))
    lines = lines.withColumn("last", F.col("diagonal") + F.array_max("hits") + run - 1)
    cover = F.size(F.array_distinct(F.flatten(F.collect_list("covered"))))
    each = lines.groupBy(*text, "template", "span").agg(F.min("first").alias("start"), F.max("last").alias("end"), cover.alias("cover"))
    span = F.struct(
        F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        per([t.label for t in templates]).alias("label"), per([t.phrase for t in templates]).alias("phrase"),
        (F.col("cover") / per(lengths)).alias("score"),
    )
    return each.groupBy(*text).agg(F.sort_array(F.collect_list(F.when(F.col("template").isNotNull(), span))).alias("spans"))


def scan(docs: DataFrame, templates=TEMPLATES, covered: float = COVERED) -> DataFrame:
    """A row for each row of (doc_id, text): doc_id, n_words, spans that count, score of the best span of all.

    A phrase counts if it stands whole, another template if a span covers the share ``covered`` of it.
    """
    found = spans(votes(docs, templates), templates)
    counts = F.filter("spans", lambda s: s["score"] >= F.when(s["phrase"], 1.0).otherwise(covered))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0))
    return found.select("doc_id", "n_words", counts.alias("spans"), best.alias("score"))


def _labels(of):
    return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and labels of the phrases, and the labels of all templates."""
    base = F.filter("spans", lambda s: s["phrase"])
    begins = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(begins).alias("first_word"), F.array_max(begins).alias("last_word"),
        _labels(base).alias("base_labels"), _labels(F.col("spans")).alias("labels"), "score",
    )


def sql(templates=TEMPLATES) -> str:
    rows = ", ".join(f"({i}, '{t.label}', '{t.text}', {t.phrase})" for i, t in enumerate(templates))
    return rf"""
WITH t AS (SELECT template, label, string_split(text, ' ') AS words, phrase FROM (VALUES {rows}) v(template, label, text, phrase)),
l AS (SELECT *, len(words) AS n, CASE WHEN phrase OR len(words) < {RUN} THEN {PAIR} ELSE {RUN} END AS run FROM t),
g AS (SELECT template, run, pos, words[pos + 1 : pos + run] AS gram FROM (SELECT *, unnest(range(0, n - run + 1)) AS pos FROM l)),
d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id,
    list_filter(string_split_regex(lower(coalesce(text, '')), '{GAPS}'), lambda w: w <> '') AS words FROM documents),
u AS (SELECT row, unnest(words) AS w0, generate_subscripts(words, 1) - 1 AS pos FROM d),
r AS (SELECT *, lead(w0, 1) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM u WINDOW o AS (PARTITION BY row ORDER BY pos)),
h AS (SELECT r.row, g.template, r.pos - g.pos AS diagonal, g.pos, g.run FROM r JOIN g ON g.run = 2 AND g.gram[1] = r.w0 AND g.gram[2] = r.w1
    UNION ALL SELECT r.row, g.template, r.pos - g.pos, g.pos, g.run FROM r JOIN g ON g.run = 3 AND g.gram[1] = r.w0 AND g.gram[2] = r.w1 AND g.gram[3] = r.w2),
s AS (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY row, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM
    (SELECT q.*, coalesce(q.diagonal - lag(q.diagonal) OVER (PARTITION BY q.row, q.template ORDER BY q.diagonal) > CASE WHEN l.phrase THEN 0 ELSE {NEAR} END, true) AS gap
        FROM (SELECT DISTINCT row, template, diagonal FROM h) q JOIN l USING (template))),
c AS (SELECT row, template, span, min(diagonal + pos) AS start, count(DISTINCT place) AS covered FROM
    (SELECT s.row, s.template, s.span, s.diagonal, h.pos, unnest(range(h.pos, h.pos + h.run)) AS place FROM h JOIN s USING (row, template, diagonal)) GROUP BY ALL),
f AS (SELECT c.row, c.start, l.label, l.phrase, c.covered / l.n AS score FROM c JOIN l USING (template)),
a AS (SELECT row, count(*) FILTER (phrase AND score = 1) AS n_base, min(start) FILTER (phrase AND score = 1) AS first_word, max(start) FILTER (phrase AND score = 1) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase AND score = 1) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (score >= CASE WHEN phrase THEN 1 ELSE {COVERED} END) AS labels, max(score) AS score FROM f GROUP BY row)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, coalesce(score, 0) AS score FROM d LEFT JOIN a USING (row)
"""


SQL = sql()
