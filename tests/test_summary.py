from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from topicloom.operators import summary

ROWS = [
    ("a.md", "Azure - Data Lake", "data lake azure", 1),
    ("b.md", "Azure Data", "data store", 1),
    ("c.md", "Other thing", "thing", 2),
    ("d.md", "12 # thing", "thing  other", 2),
    ("e.md", "Azure - Data Lake", "lake", 1),
]


def rows(spark, data=ROWS):
    return spark.createDataFrame(data, "File string, Title string, Top20Words string, PredictedLabel int")


def named(data):
    """Category names by the definition, in plain Python."""
    seen = defaultdict(dict)
    for _, title, top, label in sorted(data):
        found = top.replace('"', "").split(" ")
        parts = title.replace('"', "").split(" ")
        found += [" ".join(parts[: i + 1]) for i, p in enumerate(parts) if any(c.isalpha() and c.isascii() or c == "'" for c in p)]
        for phrase in found:
            if phrase.strip():
                seen[label][phrase] = seen[label].get(phrase, 0) + 1
    names = {}
    for label, counts in seen.items():
        best = sorted(counts.items(), key=lambda x: (-x[1], -(len(x[0].split(" ")) ^ 2 * x[1])))[:10]
        names[label] = ",".join(w for w, _ in sorted(best, key=lambda x: -len(x[0])))
    return names


def test_title_prefixes(spark):
    df = summary.title_prefixes(rows(spark).select("File", "Title"))
    got = [r.phrase for r in df.filter("File = 'a.md'").orderBy("pos").collect()]
    assert got == ["Azure", "Azure - Data", "Azure - Data Lake"]
    assert [r.phrase for r in df.filter("File = 'd.md'").collect()] == ["12 # thing"]


@pytest.mark.parametrize(
    "parts, count, want", [(1, 1, 3), (2, 1, 0), (3, 1, 1), (4, 1, 6), (1, 2, 5), (2, 2, 6), (3, 2, 7), (4, 2, 0)]
)
def test_weight(spark, parts, count, want):
    df = spark.createDataFrame([(" ".join("x" * parts), count)], "p string, n bigint")
    assert df.select(summary.phrase_weight("p", "n")).first()[0] == want


@pytest.mark.parametrize("partitions", [1, 5])
def test_names_against_definition(spark, partitions):
    data = ROWS + [(f"x{i}.md", f"Word{i % 7} part{i % 3} tail", f"word{i % 5} tail", i % 3) for i in range(60)]
    ranked = summary.rank_phrases(summary.phrase_counts(summary.phrases(rows(spark, data).repartition(partitions))))
    got = {r.category: r.title for r in summary.category_titles(ranked).collect()}
    assert got == named(data)


def test_long_titles_make_one_prefix_per_row(spark):
    df = spark.createDataFrame([("f", "word " * 3000)], "File string, Title string")
    found = summary.title_prefixes(df)
    assert found.count() == 3000 and found.agg(F.max(F.length("phrase"))).first()[0] == 3000 * 5 - 1


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_of_whole_categories(spark, partitions):
    data = [(f"x{i}.md", f"Word{i % 7} part{i % 3} tail", f"word{i % 5} tail", i % 3) for i in range(200)]
    counts = summary.phrase_counts(summary.phrases(rows(spark, data).repartition(partitions)))
    want = {(r.category, r.phrase): r.rn for r in summary.rank_phrases(counts).collect()}
    got = {(r.category, r.phrase): r.rn for r in summary.rank_all_phrases(counts).collect()}
    assert got == want


def test_positions_follow_the_order(spark):
    lines = summary.summary_lines(rows(spark))
    placed = [r.line for r in summary.numbered_summary(lines).orderBy("position").collect()]
    assert placed == [r.line for r in summary.sort_summary(lines).collect()]


def test_summary_order(spark):
    lines = [r.line for r in summary.sort_summary(summary.summary_lines(rows(spark))).collect()]
    names = named(ROWS)
    assert lines == [
        f"Category 1: {names[1]}", "\tAzure - Data Lake", "\tAzure - Data Lake", "\tAzure Data",
        f"Category 2: {names[2]}", "\t12 # thing", "\tOther thing",
    ]


def test_linguistic_order(spark):
    data = [("a", "beta", "x", 1), ("b", "Alpha", "x", 1), ("c", "Ähnlich", "x", 1)]
    lines = summary.sort_summary(summary.summary_lines(rows(spark, data)), "UNICODE")
    assert [r.line for r in lines.collect()][1:] == ["\tÄhnlich", "\tAlpha", "\tbeta"]


def test_marks_count_the_same_phrases_as_texts(spark):
    titles = ["a - b - c", "a b c", "a b", "7 a  b", "a", "", None, "é a b c d e", 'say "a b" now', "a - b - c"]
    data = [(i % 2 + 1, f"f{i // 2}.md", t, w) for i, (t, w) in enumerate(zip(titles * 3, ["a b", "c  a", "", None, "now", "b"] * 5))]
    df = spark.createDataFrame(data, "PredictedLabel int, File string, Title string, Top20Words string").repartition(3)
    want = {(r.category, r.phrase, r.cnt, r.first_seen) for r in summary.phrase_counts(summary.phrases(df)).collect()}
    found = summary.with_phrases(summary.marked_counts(summary.marked_phrases(df)), df).collect()
    assert {(r.category, r.phrase, r.cnt, r.first_seen) for r in found} == want and len(found) == len(want)


def test_a_long_title_costs_a_row_of_fixed_size_a_part(spark):
    n = 50_000
    df = spark.createDataFrame([(1, "f", " ".join(f"word{i}" for i in range(n)), "x y")], "PredictedLabel int, File string, Title string, Top20Words string")
    found = summary.marked_counts(summary.marked_phrases(df))
    assert found.count() == n + 2
    best = summary.best_phrases(df, k=3).collect()
    assert len(best) == 3 and all(len(r.phrase) < 40 * r.rn * n for r in best)
