import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from topicloom.functions.sql import register_functions
from topicloom.operators import terms
from topicloom.operators.skew import join_salted, join_weighted
from topicloom.plans.rank import model_input, register_views
from topicloom.schemas import DOCS, MODEL_INPUT

WORKED = [("d1", "spark spark join"), ("d2", "spark window"), ("d3", "join")]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "File string, Words string")


def full_docs(spark, rows):
    filled = [(f, t, *[None] * 5, w) for f, t, w in rows]
    return spark.createDataFrame(filled, DOCS)


def brute_force(rows, k=20, stop=()):
    """Top words by the definition, in plain Python."""
    counts = defaultdict(Counter)
    for file, words in rows:
        if words:
            counts[file].update(words.lower().split(" "))
    df = Counter(w for c in counts.values() for w in c)
    top = {}
    for file, c in counts.items():
        scored = [
            (-(math.log(len(rows) + 1) / (df[w] + 1)) * n, w)
            for w, n in c.items()
            if len(w) >= 4 and w not in stop
        ]
        top[file] = [w for _, w in sorted(scored)[:k]]
    return {f: t for f, t in top.items() if t}, {f: sum(c.values()) for f, c in counts.items()}


def random_rows(n, seed=3, hot=None):
    import random

    rng = random.Random(seed)
    vocabulary = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(n):
        words = [vocabulary[min(int(rng.expovariate(0.02)), 299)] for _ in range(rng.randint(0, 60))]
        file = hot if hot and rng.random() < 0.4 else f"f{i}"
        rows.append((file, " ".join(words)))
    return rows


def test_worked_scores(spark):
    docs = docs_of(spark, WORKED)
    got = {
        (r.File, r.word): (r["count"], r.docFrequency, r[terms.SCORE])
        for r in terms.tf_idf(terms.term_frequency(docs), docs).collect()
    }
    idf2, idf1 = math.log(4) / 3, math.log(4) / 2
    assert got == {
        ("d1", "spark"): (2, 2, idf2 * 2), ("d1", "join"): (1, 2, idf2), ("d2", "window"): (1, 1, idf1),
        ("d2", "spark"): (1, 2, idf2), ("d3", "join"): (1, 2, idf2),
    }


def test_empty_words_count_in_the_corpus_only(spark):
    docs = docs_of(spark, [*WORKED, ("d4", None), ("d5", "")])
    assert terms.corpus_size(docs).first().total == 5
    assert {r.File for r in terms.word_counts(docs).collect()} == {"d1", "d2", "d3"}
    assert terms.term_frequency(docs).filter("word = ''").count() == 0


@pytest.mark.parametrize("hot", [None, "hot"])
@pytest.mark.parametrize("partitions", [1, 8])
def test_top_words_against_brute_force(spark, hot, partitions):
    rows = random_rows(300, hot=hot)
    docs = docs_of(spark, rows).repartition(partitions)
    want, counts = brute_force(rows)
    got = {r.File: r.Top20Words.split(" ") for r in
           terms.joined_top_words(terms.top_words(terms.filtered_scores(docs))).collect()}
    assert got == want
    assert {r.File: r.WordCount for r in terms.word_counts(docs).collect()} == counts


def test_stop_words_from_a_table(spark):
    listed = spark.createDataFrame([("spark",)], "word string")
    docs = docs_of(spark, WORKED)
    left = terms.drop_stop_words(terms.words(docs), listed)
    assert {r.word for r in left.collect()} == {"join", "window"}


def test_scores_with_a_listed_table(spark):
    rows = random_rows(300, hot="hot")
    listed = [("wordaa",), ("wordba",), ("wordzz",)]
    table = spark.createDataFrame(listed, "word string")
    want, _ = brute_force(rows, stop={w for (w,) in listed})
    top = terms.top_words(terms.filtered_scores(docs_of(spark, rows), table))
    got = {r.File: r.Top20Words.split(" ") for r in terms.joined_top_words(top).collect()}
    assert got == want


def test_long_words_need_a_larger_share(spark):
    long = "x" * 5000
    facts = spark.range(900).select(F.when(F.col("id") % 3 == 0, long).otherwise(F.col("id").cast("string")).alias("key"), "id")
    lookup = facts.groupBy("key").agg(F.count("*").alias("n"))
    for slots in (10, 100, 1000):
        joined = join_weighted(facts, lookup, "key", "n", ["id"], slots)
        assert joined.count() == 900 and joined.filter("n = 300").count() == 300


def test_model_input_keeps_titles_of_a_shared_key(spark):
    rows = [("a", "Title one", "alpha beta"), ("a", "Title two", "beta gamma"), ("a", "Title two", "beta"),
            ("b", "1 2 3", "alpha delta"), ("c", "Only stop", "the and"), ("d", "C# & more!", "omega")]
    got = {(r.File, r.Title): r for r in model_input(full_docs(spark, rows)).collect()}
    assert set(got) == {("a", "Title one"), ("a", "Title two"), ("d", "C    more")}
    assert {r.WordCount for (f, _), r in got.items() if f == "a"} == {5}
    assert got["a", "Title one"].Top20Words == got["a", "Title two"].Top20Words
    assert got["d", "C    more"].ReadingTime == "< 1 minute"
    assert list(got["d", "C    more"].asDict()) == MODEL_INPUT.names


@pytest.mark.parametrize("slots", [1, 4, 50, 10_000])
def test_weighted_join_takes_both_ways(spark, slots):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"), "id"
    )
    lookup = facts.filter("key <> 'k7'").groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    want = {tuple(r) for r in facts.join(lookup, "key").select("key", "id", "n", "m").collect()}
    got = join_weighted(facts, lookup, "key", "n", ["id"], slots).select("key", "id", "n", "m").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("slots", [1, 4, 50, 10_000])
def test_salted_join_equals_plain_join(spark, slots):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"), "id"
    )
    lookup = facts.select("key").distinct().filter("key <> 'k7'").withColumn("v", F.length("key"))
    want = {tuple(r) for r in facts.join(lookup, "key").collect()}
    got = join_salted(facts, lookup, "key", ["id"], slots).select("key", "id", "v").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_hot_key_is_spread(spark):
    facts = spark.range(4000).withColumn("key", F.lit("hot"))
    lookup = spark.createDataFrame([("hot", 1)], "key string, v int")
    plan = join_salted(facts, lookup, "key", ["id"], 100)
    assert plan.count() == 4000


@pytest.mark.parametrize("hot", [None, "hot"])
def test_plan_of_top_words(spark, hot):
    """One explode, term rows shared by their uses, no shuffle of texts, no job before the action."""
    docs = docs_of(spark, random_rows(300, hot=hot))
    tracker, group = spark.sparkContext.statusTracker(), f"plan-{hot}"
    spark.sparkContext.setJobGroup(group, group)
    top = terms.top_words(terms.filtered_scores(docs))
    assert not tracker.getJobIdsForGroup(group)
    top.collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = top._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Generate explode(") == 1
    assert "Union" not in plan
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("Words" in line for line in moved)


def test_functions_by_name(spark):
    register_functions(spark)
    row = spark.sql(
        "SELECT CalculateIdf(2, 3) i, IsStopWord('about') a, IsStopWord('spark') s, CalculateReadingTime(13725) r"
    ).first()
    assert row.i == pytest.approx(math.log(4) / 3)
    assert (row.a, row.s, row.r) == (True, False, "1 hours and 1 minutes")


def test_views(spark):
    register_views(spark, docs_of(spark, WORKED))
    for name in ("docs", "termFrequency", "documentFrequency", "idfJoin", "rollup", "filteredWords", "top20"):
        assert spark.table(name).count() > 0
    assert spark.sql("SELECT total FROM documentFrequency LIMIT 1").first().total == 3


def test_views_share_one_stored_term_table(spark):
    from topicloom.plans.rank import register_views

    docs = spark.createDataFrame([("a.md", "spark joins tables"), ("b.md", "spark spark windows")], "File string, Words string")
    register_views(spark, docs)
    for view in ("termFrequency", "documentFrequency", "idfJoin", "filteredWords", "top20"):
        plan = spark.table(view)._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "explode" not in plan, view
    plan = spark.sql("SELECT * FROM top20 JOIN idfJoin USING (File, word)")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    assert spark.table("top20").count() == 5


def test_terms_leave_the_task_counted(spark):
    from topicloom.operators.terms import term_frequency

    docs = spark.createDataFrame([("a.md", "x y x")], "File string, Words string")
    plan = term_frequency(docs)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "partial_count" in below and "lambda" not in plan
