import random

from pyspark.sql import functions as F

from topicloom.functions.headings import heading_slots, slot_columns, top_headings
from topicloom.operators.headings import dedup_headings, fill_headings, rank_headings
from topicloom.schemas import HEADINGS

CASE = [
    (0, "Getting started"), (1, "Getting started"), (2, "Install"), (2, 'Configure the "tool"'),
    (3, "API"), (2, "Install"), (3, "Overview"), (3, "Examples of use"), (4, "Deep section"),
]
WANT = ["Getting started", "Configure the tool", "Install", "Examples of use", "Overview", None]


def by_rules(found):
    """The rules, one after the other, in plain Python."""
    distinct = list(dict.fromkeys(found))
    kept = [h for h in distinct if not any(o[1] == h[1] and o[0] > h[0] for o in found)]
    kept = sorted(kept, key=lambda h: (h[0], -len(h[1])))[:6]
    shown = [t for t in (h[1].strip().replace('"', "") for h in kept) if len(t) >= 5]
    return shown + [None] * (6 - len(shown))


def array_form(spark, cases):
    df = spark.createDataFrame(
        list(cases.items()), "File string, headings array<struct<level:int,text:string>>"
    )
    slots = df.select("File", heading_slots(top_headings("headings")).alias("slots"))
    return {r[0]: list(r)[1:] for r in slots.select("File", *slot_columns("slots")).collect()}


def row_form(spark, cases):
    rows = [(f, i, lv, t) for f, hs in cases.items() for i, (lv, t) in enumerate(hs)]
    df = spark.createDataFrame(rows, "File string, pos int, level int, text string")
    filled = fill_headings(rank_headings(dedup_headings(df)))
    return {r["File"]: [r[n] for n in HEADINGS] for r in filled.collect()}


def test_worked_case(spark):
    assert by_rules(CASE) == WANT
    assert array_form(spark, {"a": CASE})["a"] == WANT
    assert row_form(spark, {"a": CASE})["a"] == WANT


def test_random_cases_agree(spark):
    rng = random.Random(5)
    texts = ["alpha", "beta x", "gamma ray", 'q"uote', "abcde", "vwxyz", "no", "delta force"]
    cases = {
        f"f{i}": [(rng.randint(0, 4), rng.choice(texts)) for _ in range(rng.randint(1, 15))]
        for i in range(200)
    }
    want = {f: by_rules(hs) for f, hs in cases.items()}
    assert array_form(spark, cases) == want
    assert row_form(spark, cases) == want


def test_no_heading_gives_no_slot(spark):
    assert array_form(spark, {"a": []})["a"] == [None] * 6


def test_many_headings_in_one_document(spark):
    df = spark.range(1).select(
        F.transform(
            F.sequence(F.lit(1), F.lit(100_000)),
            lambda i: F.struct(
                (i % 6 + 1).cast("int").alias("level"), F.concat(F.lit("heading "), i % 5000).alias("text")
            ),
        ).alias("h")
    )
    assert len(df.select(top_headings("h").alias("t")).first().t) == 6
