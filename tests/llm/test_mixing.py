import random

import pytest
from pyspark.sql import functions as F

from topicloom.llm import mixing


def targets(sizes):
    """Targets by filling source after source."""
    order = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full, left = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        rate = (left - sum(full.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if rate * weight[s] > 3 * sizes[s]]
        if not over:
            return full | {s: rate * weight[s] for s in free}
        full |= {s: 3 * sizes[s] for s in over}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = [(i, " ".join(["w"] * rng.randrange(1, 300)), rng.choice(["a", "b", "c", "é", "hot", "hot", "hot", None])) for i in range(3000)]
    made += [(5000, None, "a"), (5001, " \n", "b"), (None, "x y", "c"), (5002, "", "empty")]
    return made + [(6000, "r s t u", "a")] * 50 + [made[3]] * 2


def test_targets_and_words_taken(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.taken_words(mixing.mixture(df)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 300, source
    again = mixing.taken_words(mixing.mixture(df.repartition(5))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_expectation_over_seeds(spark):
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), "a" if i < 40 else "b") for i in range(60)], "doc_id long, text string, source string")
    runs = [{r.doc_id: r.copies for r in mixing.mixture(df, seed=s).collect()} for s in range(12)]
    ratio = {r.doc_id: r.target / r.source_size for r in mixing.mixture(df).collect()}
    mean = sum(sum(r.values()) for r in runs) / 12
    assert mean == pytest.approx(sum(ratio.values()), rel=0.15)
    assert all(abs(r[i] - ratio[i]) < 1 for r in runs for i in ratio)


def test_mixed_rows_repeat_documents(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, source string, _copies int")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    words = {r.source: r.n for r in out.groupBy("source").agg(F.sum(mixing.words_in(F.col("text"))).alias("n")).collect()}
    taken = {r.source: r.n for r in mixing.taken_words(mixing.mixture(df)).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}


def test_very_many_equal_rows(spark):
    """A unit of more rows than a step, one of just a step, and one row: each row once, copies dealt out evenly."""
    n = {None: 3 * mixing.STEP + 7, 1: mixing.STEP, 2: 1}
    units = spark.createDataFrame([(i, 2, rows, 2 * rows + 5, 0, 1.0, "s") for i, rows in n.items()], "doc_id long, size long, rows long, copies long, source_size long, target double, source string")
    got = {(r.doc_id, r.taken): r["count"] for r in mixing.taken_words(units).groupBy("doc_id", "taken").count().collect()}
    want = {(2, 14): 1}
    for i in (None, 1):
        want |= {(i, 6): 5, (i, 4): n[i] - 5}
    assert got == want
