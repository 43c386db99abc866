"""The pipeline stage by stage on planted rows, against what each stage should do to its input."""

import random

import pytest

import corpus_pipeline as cp
from topicloom.llm import mixing
from topicloom.llm.common import stored

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string"


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(12)
    common = ["the", "of", "and", "to", "in", "is", "that", "for"]

    def prose(n):
        words = [rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("aeiounrstl") for _ in range(rng.randrange(4, 9))) for _ in range(n)]
        return "\n".join(" ".join(words[i : i + 25]) for i in range(0, n, 25))

    clean = [(i, prose(150)) for i in range(60)]
    near = clean[5][1].split()
    near[70] = "changedword"
    rows = clean + [(100, clean[3][1]), (101, " ".join(near)), (102, None), (103, ""), (104, "too short"), (105, " ".join(w + "$$$" for w in clean[0][1].split()))]
    return [(i, t, "en", f"s{i % 3}", len(t or ""), "r", "k") for i, t in rows]


def test_stages(spark, planted):
    docs = spark.createDataFrame(planted, COLUMNS)
    kept, frames = [], []
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, ""), f"test-{name}")
        frames.append(docs)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = set(range(60))
    assert kept[0] == clean | {100, 101}
    assert kept[1] == clean | {101} and kept[2] == clean
    assert all(f.columns == frames[0].columns for f in frames[:4])
    lengths = frames[1].selectExpr("n_chars = length(text) AS same", "row", "kept").collect()
    assert all(r.same and r.row == "r" and r.kept == "k" for r in lengths)
    copies = {}
    for r in frames[3].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    units = {r.doc_id: r.copies for r in mixing.mixture(frames[2]).collect()}
    assert copies == {i: n for i, n in units.items() if n}
    assert frames[4].count() == sum(copies.values())


def test_empty_input(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, ""), f"test-{name}")
        assert docs.count() == 0
