import random
import re
from collections import Counter

import numpy as np
import pytest

from topicloom.llm import ngram_join as nj
from topicloom.llm.components import components


def sets(docs):
    out = {}
    for i, t in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def brute(docs, threshold=0.8):
    s = sets(docs)
    ids = sorted(s)
    up, links = {i: i for i in ids}, Counter()

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    seen = {i: set() for i in ids}
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(s[a] & s[b])
            if common and common >= threshold * (len(s[a]) + len(s[b]) - common):
                low, high = sorted((root(a), root(b)))
                up[high] = low
                if s[a] != s[b]:
                    seen[a].add(s[b])
                    seen[b].add(s[a])
    return {i: (root(i), len(seen[i])) for i in ids}


def made(n_groups, per_group, seed=1):
    rng = random.Random(seed)
    docs = []
    for _ in range(n_groups):
        base = [str(rng.randrange(5000)) for _ in range(rng.choice([4, 5, 6, 60, 150]))]
        for _ in range(per_group):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                words[rng.randrange(len(words))] = str(rng.randrange(5000))
            docs.append((len(docs), " ".join(words)))
    return docs


def test_equals_brute_force(spark):
    docs = made(60, 6) + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "one"), (905, "one two")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_links int")
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.near_classes(df).collect()}
    assert got == brute(docs)


def test_a_dense_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BUCKET", 8)
    monkeypatch.setattr(nj, "BLOCK", 16)
    rng = random.Random(2)
    base = [str(rng.randrange(9000)) for _ in range(200)]
    docs = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(200)] = str(rng.randrange(9000))
        docs.append((i, " ".join(words)))
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.near_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


def test_one_of_each_keeps_the_rest(spark):
    docs = made(20, 5, seed=4)
    rows = docs + [docs[0], (None, "a b c d e f"), (None, None), (950, None), (950, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _key int")
    out = nj.one_of_each(df)
    assert out.columns == df.columns
    got = Counter(r.doc_id for r in out.collect())
    want = Counter({i for i, (root, _) in brute(docs).items() if root == i})
    assert got == want + Counter({None: 2, 950: 2})


def test_shingles_do_not_cross_texts_and_ignore_gaps():
    texts = ["a b c d e f", "a  b\tc\nd e f ", "", "d e f", "x" * 100_000 + " y", "a b c d e"]
    shingles, bounds = nj.shingle_sets(texts)
    parts = [set(shingles[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    assert parts[0] == parts[1] and [len(p) for p in parts] == [2, 2, 0, 1, 1, 1] and parts[5] < parts[0]
    alone = [set(nj.shingle_sets([t])[0].tolist()) for t in texts]
    assert alone == parts


def test_recall_of_the_paths():
    assert nj.run_count(0.999, 1) == 7 and nj.run_count(0.999, 4) > nj.run_count(0.999, 1)


def test_recall_in_deep_trees(spark, monkeypatch):
    """Pairs just above the threshold among strangers that share half of their text, so that paths are split often."""
    monkeypatch.setattr(nj, "BUCKET", 16)
    rng = random.Random(8)
    common = [f"c{i}" for i in range(100)]
    docs = []
    for _ in range(400):
        own = [str(rng.randrange(10**9)) for _ in range(50)]
        # Each has 146 shingles and the two share all but the last 16: 130 / 162 = 0.802.
        for side in range(2):
            tail = [str(rng.randrange(10**9)) for _ in range(16)] if side else own[-16:]
            docs.append((len(docs), " ".join(common + own[:-16] + tail)))
    pairs = sets(docs)
    alike = [len(pairs[i] & pairs[i + 1]) / len(pairs[i] | pairs[i + 1]) for i in range(0, len(docs), 2)]
    strange = len(pairs[0] & pairs[2]) / len(pairs[0] | pairs[2])
    assert 0.8 <= min(alike) and max(alike) < 0.82 and strange > 0.45
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.near_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = {i: (i - i % 2, 1) for i, _ in docs}
    found = sum(got[i] == want[i] for i in range(0, len(docs), 2))
    assert found >= 0.99 * len(alike) and all(x in ((i, 0), want[i]) for i, x in got.items())


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(None, 5), (7, 7)]
    up = {}
    root = lambda x: x if up.setdefault(x, x) == x else root(up[x])
    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            up[high] = low
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(spark, n):
    df = spark.createDataFrame([(1, "a b c d e f")][:n], "doc_id long, text string")
    assert [tuple(r) for r in nj.near_classes(df).collect()] == [(1, 1, 1, 0)][:n]


def test_rows_of_null_id_are_documents_of_their_own(spark):
    text = lambda tag, last: " ".join(f"{tag}{i}" for i in range(60)) + last
    rows = [(1, text("a", "")), (None, text("a", " x")), (None, text("b", "")), (4, text("b", " x")), (None, text("c", "")), (None, text("c", ""))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in nj.near_classes(df).collect()), key=str)
    want = [(1, 1, 1, 1), (None, 1, None, 1), (None, 4, None, 1), (4, 4, 4, 1), (None, None, None, 0), (None, None, None, 0)]
    assert got == sorted(want, key=str)
    assert sorted((r.text for r in nj.one_of_each(df).collect())) == sorted([rows[0][1], rows[3][1], rows[4][1]])
