import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from topicloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int, digest int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, change=False):
    values = list(row[:5])
    if change and values[0] is not None and values[4] is not None and zlib.crc32(str(values[0]).encode()) % 2 == 0:
        values[4] = values[4].replace("\n", "")
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """All levels of a tree, from the leaves up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([sha(*at[i:i + 3]) for i in range(0, len(at), 3)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i // 3 * 3
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + 3])))
        i //= 3
    return out


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for j, r in enumerate(groups[s]):
            path = siblings(trees[s], j) + siblings(top, i)
            fold = leaf(r, True)
            for left, right in path:
                fold = sha(left, fold, right)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha(*(a + b for a, b in path)), fold, fold == top[-1][0]))
    return out


def rows_of(n, seed=1):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice("ab\né日 ") for _ in range(rng.randrange(0, 9)))
    rows = [(i * 7 - 50, rng.choice(["hot", "hot", "b", "é", "z", "one"]), rng.choice(["en", None]), i, text()) for i in range(n)]
    rows += [(None, "b", None, None, None), (None, None, "en", 1, "x\ny"), (10**15, "", "en", 0, ""), (10**15 + 1, "lone", "en", 3, "\n" * 200_000)]
    # Repeated rows, and rows of one id with several texts.
    return rows + [rows[0]] * 40 + [(None, "b", None, None, None)] * 100 + [(12, "b", "en", 1, t) for t in ("p", "q\n", "p")]


@pytest.mark.parametrize("n", [0, 30, 2500])
def test_against_hashing_in_order(spark, n):
    rows = rows_of(n) if n else [(4, "only", None, 1, "a\nb")]
    df = spark.createDataFrame([(*r, "t", 1, 2) for r in rows], SCHEMA)
    got = merkle.verify_documents(df.repartition(5)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected(rows), key=key)
    assert n == 0 or {r["verified"] for r in got} == {True, False}


def test_proofs_of_a_few_leaves_of_many(spark):
    nodes = [sha(str(i)) for i in range(1000)]
    leaves = spark.createDataFrame([("t", i, d) for i, d in enumerate(nodes)], "tree string, rank long, digest string")
    manifest = merkle.build(leaves)
    levels = tree(nodes)
    assert manifest.tops.collect() == [("t", levels[-1][0], len(levels) - 1)]
    start = spark.createDataFrame([("t", [])], f"tree string, path {merkle.NO_PATH}")
    asked = spark.createDataFrame([("t", i, f"r{i}") for i in (0, 26, 27, 500, 999, 999)], "tree string, rank long, name string")
    got = merkle.descend(manifest, start, asked).select("rank", "name", F.reverse("path")).collect()
    assert sorted((r[0], r[1], [tuple(s) for s in r[2]]) for r in got) == sorted((i, f"r{i}", siblings(levels, i)) for i in (0, 26, 27, 500, 999, 999))


def test_equal_subtrees_share_a_record(spark):
    leaves = spark.createDataFrame([("t", i, sha("same")) for i in range(729)], "tree string, rank long, digest string")
    manifest = merkle.build(leaves)
    assert [r.count() for r in manifest.rounds] == [1, 1]
    start = spark.createDataFrame([("t", [])], f"tree string, path {merkle.NO_PATH}")
    got = merkle.descend(manifest, start, leaves.select("tree", "rank"))
    assert got.count() == 729 and got.filter(F.size("path") == 6).count() == 729
