import math
import random

import pytest
from pyspark.sql import functions as F

from topicloom.llm import vector_file


def brute(rows, k, every):
    usable = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, u in usable:
        if q % every == 0:
            found = sorted(((-sum(a * b for a, b in zip(u, v)), i) for i, v in usable if i != q and len(u) == len(v)))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


@pytest.mark.parametrize("dims", [1, 7])
def test_equals_brute_force_with_ties_and_bad_rows(spark, dims):
    rng = random.Random(dims)
    vec = lambda: [rng.choice([-1.5, -0.25, 0.0, 0.01, 0.5, 2.0]) for _ in range(dims)]
    rows = [(i, vec()) for i in range(300)]
    same = vec()
    rows += [(i, same) for i in range(300, 420)]
    rows += [(420, None), (421, []), (422, [None] * dims), (423, [float("nan")] * dims), (424, [float("inf")] * dims), (None, same), (10, rows[10][1]), (425, [1.0] * (dims + 2)), (450, [1.0] * (dims + 2))]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = vector_file.top_k(df, F.col("id") % 10 == 0, 5, vector_block=64, query_block=16)
    assert {tuple(r) for r in got.collect()} == brute(rows, 5, 10)


def check(spark, rows, k=5, every=10, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = vector_file.top_k(df, F.col("id") % every == 0, k, **options).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_a_query_of_zeros_leaves_few_open(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(1, 400)] + [(0, [0.0] * 4)]
    assert check(spark, rows, every=50, vector_block=100) == brute(rows, 5, 50)
    import numpy as np
    import pandas as pd
    cells = pd.DataFrame({"id": range(5000), "row": range(5000), "width": 2, "base": 0, "wide": False, "cells": [np.zeros(4, np.int8)] * 5000})
    found = vector_file._bounded(6)(cells.sample(frac=1, random_state=1), pd.DataFrame({"q": [9], "v": [np.zeros(4)], "wide": [False]}))
    assert sorted(found["id"]) == list(range(6))


def test_large_components(spark):
    """Within a long scores are exact; beyond they end there."""
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(0, 8e6) for _ in range(3)]) for i in range(60)]
    rows += [(60 + i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    assert any(abs(r[3]) > 1 << 53 for r in brute(rows, 5, 10))
    limit = (1 << 63) - 1
    clipped = {(q, n, i, max(-limit - 1, min(limit, s))) for q, n, i, s in brute(rows, 5, 10)}
    assert all(abs(r[3]) < limit for r in clipped) and check(spark, rows, vector_block=32) == clipped
    huge = [(0, [1e30, 1e30]), (1, [-1e30, -1e300]), (2, [1.0, 0.5]), (3, [1e30, 1e308]), (10, [0.0, 0.0])]
    got = {(q, i): s for q, _, i, s in check(spark, huge)}
    assert got[0, 3] == limit and got[0, 1] == -limit - 1 and got[0, 2] == (256 + 128) << 31
    assert {got[10, i] for i in range(4)} == {0}


def test_ids_with_several_vectors(spark):
    """Each vector of id 10 asks, and is a candidate for the other; the repeated row counts once."""
    rows = [(10, [1.0, 0.0], 0), (10, [0.0, 1.0], 0), (10, [0.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [-1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row int")
    got = sorted(tuple(r) for r in vector_file.top_k(df, F.col("id") == 10, 2).collect())
    assert got == [(10, 1, 1, 65536), (10, 1, 1, 65536), (10, 2, 2, 0), (10, 2, 10, 0)]


def test_hot_query_and_empty_table(spark):
    """A third of all rows ask with one vector."""
    rng = random.Random(7)
    rows = [(10 * i, [0.5, -0.5, 1.0]) for i in range(200)] + [(10 * i + 3, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(400)]
    assert check(spark, rows, vector_block=128, query_block=1) == brute(rows, 5, 10)
    assert check(spark, []) == set()
