import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicloom.llm import suffix_dedup as sd


def brute(docs):
    first = {}
    for i, t in docs:
        data = (t or "").encode()
        for at in range(len(data) - 49):
            key = data[at : at + 50]
            first[key] = min(first.get(key, sd.LAST_ID), sd.LAST_ID if i is None else i)
    out = []
    for i, t in docs:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 49):
            if first[data[at : at + 50]] < (sd.LAST_ID if i is None else i):
                gone[at : at + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs):
    df = spark.createDataFrame([(i, t, 3) for i, t in docs], "doc_id long, text string, n_spans int")
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in sd.remove_repeats(df).collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(6)
    letters = "ab é"
    passages = ["".join(rng.choice(letters) for _ in range(n)) for n in (49, 50, 51, 60, 200, 900)]

    def text():
        bits = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("cdefgh ü") for _ in range(rng.randrange(80))) for _ in range(rng.randrange(6))]
        cut = rng.randrange(30)
        return "".join(bits)[cut:]

    docs = [(rng.randrange(-50, 400), text()) for _ in range(150)]
    docs = list({i: (i, t) for i, t in docs}.values())
    docs += [(500, "x" * 400), (501, "x" * 120), (502, "x" * 49), (503, None), (504, ""), (None, passages[4] + "end"), (None, passages[5]), (505, passages[5]), (505, passages[5]), (506, passages[5] + passages[4])]
    assert run(spark, docs) == brute(docs)


def test_equal_ids_with_other_texts(spark):
    docs = [(1, "q" * 30 + "shared passage of more than fifty bytes, for sure it is"), (1, "shared passage of more than fifty bytes, for sure it is"), (2, "zz shared passage of more than fifty bytes, for sure it is")]
    assert run(spark, docs) == brute(docs)


@pytest.mark.parametrize("number", [None, 7])
def test_rows_of_one_id_whose_short_hashes_are_equal(spark, number):
    passage = "a passage of document one that is well over fifty bytes long, as planned"
    many = spark.range(150_000).select(F.concat(F.lit(passage + " own "), "id").alias("text"), "id")
    other = spark.range(150_000).select(F.concat(F.lit("another text without the passage, but longer than fifty bytes too "), "id").alias("text"), "id")
    pair = many.join(other, F.hash(many["text"]) == F.hash(other["text"])).select(many["text"], other["text"]).first()
    docs = [(1, passage), (number, pair[0]), (number, pair[1])]
    assert run(spark, docs) == brute(docs)


@pytest.mark.parametrize("piece", [64, 1000])
def test_anchors_do_not_depend_on_the_cut_of_long_texts(monkeypatch, piece):
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 101, n).astype(np.uint8).tobytes() for n in (0, 49, 50, 5000, 300)]
    want = [x.tolist() for x in sd.anchors(texts)]
    monkeypatch.setattr(sd, "PIECE", piece)
    assert [x.tolist() for x in sd.anchors(texts)] == want
    # Each string of fifty bytes holds an anchor.
    for i, t in enumerate(texts):
        places = {p for j, p in zip(*want[:2]) if i == j}
        assert all(any(p in places for p in range(s, s + sd.SPAN)) for s in range(len(t) - 49))


def test_levels_merge_geometrically():
    rng = np.random.default_rng(2)
    index, first, at = sd.IndexFamily(), {}, 0
    for batch in range(11):
        strings = rng.integers(0, 400, 60).astype(np.uint64)
        keys = np.sort(rng.integers(at, at + 10, 60))
        at += 10
        for s, k in zip(strings.tolist(), keys.tolist()):
            first[s] = min(first.get(s, k), k)
        assert index.insert(strings, keys).tolist() == [first[s] for s in strings.tolist()]
        assert len(index.levels) == bin(batch + 1).count("1")


def test_strings_of_hot_anchors_are_dealt_out(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = word(130)
    docs = [(i, word(rng.randrange(60)) + passage + word(rng.randrange(60))) for i in range(1, 120)]
    docs += [(i, docs[i % 7][1][5:90] + passage[40:110]) for i in range(200, 230)] + [(None, passage), (None, passage + "z"), (5, passage), (300, "x" * 300), (301, "x" * 100)]
    df = spark.createDataFrame([(i, t, 3) for i, t in docs], "doc_id long, text string, n_spans int")
    for hot in (1, 20):
        got = sd.remove_repeats(df, sample=1, hot=hot).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=str) == brute(docs)


def test_contexts_of_a_hot_anchor_do_not_meet_in_one_shard(spark):
    rng = np.random.default_rng(5)
    word = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    passage = word(60)
    rows = spark.createDataFrame([(i, word(40) + passage + word(40), i) for i in range(400)], "key long, text string, mark long")
    hot = sd.hot_anchors(rows, 0, sample=1, hot=300)
    assert len(hot)
    batch = rows.toArrow().combine_chunks().to_batches()[0]
    _, _, fp = sd.anchors([t.encode() for t in batch.column("text").to_pylist()])
    shards = 16
    found, count = np.unique(fp, return_counts=True)
    assert hot.tolist() == found[count >= 300].tolist()
    wanted = np.array([int(x % np.uint64(shards)) << 32 | int(x >> np.uint64(32)) for x in hot], np.int64).tobytes()
    batch = batch.append_column("fps", pa.array([[wanted]] * batch.num_rows, pa.list_(pa.binary())))

    class Held:
        value = hot

    sizes = lambda held: [len(b) for part in sd._deal_contexts(shards, held)([batch]) for b in part.column("blob").to_pylist()]
    dealt = sizes(Held)
    Held.value = hot[:0]
    whole = sizes(Held)
    assert max(whole) > 5 * np.median(whole) and max(dealt) < 2 * np.median(dealt)
