"""Plans and groups that must not grow with the input where they cannot."""

import pytest
from pyspark.sql import functions as F

from topicloom.catalog import storage


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def documents(spark, tmp_path):
    """A folder with a documents table of a few texts."""
    rows = [(i, f"# Title {i}\nText of {i}", "en" if i % 2 else "de", "web", 20) for i in range(12)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_contents_of_files_are_neither_broadcast_nor_joined(spark, documents):
    found = storage.file_scan(spark, documents)
    assert "Broadcast" not in plan(found) and "read_files" not in plan(found)
    rows = found.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 13)) and {r.level for r in rows} == {3}
    assert {r.n_chars for r in rows} == {len("# Title 1\nText of 1"), len("# Title 11\nText of 11")}


HELD = "row long, weight long, slots array<long>, values array<double>"


def test_groups_are_bounded_in_rows(spark, monkeypatch):
    """A number is held for each row and centre of a group, also where rows have few entries."""
    from topicloom.operators import clustering

    monkeypatch.setattr(clustering, "ROWS", 10)
    groups = clustering._group(spark.createDataFrame([(i, 1, [0], [float(i)]) for i in range(400)], HELD))
    assert groups.groups == 40
    assert groups.rows.groupBy("group").count().agg(F.max("count")).first()[0] < 40


def test_equal_rows_are_dealt_to_all_groups(spark, monkeypatch):
    from topicloom.operators import clustering

    monkeypatch.setattr(clustering, "ROWS", 10)
    groups = clustering._group(spark.createDataFrame([(i, 1, [0, 1], [1.0, 0.0]) for i in range(400)], HELD))
    assert groups.rows.groupBy("group").count().agg(F.max("count")).first()[0] < 40


def test_a_pass_does_not_move_the_rows(spark):
    from topicloom.operators import clustering

    groups = clustering._group(spark.createDataFrame([(i, 1, [0, i], [1.0, 2.0]) for i in range(1, 50)], HELD), passes=True)
    other = spark.createDataFrame([(0, 0)], "group int, x int")
    moved = groups.rows.groupBy("group").cogroup(other.groupBy("group")).applyInArrow(lambda a, b: a.select(["row"]), "row long")
    tree = plan(moved)
    groups.rows.unpersist()
    above = tree[:tree.index("InMemoryTableScan")]
    assert "Exchange" not in above.split("FlatMapCoGroupsInArrow")[-1]


def test_phrases_are_made_after_the_last_shuffle(spark):
    from topicloom.operators import summary

    data = [(1, f"f{i // 2}.md", f"one two three {i % 5}x - end", "a b") for i in range(20)]
    df = spark.createDataFrame(data, "PredictedLabel int, File string, Title string, Top20Words string")
    texts = summary.numbered_texts(df)
    counts = summary.marked_counts(summary.marked_phrases(df, texts=texts))
    found = summary.with_phrases(summary.rank_marked_phrases(counts), df, texts=texts)
    lines = plan(found).split("\n")
    # The phrase stands in the topmost projection, and every exchange below it.
    assert not any("Exchange" in x for x in lines[:next(i for i, x in enumerate(lines) if "Join" in x)])
    assert not any("array_join" in x for x in lines if "Exchange" in x)
    plain = summary.rank_all_phrases(summary.phrase_counts(summary.phrases(df)))
    assert {(r.phrase, r.cnt, r.weight, r.rn, r.first_seen) for r in found.collect()} == {(r.phrase, r.cnt, r.weight, r.rn, r.first_seen) for r in plain.collect()}


def _docs(spark):
    from topicloom.schemas import DOCS

    rows = [(f, f"title {i}", *[None] * 5, w) for i, (f, w) in enumerate([("d1", "spark spark join"), (None, "spark window"), ("d3", "join here")])]
    return spark.createDataFrame(rows, DOCS)


def test_term_rows_meet_their_scores_without_a_sort(spark):
    from topicloom.operators.skew import join_weighted

    facts = spark.createDataFrame([("d1", "a"), ("d2", "a"), ("d2", "b"), ("d3", None)], "File string, word string")
    lookup = spark.createDataFrame([("a", 2), ("b", 1), (None, 1)], "word string, n long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = join_weighted(facts, lookup, "word", "n", ["File"])
        assert "ShuffledHashJoin" in plan(found) and "SortMergeJoin" not in plan(found)
        assert sorted(tuple(r) for r in found.select("File", "word", "n").collect()) == [("d1", "a", 2), ("d2", "a", 2), ("d2", "b", 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_term_rows_are_counted_once(spark, tmp_path):
    """The sum of the weights and the join read one count of the rows; before, only the join left out null words."""
    from topicloom.operators import terms

    docs = _docs(spark).select("File", "Words")
    terms.term_frequency(docs).write.parquet(f"{tmp_path}/tf")
    tf = spark.read.parquet(f"{tmp_path}/tf")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = terms.tf_idf(tf, docs)
        assert sum("FileScan parquet" in line for line in plan(found).splitlines()) == 2
        assert found.count() == 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_model_input_splits_the_texts_once(spark):
    """The join by file tests it for null; that must not reach one of the two uses of the term rows."""
    from topicloom.plans.rank import model_input

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = model_input(_docs(spark))
        assert plan(found).count("Generate explode(CASE") == 1, plan(found)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    rows = {r.File: (r.Top20Words, r.WordCount) for r in found.collect()}
    assert rows == {"d1": ("spark join", 3), "d3": ("here join", 2)}


def test_words_are_cleaned_and_trimmed_without_arrays_and_branches(spark):
    from topicloom.functions.text import clean_words, trim_space

    docs = spark.createDataFrame([("  Read, the DataFrame API\ndocs \U0001F600x ",)], "s string")
    found = docs.select(clean_words("s").alias("w"), trim_space("s").alias("t"))
    assert "lambda" not in plan(found) and "|" not in plan(found)
    assert tuple(found.first()) == ("Read the docs x", "Read, the DataFrame API\ndocs \U0001F600x")


def test_second_distances_have_no_row_for_each_entry_and_cluster(spark):
    from topicloom.catalog.clustering import _distances
    from topicloom.operators.clustering import Model

    held = spark.createDataFrame([(0, 1, [0, 1], [3.0, 4.0]), (1, 1, [5], [1.0]), (2, 1, [], [])], HELD)
    centres = spark.createDataFrame([(0, 0, 3.0), (2, 1, 4.0), (2, 5, 1.0)], "cluster int, slot long, value double")
    model = Model(centres, spark.createDataFrame([(i, 1, 0.0) for i in range(3)], "cluster int, rows long, square double"))
    found = _distances(held, model)
    assert "sum((value" in plan(found) and "keys=[row#" in plan(found)
    assert not any("keys=[row#" in line and "cluster#" in line for line in plan(found).splitlines())
    got = {(r.row, r.cluster): r.distance for r in found.collect()}
    far = {(0, 0): 4.0, (0, 1): 5.0, (0, 2): 10**0.5, (1, 0): 10**0.5, (1, 1): 1.0, (1, 2): 4.0, (2, 0): 3.0, (2, 1): 0.0, (2, 2): 17**0.5}
    assert got == pytest.approx(far)


def test_second_distances_of_no_clusters(spark):
    from topicloom.catalog.clustering import _distances
    from topicloom.operators.clustering import Model

    held = spark.createDataFrame([(0, 1, [0], [1.0])], HELD)
    empty = Model(spark.createDataFrame([], "cluster int, slot long, value double"), spark.createDataFrame([], "cluster int, rows long, square double"))
    assert _distances(held, empty).count() == 0


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffles_behind_a_stored_table_go(spark):
    import time

    from topicloom.session import materialize

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, asked = _shuffle_files(spark), spark.conf.get(setting, None)
    stored = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().orderBy("k"), "few")
    assert [r["k"] for r in stored.orderBy("k").collect()] == list(range(7))
    assert spark.conf.get(setting, None) == asked
    stored = materialize(spark.range(1000).groupBy((F.col("id") % 5).alias("k")).count(), "few")
    until = time.time() + 20
    while len(_shuffle_files(spark) - before) > 12 and time.time() < until:
        time.sleep(0.2)
    # What the collected sort left, and nothing of the stored tables.
    assert len({x.split("_")[1] for x in _shuffle_files(spark) - before}) <= 1


def test_sorted_copies_and_released_tables_are_deleted(spark, monkeypatch, tmp_path):
    import os

    from topicloom import session
    from topicloom.operators import ranking, summary

    made = []
    monkeypatch.setattr(session, "work_dir", lambda spark, name: made.append(f"{tmp_path}/{len(made)}-{name}") or made[-1])
    data = [(1, f"f{i // 2}.md", f"one two three {i % 5}x - end", "a b") for i in range(20)]
    df = spark.createDataFrame(data, "PredictedLabel int, File string, Title string, Top20Words string")
    texts = summary.numbered_texts(df)
    assert sorted(x.split("-", 1)[1] for x in os.listdir(tmp_path)) == ["phrase-texts"] and texts.count() == 20
    session.release(texts)
    session.release(texts)
    assert os.listdir(tmp_path) == []
    assert ranking.number_rows(df, [], ["File", "Title"]).count() == 20


def test_grams_have_a_row_for_each_group_and_not_for_each_text(spark):
    """Rows of odd texts get the weights of the grams that SQL makes of them."""
    from topicloom.operators.features import LEAST_GROUPS, counted_grams, distinct_texts, gram_rows, text_key, vectors, vocabulary
    from topicloom.schemas import FEATURE_TEXTS

    odd = ["Same words here", None, "", "ab", " two  gaps ", "ÄÖ été 日本語", "aaaa aaaa b"]
    data = [(odd[i % 7], *[odd[(i + j) % 7] for j in range(1, 6)], "same words here" if i < 190 else None) for i in range(200)] + [(None,) * 7]
    rows = spark.createDataFrame(data, ", ".join(f"{n} string" for n in FEATURE_TEXTS))
    texts = distinct_texts(rows)
    counted = counted_grams(texts)
    terms = vocabulary(counted)
    wanted = {}
    keyed = rows.withColumn("key", text_key()).distinct()
    for r in gram_rows(keyed, key="key").groupBy("key", "name", "kind", "gram").count().collect():
        wanted.setdefault(r["key"], {}).setdefault((r["name"], r["kind"]), {})[r["gram"]] = r["count"]
    slots = {r["term"]: r for r in terms.collect()}
    assert counted.count() <= LEAST_GROUPS * len(slots)
    assert set(slots) == {f"{n}:{k}:{g}" for blocks in wanted.values() for (n, k), grams in blocks.items() for g in grams}
    held = {r["key"]: r for r in vectors(texts, counted, terms).collect()}
    assert set(held) == {r["key"] for r in keyed.collect()} and sum(r["weight"] for r in held.values()) == 201
    for key, r in held.items():
        own = {}
        for (n, k), grams in wanted.get(key, {}).items():
            length = sum(x * x for x in grams.values()) ** 0.5
            own |= {slots[f"{n}:{k}:{g}"]["slot"]: x / length for g, x in grams.items()}
        assert r["slots"] == sorted(own) and dict(zip(r["slots"], r["values"])) == pytest.approx(own)
    assert sum(len(r["slots"]) for r in held.values()) == sum(t["rows"] for t in slots.values())


def test_rows_and_sums_are_packed_without_loss():
    import numpy as np

    from topicloom.operators import clustering

    rng = np.random.default_rng(0)
    cases = [([], []), ([7], [1.5]), ([0, 2**40], [-1.0, 0.1]), ([0, -1, -2], [1.0, float("nan"), 2.0]), (np.arange(1000) * 3, np.tile([0.5, 0.25], 500)), (np.arange(64), rng.standard_normal(64))]
    for slots, values in cases:
        slots, values = np.array(slots, np.int64), np.array(values, np.float64)
        got = clustering._unpack(clustering._pack(slots, values))
        assert (got[0] == slots).all() and got[1].tobytes() == values.tobytes()
    # Slots of one row each: 19 equal totals a slot take few bytes.
    slots, centres = np.repeat(np.arange(500) * 11, 19), np.tile(np.arange(19) * 10, 500)
    totals = np.repeat(rng.integers(-2**50, 2**50, 500), 19)
    packed = clustering._pack_sums(slots, centres, totals)
    got = clustering._unpack_sums(packed)
    assert all((a == b).all() for a, b in zip(got, (slots, centres, totals))) and len(packed) < len(slots) * 2
    assert [len(x) for x in clustering._unpack_sums(clustering._pack_sums(slots[:0], centres[:0], totals[:0]))] == [0, 0, 0]


def test_distances_of_slots_that_many_rows_hold():
    import numpy as np

    from topicloom.operators import clustering

    rng = np.random.default_rng(1)
    n, m, slots = 200, 30, 80
    held = rng.random((n, slots)) < np.linspace(0.02, 1, slots)
    x, centres = rng.random((n, slots)) * held, rng.random((m, slots))
    of, at = np.nonzero(held)
    place, centre = np.repeat(np.arange(slots, dtype=np.int32), m), np.tile(np.arange(m, dtype=np.int32), slots)
    rows = (held.sum(axis=1), np.arange(slots), at.astype(np.int32), x[of, at])
    got = clustering._squares(rows, (np.arange(slots), place, centre, centres.T.ravel()), np.ones(m), (centres**2).sum(axis=1))
    assert np.allclose(got, ((x[:, None] - centres[None]) ** 2).sum(axis=2))


@pytest.mark.parametrize("metric", ["distance", "silhouette"])
def test_a_fit_leaves_the_tables_of_its_model_only(spark, monkeypatch, tmp_path, metric):
    import os

    from topicloom import session
    from topicloom.operators import clustering

    made = []
    monkeypatch.setattr(session, "work_dir", lambda spark, name: made.append(f"{tmp_path}/{len(made)}-{name}") or made[-1])
    rows = spark.createDataFrame([(i, 1, [i % 3, 3 + i % 5], [1.0, 0.1 * i]) for i in range(40)], HELD)
    found = clustering.sweep(rows, [2, 3], metric=metric)
    left = sorted(x.split("-", 1)[1] for x in os.listdir(tmp_path))
    assert [x for x in left if x.startswith("model-")] == ["model-centres", "model-clusters"]
    assert not {"centres", "seeds", "nearest", "needed-slots", "hot-slots"} & set(left)
    assert clustering.scored(rows, found.model).count() == 40
