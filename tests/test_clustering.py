import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators import clustering
from topicloom.operators.features import counted_grams, distinct_texts, vectors, vocabulary
from topicloom.plans import apply_step, categorise, run
from topicloom.plans.categorise import apply_model, text_features, with_labels
from topicloom.schemas import CATEGORIZED, FEATURE_TEXTS, MODEL_INPUT
from topicloom.sources import tables
from topicloom.sources.layout import SessionLayout

TOPICS = {
    "cloud storage": "bucket blob storage cloud upload",
    "query engine": "join shuffle partition query plan",
    "garden plants": "tomato soil water seed compost",
}
HELD = "row long, weight long, slots array<long>, values array<double>"


def model_rows(spark, partitions=4):
    rows = [
        (f"f{i}.md", f"About {t} {i}", *[None] * 5, w, 100 + i, "< 1 minute")
        for i, (t, w) in enumerate(list(TOPICS.items()) * 10)
    ]
    return spark.createDataFrame(rows, MODEL_INPUT).repartition(partitions)


def random_rows(n=120, slots=40, seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        at = np.sort(rng.choice(slots, rng.integers(1, 8), replace=False))
        out.append((i, int(rng.integers(1, 4)), at.tolist(), rng.random(len(at)).tolist()))
    return out


def dense(rows, slots=40):
    x = np.zeros((len(rows), slots))
    for i, (_, _, at, values) in enumerate(rows):
        x[i, at] = values
    return x, np.array([float(r[1]) for r in rows])


def lloyd(x, weight, centres, passes):
    """Cost and centres of the last pass of plain k-means."""
    for _ in range(passes):
        far = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        label, used = far.argmin(axis=1), centres
        cost = (far.min(axis=1) * weight).sum() / weight.sum()
        centres = np.array([np.average(x[label == i], axis=0, weights=weight[label == i]) for i in range(len(centres))])
    return cost, used, label


@pytest.fixture(scope="module")
def result(spark):
    return categorise(model_rows(spark), range(2, 5))


def test_best_k_takes_the_smaller_on_ties():
    assert clustering.best_k({4: 1.0, 3: 1.0, 2: 2.0}) == 3


def test_labels(spark, result):
    rows = result.rows.collect()
    assert result.rows.columns == CATEGORIZED.names
    assert len(rows) == 30 and len({r.File for r in rows}) == 30
    assert {r.PredictedLabel for r in rows} <= set(range(1, result.sweep.best_k + 1))
    assert set(result.sweep.costs) == {2, 3, 4}
    assert result.sweep.costs[result.sweep.best_k] == min(result.sweep.costs.values())
    assert result.sweep.table(spark).count() == 3


def test_passes_for_all_k_are_those_of_plain_k_means(spark):
    rows = random_rows()
    x, weight = dense(rows)
    df = spark.createDataFrame(rows, HELD)
    found = clustering.sweep(df, range(2, 8), seeds=list(range(10)), max_iter=3, tolerance=-1.0)
    for k in range(2, 8):
        assert found.costs[k] == pytest.approx(lloyd(x, weight, x[:k], 4)[0], abs=1e-9)
    cost, centres, label = lloyd(x, weight, x[:found.best_k], 4)
    scored = {r["row"]: r for r in clustering.scored(df, found.model).collect()}
    for i, row in enumerate(rows):
        assert np.allclose(scored[row[0]]["Score"], np.linalg.norm(centres - x[i], axis=1), atol=1e-6)
        assert scored[row[0]]["PredictedLabel"] == label[i] + 1


@pytest.mark.parametrize("met, entries, pairs", [(256, 50, 2_000_000), (2, 20, 100)])
def test_many_groups_and_a_tree_of_sums(spark, monkeypatch, met, entries, pairs):
    rows = random_rows()
    x, weight = dense(rows)
    for name, value in (("MET", met), ("ENTRIES", entries), ("PAIRS", pairs), ("SHARES", 10), ("SUMS", 100)):
        monkeypatch.setattr(clustering, name, value)
    found = clustering.sweep(spark.createDataFrame(rows, HELD), range(2, 6), seeds=list(range(5)), max_iter=2, tolerance=-1.0)
    for k in range(2, 6):
        assert found.costs[k] == pytest.approx(lloyd(x, weight, x[:k], 3)[0], abs=1e-9)


def test_the_layout_changes_nothing(spark):
    rows = spark.createDataFrame(random_rows(300), HELD)
    wanted = None
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 8, 211):
            spark.conf.set("spark.sql.shuffle.partitions", str(min(n, 40)))
            found = clustering.sweep(rows.repartition(n), [3, 7], max_iter=4)
            labels = sorted((r["row"], r["PredictedLabel"], r["Score"]) for r in clustering.scored(rows.repartition(n), found.model).collect())
            wanted = wanted or (found.costs, labels)
            assert (found.costs, labels) == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_rows_of_equal_texts_are_one_row(spark, result):
    again = categorise(model_rows(spark, 1).union(model_rows(spark)).union(model_rows(spark)), range(2, 5))
    _, held = text_features(again.rows)
    assert held.count() == 30 and held.filter("weight = 3").count() == 30
    by = lambda rows: {r.File: r.PredictedLabel for r in rows.collect()}
    assert again.rows.count() == 90 and by(again.rows) == by(result.rows)


def test_fewer_rows_than_k_and_no_rows(spark):
    rows = [(0, 2, [1], [1.0]), (1, 1, [2], [1.0]), (2, 1, [], [])]
    found = clustering.sweep(spark.createDataFrame(rows, HELD), range(2, 6))
    assert found.best_k == 3 and found.costs[3] == pytest.approx(0.0, abs=1e-9)
    assert len({r["PredictedLabel"] for r in clustering.scored(spark.createDataFrame(rows, HELD), found.model).collect()}) == 3
    empty = spark.createDataFrame([], HELD)
    nothing = clustering.sweep(empty, range(2, 4))
    assert nothing.best_k == 2 and clustering.scored(empty, nothing.model).count() == 0


def test_saved_model_gives_the_same_labels(spark, result, tmp_path):
    clustering.save_model(result.model, str(tmp_path / "m"))
    loaded = clustering.load_model(spark, str(tmp_path / "m"))
    got = {(r.File, r.PredictedLabel) for r in apply_model(loaded, model_rows(spark)).collect()}
    assert got == {(r.File, r.PredictedLabel) for r in result.rows.collect()}


def test_grams_unknown_to_a_model_are_left_out(spark, result):
    extra = model_rows(spark).withColumn("Title", F.concat("Title", F.lit(" зжш")))
    got = {r.File: r.PredictedLabel for r in apply_model(result.model, extra).collect()}
    assert got == {r.File: r.PredictedLabel for r in result.rows.collect()}


def test_distances(spark, result):
    rows = model_rows(spark)
    terms, held = text_features(rows, result.model.vocabulary)
    size = terms.count()
    k = result.sweep.best_k
    centres = np.zeros((k, size))
    for r in result.model.centres.collect():
        centres[r["cluster"], r["slot"]] = r["value"]
    own = {r["key"]: r for r in held.collect()}
    for row in with_labels(rows, held, result.model).withColumn("key", text_key()).collect():
        x = np.zeros(size)
        x[own[row["key"]]["slots"]] = own[row["key"]]["values"]
        assert np.allclose(row["Score"], np.linalg.norm(centres - x, axis=1), atol=1e-6)


def text_key():
    from topicloom.operators.features import text_key as key

    return key()


def test_every_gram_has_its_slot_and_blocks_have_length_one(spark):
    texts = distinct_texts(model_rows(spark))
    counted = counted_grams(texts)
    terms = vocabulary(counted)
    assert sorted(r["slot"] for r in terms.collect()) == list(range(terms.count()))
    assert terms.count() == counted.select("term").distinct().count()
    blocks = sum(1 for r in texts.collect() for n in FEATURE_TEXTS if r[n]) * 2
    squares = vectors(texts, counted, terms).agg(F.sum(F.aggregate("values", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    assert squares == pytest.approx(blocks)


def test_silhouette(spark):
    rows = random_rows()
    x, weight = dense(rows)
    found = clustering.sweep(spark.createDataFrame(rows, HELD), [3, 4], metric="silhouette", max_iter=3)
    label = np.zeros(len(rows), int)
    for r in clustering.scored(spark.createDataFrame(rows, HELD), found.model).collect():
        label[r["row"]] = r["PredictedLabel"] - 1
    far = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    total = 0.0
    for i in range(len(rows)):
        mean = {c: (far[i] * weight)[label == c].sum() / (weight[label == c].sum() - (c == label[i])) for c in set(label)}
        b = min(v for c, v in mean.items() if c != label[i])
        total += weight[i] * (b - mean[label[i]]) / max(b, mean[label[i]])
    assert -found.costs[found.best_k] == pytest.approx(total / weight.sum(), abs=1e-9)
    with pytest.raises(ValueError):
        clustering.sweep(spark.createDataFrame(rows, HELD), [2], metric="other")


def write_docs(root, topics, start=0):
    for i, (topic, words) in enumerate(topics, start):
        path = root / f"d{i % 2}" / f"f{i}.md"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"# About {topic} {i}\n\n{words} {words}\n\n```\ncode{i}\n```\n")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_whole_run_and_new_documents(spark, tmp_path, fmt):
    write_docs(tmp_path / "docs", list(TOPICS.items()) * 4)
    (tmp_path / "docs" / "untitled.md").write_text("no heading")
    layout = SessionLayout(str(tmp_path / "out"), 1)
    found = run(spark, str(tmp_path / "docs"), layout, fmt=fmt, categorise={"ks": range(2, 4)})
    labelled = tables.read_categorized(spark, layout.categorized, fmt)
    assert labelled.count() == 12 and found.best_k in (2, 3)
    assert labelled.filter(F.col("PredictedLabel").isNull()).count() == 0
    summary = [r.line for r in tables.read_summary(spark, layout.summary).collect()]
    assert len(summary) == 12 + labelled.select("PredictedLabel").distinct().count()
    # New documents are labelled by the stored model of the first session.
    write_docs(tmp_path / "new", list(TOPICS.items()), 50)
    fresh = SessionLayout(str(tmp_path / "out"), 2)
    apply_step(spark, str(tmp_path / "new"), fresh, layout.model, fmt=fmt)
    by_topic = {r.Title.rsplit(" ", 1)[0].strip(): r.PredictedLabel for r in labelled.collect()}
    new = tables.read_categorized(spark, fresh.categorized, fmt).collect()
    assert len(new) == 3
    for r in new:
        assert by_topic[r.Title.rsplit(" ", 1)[0].strip()] == r.PredictedLabel
    assert tables.read_summary(spark, fresh.summary).count() == 3 + len({r.PredictedLabel for r in new})
