"""Features, the sweep over k, labels, distances and saved models.

Clusters have an SQL form where the groups are known. The documents here carry the
words of their language as texts, so rows of one language have equal features: the
best fit has a cluster per language, of no cost, and rows of other languages are
all equally far. Clusters are named by their smallest file. Fits over real texts
and vectors are checked against a second way to compute their numbers: the queries
that start with ``page_`` or ``document_`` run over the whole model input.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import clustering
from ..operators.features import gram_rows, text_key
from ..operators.summary import numbered_summary, summary_lines
from ..plans.categorise import apply_model, categorise, text_features, with_labels
from ..plans.rank import model_input
from ..session import materialize, release, spread_input, work_dir
from . import corpus as c
from .summaries import define_phrases

LANGUAGES = ("en", "de", "fr", "es")


def _rows(spark, sf_dir):
    """Model input of the pages, stored as the ranking step would."""
    return _stored(model_input(c.page_docs(spark, sf_dir).drop("lang")))


def _stored(rows):
    return spread_input(materialize(rows, "model-input"))


def _language_rows(spark, sf_dir):
    """Model input whose texts name the language of a document."""
    docs = c.texts(spark, sf_dir)
    named = [F.concat(F.lit(f"{n} in language "), F.repeat("lang", 3)).alias(n) for n in c.HEADINGS]
    return _stored(docs.select(
        "File", *named, F.repeat(F.concat("lang", "lang", F.lit(" ")), 5).alias("Top20Words"),
        F.length("text").cast("bigint").alias("WordCount"), F.lit("< 1 minute").alias("ReadingTime"),
    ))


def _named(labelled, by="File"):
    """The smallest file of a cluster instead of its number."""
    first = labelled.groupBy("PredictedLabel").agg(F.min(by).alias("category"))
    return labelled.join(first, "PredictedLabel").drop("PredictedLabel")


def _language_vectors(spark, sf_dir):
    """Documents with one place of a vector for each language; row is the number of the document."""
    at = F.array(*[(F.col("lang") == name).cast("double") for name in LANGUAGES])
    docs = c.table(spark, sf_dir, "documents", "doc_id", "lang")
    return materialize(docs.select(F.col("doc_id").alias("row"), F.lit(1).cast("bigint").alias("weight"), _places(len(LANGUAGES)), at.alias("values")), "language-vectors")


def _places(size):
    return F.sequence(F.lit(0).cast("bigint"), F.lit(size - 1).cast("bigint")).alias("slots")


def feature_terms(spark, sf_dir):
    """Grams per text column with count and weight before hashing."""
    rows = model_input(c.page_docs(spark, sf_dir).drop("lang"))
    counted = gram_rows(rows).groupBy("File", "name", "kind", "gram").agg(F.count(F.lit(1)).alias("n"))
    block = Window.partitionBy("File", "name", "kind")
    weight = F.col("n") / F.sqrt(F.sum(F.col("n") * F.col("n")).over(block))
    return counted.withColumn("weight", F.round(weight, 9))


def _entries(held):
    return held.select("row", F.inline(F.arrays_zip(F.col("slots").alias("slot"), F.col("values").alias("value"))))


def text_feature_weights(spark, sf_dir):
    """Number of distinct grams of each block, and whether its vector holds just their weights.

    Each gram is compared by itself, as each has a slot of its own.
    """
    rows = _rows(spark, sf_dir)
    terms, held = text_features(rows)
    counted = gram_rows(rows).groupBy("File", "name", "kind", "gram").agg(F.count(F.lit(1)).alias("n"))
    block = Window.partitionBy("File", "name", "kind")
    own = counted.select(
        "File", "name", "kind", F.concat_ws(":", "name", "kind", "gram").alias("term"),
        (F.col("n") / F.sqrt(F.sum(F.col("n") * F.col("n")).over(block))).alias("weight"),
    )
    named = rows.select("File", text_key().alias("key")).join(held, "key")
    placed = named.select("File", F.inline(F.arrays_zip(F.col("slots").alias("slot"), F.col("values").alias("value"))))
    both = own.join(placed.join(terms, "slot").select("File", "term", "value"), ["File", "term"], "full")
    same = F.coalesce(F.abs(F.col("weight") - F.col("value")) < 1e-9, F.lit(False))
    return both.groupBy("File", "name", "kind").agg(
        F.count(F.lit(1)).alias("grams"), F.bool_and(same).alias("agrees")
    )


def _distances(held, model):
    """(row, cluster, distance) by a join of single entries: a second way to the distances of a model.

    An entry meets the means of all clusters in its slot as one row, and the products
    with all of them are added up beside each other, so there is no row for each entry
    and cluster.
    """
    centres = materialize(model.centres, "second-centres")
    whole = centres.groupBy("cluster").agg(F.sum(F.col("value") * F.col("value")).alias("whole"))
    clusters = F.broadcast(model.clusters.select("cluster").join(whole, "cluster", "left").na.fill(0.0))
    # At most twenty clusters.
    numbers = [r["cluster"] for r in model.clusters.select("cluster").distinct().collect()]
    means = [F.sum(F.when(F.col("cluster") == i, F.col("value"))).alias(f"mean{i}") for i in numbers]
    lines = centres.groupBy("slot").agg(F.count(F.lit(1)).alias("held"), *means).hint("shuffle_hash")
    sums = [F.sum(F.col("value") * F.col(f"mean{i}")).alias(f"dot{i}") for i in numbers]
    added = _entries(held).join(lines, "slot").groupBy("row").agg(F.count(F.lit(1)).alias("met"), *sums)
    each = [F.struct(F.lit(i).alias("cluster"), F.col(f"dot{i}").alias("dot")) for i in numbers]
    dots = added.select("row", F.inline(F.array(*each).cast("array<struct<cluster:int,dot:double>>")))
    square = F.aggregate("values", F.lit(0.0), lambda s, x: s + x * x)
    pairs = held.select("row", square.alias("square")).crossJoin(clusters).join(dots, ["row", "cluster"], "left")
    gap = F.col("square") + F.col("whole") - 2 * F.coalesce("dot", F.lit(0.0))
    return pairs.select("row", "cluster", F.sqrt(F.greatest(gap, F.lit(0.0))).alias("distance"))


def kmeans_sweep(spark, sf_dir):
    """Each k with its cost, and whether the cost of the best one equals the mean squared distance."""
    _, held = text_features(_rows(spark, sf_dir))
    found = clustering.sweep(held)
    least = held.select("row", "weight").join(_distances(held, found.model).groupBy("row").agg(F.min("distance").alias("least")), "row")
    mean = least.agg(F.sum(F.col("least") * F.col("least") * F.col("weight")) / F.sum("weight")).first()[0]
    table = found.table(spark)
    best = F.col("k") == found.best_k
    sound = (F.col("cost") >= found.costs[found.best_k]) & (~best | (F.abs(F.col("cost") - mean) < 1e-6))
    return table.select(F.col("k").cast("bigint").alias("k"), sound.alias("sound"))


def language_sweep(spark, sf_dir):
    """The best k over vectors of languages, its cost, and the number of fits."""
    found = clustering.sweep(_language_vectors(spark, sf_dir))
    row = (found.best_k, round(found.costs[found.best_k], 9) + 0.0, len(found.costs))
    return spark.createDataFrame([row], "best_k bigint, cost double, fits bigint")


def silhouette_sweep(spark, sf_dir):
    """The best silhouette over vectors of languages, and its clusters."""
    held = _language_vectors(spark, sf_dir)
    found = clustering.sweep(held, metric="silhouette")
    labelled = clustering.scored(held, found.model)
    return labelled.agg(F.countDistinct("PredictedLabel").alias("clusters")).withColumn(
        "silhouette", F.round(F.lit(-found.costs[found.best_k]), 6)
    )


def categorized(spark, sf_dir):
    return _named(categorise(_language_rows(spark, sf_dir)).rows)


def cluster_summary(spark, sf_dir):
    named = _named(categorise(_language_rows(spark, sf_dir)).rows)
    lines = numbered_summary(summary_lines(named, "category"))
    return lines.select("category", F.col("ord").cast("bigint").alias("ord"), "line", "position")


def centroid_distances(spark, sf_dir):
    """Distances to all centres in rising order; the nearest centre is the label."""
    held = _language_vectors(spark, sf_dir)
    scored = clustering.scored(held, clustering.sweep(held).model)
    rounded = F.transform(F.array_sort("Score"), lambda x: F.round(x, 4) + 0.0)
    return scored.select(
        F.concat(F.lit("doc-"), "row", F.lit(".md")).alias("File"),
        F.array_join(rounded.cast("array<string>"), " ").alias("distances"),
        (F.array_position("Score", F.array_min("Score")) == F.col("PredictedLabel")).alias("nearest"),
    )


def apply_saved_model(spark, sf_dir):
    """Train on every other document, save, load, and label all documents."""
    rows = _language_rows(spark, sf_dir)
    result = categorise(rows.filter("length(File) % 2 = 0 OR hash(File) % 2 = 0"))
    path = work_dir(spark, "trained")
    clustering.save_model(result.model, path)
    return _named(apply_model(clustering.load_model(spark, path), rows)).select("File", "category")


def embedding_clusters(spark, sf_dir):
    """The same sweep over ready-made vectors; distances are computed a second time."""
    rows = c.table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    held = materialize(rows.select(
        F.col("vec_id").alias("row"), F.lit(1).cast("bigint").alias("weight"),
        F.sequence(F.lit(0).cast("bigint"), (F.size("embedding") - 1).cast("bigint")).alias("slots"),
        F.col("embedding").cast("array<double>").alias("values"),
    ), "embeddings")
    found = clustering.sweep(held)
    again = _distances(held, found.model).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("cluster", "distance"))).alias("again"))
    scored = clustering.scored(held, found.model).join(again, "row").join(held.select("row", F.size("values").alias("size")), "row")
    gaps = F.zip_with("Score", "again", lambda a, b: F.abs(a - b["distance"]))
    return scored.select(
        F.col("row").alias("vec_id"), F.col("size").cast("bigint").alias("size"),
        (F.array_max(gaps) < 1e-6).alias("agrees"),
        (F.array_position("Score", F.array_min("Score")) == F.col("PredictedLabel")).alias("nearest"),
    )


def _document_rows(spark, sf_dir):
    """Model input of the documents, stored as the ranking step would."""
    docs = c.stored_docs(spark, sf_dir)
    rows = _stored(model_input(docs))
    release(docs)
    return rows


def _checked(rows, held, model):
    """Rows with Score, and whether a join of single entries gives the same distances and the label is the nearest."""
    again = _distances(held, model).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("cluster", "distance"))).alias("again"))
    again = held.select("row", "key").join(again, "row").drop("row")
    found = with_labels(rows, held, model).withColumn("key", text_key()).join(again, "key")
    gaps = F.zip_with("Score", "again", lambda a, b: F.abs(a - b["distance"]))
    own = F.filter("again", lambda x: x["cluster"] + 1 == F.col("PredictedLabel"))
    least = F.array_min(F.transform("again", lambda x: x["distance"]))
    return found.select(
        "File", "PredictedLabel", (F.array_max(gaps) < 1e-6).alias("agrees"),
        (F.get(own, F.lit(0))["distance"] < least + 1e-6).alias("nearest"),
    )


def real_categorized(rows_of):
    """Each row with its texts, and whether its label is that of the model's tables, is the nearest centre's,
    and all distances agree."""

    def run(spark, sf_dir):
        rows = rows_of(spark, sf_dir)
        result = categorise(rows)
        _, held = text_features(rows, result.model.vocabulary)
        again = _checked(rows, held, result.model).withColumnRenamed("PredictedLabel", "other")
        found = result.rows.join(again, "File")
        sound = F.col("agrees") & F.col("nearest") & (F.col("PredictedLabel") == F.col("other"))
        return found.select("File", *c.HEADINGS, "WordCount", "ReadingTime", "Top20Words", sound.alias("sound"))

    return run


def real_distances(rows_of):
    def run(spark, sf_dir):
        rows = rows_of(spark, sf_dir)
        _, held = text_features(rows)
        return _checked(rows, held, clustering.sweep(held).model).drop("PredictedLabel")

    return run


#: Passes of the fits from given seeds, and the k whose labels are shown.
PASSES, SHOWN = 3, 8


def _seeded(rows, ks):
    """Vectors and the fits that start from the texts of the first files."""
    _, held = text_features(rows)
    first = rows.groupBy(text_key().alias("key")).agg(F.min("File").alias("File")).orderBy("File").limit(max(ks))
    seeds = [r["row"] for r in first.join(held, "key").orderBy("File").collect()]
    return held, clustering.sweep(held, ks, seeds=seeds, max_iter=PASSES - 1, tolerance=-1.0)


def seeded_costs(rows_of):
    """The cost of each k after a few passes from given seeds."""

    def run(spark, sf_dir):
        _, found = _seeded(rows_of(spark, sf_dir), range(clustering.LOW_K, clustering.HIGH_K + 1))
        return found.table(spark).select(F.col("k").cast("bigint").alias("k"), F.round("cost", 6).alias("cost"))

    return run


def seeded_labels(rows_of):
    """Label of each file and its distances to all centres after a few passes from given seeds."""

    def run(spark, sf_dir):
        rows = rows_of(spark, sf_dir)
        held, found = _seeded(rows, [SHOWN])
        rounded = F.transform("Score", lambda x: F.round(x, 4))
        labelled = with_labels(rows, held, found.model)
        return labelled.select("File", F.col("PredictedLabel").cast("bigint").alias("label"), *(F.get(rounded, F.lit(i)).alias(f"d{i + 1}") for i in range(SHOWN)))

    return run


def real_summary(rows_of):
    """Lines of the clusters' files with their number, and whether one heading stands before all of each cluster."""

    def run(spark, sf_dir):
        labelled = materialize(categorise(rows_of(spark, sf_dir)).rows, "labelled")
        lines = materialize(numbered_summary(summary_lines(_named(labelled), "category")), "summary")
        heads = lines.filter("ord = 0").groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("head"))
        body = lines.filter("ord = 1").join(heads, "category", "left")
        sound = F.coalesce((F.col("n") == 1) & (F.col("head") < F.col("position")), F.lit(False))
        return body.groupBy("line").agg(F.count(F.lit(1)).alias("files"), F.bool_and(sound).alias("headed"))

    return run


def real_saved_model(rows_of):
    """Train on all rows, save, load and label all rows; whether each label is the same as before."""

    def run(spark, sf_dir):
        rows = rows_of(spark, sf_dir)
        result = categorise(rows)
        path = work_dir(spark, "trained")
        clustering.save_model(result.model, path)
        again = apply_model(clustering.load_model(spark, path), rows).select("File", F.col("PredictedLabel").alias("other"))
        return result.rows.join(again, "File").select("File", (F.col("PredictedLabel") == F.col("other")).alias("same"))

    return run


def real_silhouette(rows_of):
    """Each k, and whether no silhouette is above the best one, which a sum over the rows gives as well."""

    def run(spark, sf_dir):
        _, held = text_features(rows_of(spark, sf_dir))
        found = clustering.sweep(held, metric="silhouette")
        table = found.table(spark)
        best = _silhouette(held, clustering.scored(held, found.model))
        sound = (F.col("cost") >= found.costs[found.best_k]) & F.col("cost").between(-1.0, 1.0)
        sound = sound & ((F.col("k") != found.best_k) | (F.abs(F.col("cost") + best) < 1e-6))
        return table.select(F.col("k").cast("bigint").alias("k"), sound.alias("sound"))

    return run


def _silhouette(held, labels):
    """Mean silhouette of squared distances, from the sums of the entries of each cluster."""
    rows = materialize(held.join(labels, "row").select(
        "row", "weight", F.col("PredictedLabel").alias("own"), F.arrays_zip(F.col("slots").alias("slot"), F.col("values").alias("value")).alias("held"),
        F.aggregate("values", F.lit(0.0), lambda s, x: s + x * x).alias("square"),
    ), "silhouette")
    clusters = F.broadcast(rows.groupBy(F.col("own").alias("other")).agg(F.sum("weight").alias("n"), F.sum(F.col("square") * F.col("weight")).alias("squares")))
    entries = rows.select("row", "weight", "own", F.inline("held"))
    sums = entries.groupBy("slot", F.col("own").alias("other")).agg(F.sum(F.col("value") * F.col("weight")).alias("total"))
    dots = entries.drop("own").join(sums, "slot").groupBy("row", "other").agg(F.sum(F.col("value") * F.col("total")).alias("dot"))
    # At most twenty clusters.
    pairs = rows.select("row", "weight", "own", "square").crossJoin(clusters).join(dots, ["row", "other"], "left")
    far = F.col("square") + (F.col("squares") - 2 * F.coalesce("dot", F.lit(0.0))) / F.col("n")
    same = F.col("own") == F.col("other")
    a = F.max(F.when(same & (F.col("n") > 1), F.try_divide(far * F.col("n"), F.col("n") - 1)))
    ab = pairs.groupBy("row", "weight").agg(a.alias("a"), F.min(F.when(~same, far)).alias("b"), F.max(F.when(same, F.col("n"))).alias("n"))
    score = F.when(F.col("n") == 1, 0.0).otherwise(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return ab.agg(F.sum(F.coalesce(score, F.lit(0.0)) * F.col("weight")) / F.sum("weight")).first()[0]


def training_rows(spark, sf_dir):
    """Rows of the stored training table."""
    from ..operators.terms import corpus_size

    return corpus_size(_stored(model_input(c.stored_docs(spark, sf_dir))))


QUERIES = {
    "feature_terms": feature_terms,
    "text_features": text_feature_weights,
    "kmeans_sweep": kmeans_sweep,
    "language_sweep": language_sweep,
    "silhouette_sweep": silhouette_sweep,
    "categorize": categorized,
    "cluster_summary": cluster_summary,
    "centroid_distances": centroid_distances,
    "apply_saved_model": apply_saved_model,
    "embedding_clusters": embedding_clusters,
    "training_rows": training_rows,
}
_REAL = {"categorize": real_categorized, "centroid_distances": real_distances, "cluster_summary": real_summary,
         "apply_saved_model": real_saved_model, "silhouette_sweep": real_silhouette, "seeded_costs": seeded_costs,
         "seeded_labels": seeded_labels}
for _prefix, _source in (("page", _rows), ("document", _document_rows)):
    QUERIES |= {f"{_prefix}_{name}": made(_source) for name, made in _REAL.items()}

_BLOCKS = " UNION ALL ".join(
    f"SELECT \"File\", '{name}' AS name, lower(\"{name}\") AS t FROM page_model_input "
    f'WHERE "{name}" IS NOT NULL'
    for name in [*c.HEADINGS, "Top20Words"]
)
c.define("feature_texts", ("page_model_input",), _BLOCKS)
c.define(
    "grams", ("feature_texts",),
    "SELECT \"File\", name, 'words' AS kind, gram FROM (SELECT \"File\", name, "
    "unnest(string_split(t, ' ')) AS gram FROM feature_texts) WHERE gram <> '' UNION ALL "
    "SELECT \"File\", name, 'trigrams', t[i:i + 2] FROM (SELECT \"File\", name, t, "
    "unnest(range(1, length(t) - 1)) AS i FROM feature_texts)",
)

_COUNTED = 'SELECT "File", name, kind, gram, count(*) AS n FROM grams GROUP BY ALL'
_LANGUAGE_NAMES = ", ".join(f"'{n} in language ' || repeat(lang, 3) AS \"{n}\"" for n in c.HEADINGS)
_CATEGORY = 'min("File") OVER (PARTITION BY lang) AS category'
c.define(
    "language_rows", ("texts",),
    f'SELECT "File", {_LANGUAGE_NAMES}, length("text") AS "WordCount", \'< 1 minute\' AS "ReadingTime", '
    f"repeat(lang || lang || ' ', 5) AS \"Top20Words\", {_CATEGORY} FROM texts",
)
define_phrases("language_summary_rows", 'SELECT *, category AS lang FROM language_rows', ("language_rows",), "language_")
_FAR = "(SELECT count(DISTINCT lang) FROM documents)"

SQL = {
    "feature_terms": c.with_tables(
        "SELECT *, round(n / sqrt(sum(n * n) OVER (PARTITION BY \"File\", name, kind)), 9) AS weight "
        f"FROM ({_COUNTED})",
        "grams",
    ),
    "text_features": c.with_tables(
        f'SELECT "File", name, kind, count(*) AS grams, true AS agrees FROM ({_COUNTED}) GROUP BY ALL', "grams"
    ),
    "kmeans_sweep": "SELECT unnest(range(2, 21)) AS k, true AS sound",
    "language_sweep": "SELECT count(DISTINCT lang) AS best_k, 0.0::DOUBLE AS cost, 19 AS fits FROM documents",
    "silhouette_sweep": "SELECT count(DISTINCT lang) AS clusters, 1.0::DOUBLE AS silhouette FROM documents",
    "categorize": c.with_tables("SELECT * FROM language_rows", "language_rows"),
    "cluster_summary": c.with_tables("SELECT category, ord, line, position FROM language_summary", "language_summary"),
    "centroid_distances": (
        "SELECT 'doc-' || doc_id || '.md' AS \"File\", "
        f"'0.0' || repeat(' 1.4142', ({_FAR} - 1)::INTEGER) AS distances, true AS nearest FROM documents"
    ),
    "apply_saved_model": c.with_tables('SELECT "File", category FROM language_rows', "language_rows"),
    "embedding_clusters": "SELECT vec_id, len(embedding) AS size, true AS agrees, true AS nearest FROM embeddings",
    "training_rows": c.with_tables("SELECT count(*) AS total FROM doc_model_input", "doc_model_input"),
}



def _define_seeded(prefix, table):
    """Vectors of ``table`` and three passes of k-means from the texts of the first files, for all k and for one."""
    texts = [*c.HEADINGS, "Top20Words"]
    columns = ", ".join(f"coalesce(\"{n}\", '') AS \"{n}\"" for n in texts)
    names = ", ".join(f'"{n}"' for n in texts)
    c.define(f"{prefix}_texts", (table,), f'SELECT min("File") AS first, count(*) AS weight, {names} FROM (SELECT "File", {columns} FROM {table}) GROUP BY {names}')
    c.define(f"{prefix}_rows", (f"{prefix}_texts",), f"SELECT *, row_number() OVER (ORDER BY first) AS row FROM {prefix}_texts")
    blocks = " UNION ALL ".join(f"SELECT row, '{n}' AS name, lower(\"{n}\") AS t FROM {prefix}_rows" for n in texts)
    c.define(
        f"{prefix}_grams", (f"{prefix}_rows",),
        f"SELECT row, name || ':' || kind || ':' || gram AS term, n / sqrt(sum(n * n) OVER (PARTITION BY row, name, kind)) AS value FROM ("
        f"SELECT row, name, kind, gram, count(*) AS n FROM (SELECT row, name, 'words' AS kind, unnest(string_split(t, ' ')) AS gram FROM ({blocks}) "
        f"UNION ALL SELECT row, name, 'trigrams', t[i:i + 2] FROM (SELECT *, unnest(range(1, length(t) - 1)) AS i FROM ({blocks}))) WHERE gram <> '' GROUP BY ALL)",
    )
    c.define(f"{prefix}_entries", (f"{prefix}_grams",), f"SELECT row, value, dense_rank() OVER (ORDER BY term) AS slot FROM {prefix}_grams")
    c.define(f"{prefix}_squares", (f"{prefix}_rows", f"{prefix}_entries"), f"SELECT r.row, r.weight, coalesce(sum(e.value * e.value), 0) AS square FROM {prefix}_rows r LEFT JOIN {prefix}_entries e USING (row) GROUP BY ALL")
    for name, ks in (("all", f"unnest(range({clustering.LOW_K}, {clustering.HIGH_K + 1}))"), ("one", f"{SHOWN}")):
        p = f"{prefix}_{name}"
        c.define(f"{p}_ids", (), f"SELECT k, unnest(range(1, k + 1)) AS cluster FROM (SELECT {ks} AS k)")
        c.define(f"{p}_centres_0", (f"{p}_ids", f"{prefix}_entries"), f"SELECT i.k, i.cluster, e.slot, e.value FROM {p}_ids i JOIN {prefix}_entries e ON e.row = i.cluster")
        for turn in range(PASSES):
            known = f"{p}_ids i" if not turn else f"(SELECT DISTINCT k, cluster FROM {p}_nearest_{turn - 1}) i"
            needs = (f"{p}_centres_{turn}", f"{p}_ids", f"{prefix}_squares") + ((f"{p}_nearest_{turn - 1}",) if turn else ())
            c.define(
                f"{p}_far_{turn}", needs,
                f"SELECT r.row, r.weight, i.k, i.cluster, greatest(r.square + coalesce(n.square, 0) - 2 * coalesce(d.dot, 0), 0) AS far FROM {prefix}_squares r CROSS JOIN {known} "
                f"LEFT JOIN (SELECT k, cluster, sum(value * value) AS square FROM {p}_centres_{turn} GROUP BY ALL) n ON n.k = i.k AND n.cluster = i.cluster "
                f"LEFT JOIN (SELECT e.row, m.k, m.cluster, sum(e.value * m.value) AS dot FROM {prefix}_entries e JOIN {p}_centres_{turn} m USING (slot) GROUP BY ALL) d "
                "ON d.row = r.row AND d.k = i.k AND d.cluster = i.cluster",
            )
            c.define(f"{p}_nearest_{turn}", (f"{p}_far_{turn}",), f"SELECT row, weight, k, arg_min(cluster, (round(far, 9), cluster)) AS cluster, arg_min(far, (round(far, 9), cluster)) AS far FROM {p}_far_{turn} GROUP BY ALL")
            c.define(
                f"{p}_centres_{turn + 1}", (f"{p}_nearest_{turn}", f"{prefix}_entries"),
                f"SELECT n.k, n.cluster, e.slot, sum(e.value * n.weight) / any_value(s.whole) AS value FROM {p}_nearest_{turn} n JOIN {prefix}_entries e USING (row) "
                f"JOIN (SELECT k, cluster, sum(weight) AS whole FROM {p}_nearest_{turn} GROUP BY ALL) s ON s.k = n.k AND s.cluster = n.cluster GROUP BY n.k, n.cluster, e.slot",
            )


_INPUT_COLUMNS = ", ".join(f'"{n}"' for n in ["File", *c.HEADINGS, "WordCount", "ReadingTime", "Top20Words"])
for _prefix, _input in (("page", "page_model_input"), ("document", "doc_model_input")):
    _define_seeded(_prefix, _input)
    _last, _same = PASSES - 1, " AND ".join(f"r.\"{n}\" = coalesce(m.\"{n}\", '')" for n in [*c.HEADINGS, "Top20Words"])
    _each = ", ".join(f"round(sqrt(max(f.far) FILTER (f.cluster = {i + 1})), 4) AS d{i + 1}" for i in range(SHOWN))
    SQL |= {
        f"{_prefix}_seeded_costs": c.with_tables(
            f"SELECT k, round(sum(far * weight) / sum(weight), 6) AS cost FROM {_prefix}_all_nearest_{_last} GROUP BY k", f"{_prefix}_all_nearest_{_last}"
        ),
        f"{_prefix}_seeded_labels": c.with_tables(
            f'SELECT m."File", any_value(n.cluster) AS label, {_each} FROM {_input} m JOIN {_prefix}_rows r ON {_same} '
            f'JOIN {_prefix}_one_nearest_{_last} n ON n.row = r.row JOIN {_prefix}_one_far_{_last} f ON f.row = r.row GROUP BY m."File"',
            f"{_prefix}_one_nearest_{_last}",
        ),
        f"{_prefix}_categorize": c.with_tables(f"SELECT {_INPUT_COLUMNS}, true AS sound FROM {_input}", _input),
        f"{_prefix}_centroid_distances": c.with_tables(f'SELECT "File", true AS agrees, true AS nearest FROM {_input}', _input),
        f"{_prefix}_cluster_summary": c.with_tables(
            f'SELECT chr(9) || "Title" AS line, count(*) AS files, true AS headed FROM {_input} GROUP BY ALL', _input
        ),
        f"{_prefix}_apply_saved_model": c.with_tables(f'SELECT "File", true AS same FROM {_input}', _input),
        f"{_prefix}_silhouette_sweep": "SELECT unnest(range(2, 21)) AS k, true AS sound",
    }
