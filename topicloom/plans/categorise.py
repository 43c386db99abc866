"""Step three: model input to labelled documents."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from ..operators import clustering
from ..operators.features import counted_grams, distinct_texts, text_key, vectors, vocabulary
from ..operators.skew import join_salted
from ..schemas import CATEGORIZED
from ..session import materialize, release


@dataclass
class Categorised:
    """Labelled rows, the model, and the sweep behind it."""

    rows: DataFrame
    model: clustering.Model
    sweep: clustering.Sweep


def text_features(rows: DataFrame, terms: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and vectors of the different texts of ``rows``, both stored.

    Grams outside of ``terms`` have no slot, if it is given.
    """
    texts = distinct_texts(rows)
    counted = materialize(counted_grams(texts), "grams")
    terms = vocabulary(counted) if terms is None else terms
    held = vectors(texts, counted, terms)
    release(texts, counted)
    return terms, held


def with_labels(rows: DataFrame, held: DataFrame, model: clustering.Model) -> DataFrame:
    """``rows`` with PredictedLabel and Score, found once for all rows of equal texts."""
    labels = held.select("row", "key").join(clustering.scored(held, model), "row").drop("row")
    keyed = rows.withColumn("key", text_key())
    return join_salted(keyed, materialize(labels, "labels"), "key", ["File"]).drop("key")


def categorise(rows: DataFrame, ks=range(clustering.LOW_K, clustering.HIGH_K + 1),
               metric="distance", max_iter: int = 20) -> Categorised:
    """Featurise once, sweep k, and label the rows with the best model."""
    terms, held = text_features(rows)
    found = clustering.sweep(held, ks, metric=metric, max_iter=max_iter)
    model = replace(found.model, vocabulary=terms)
    labelled = with_labels(rows, held, model).select(*CATEGORIZED.names)
    return Categorised(labelled, model, found)


def apply_model(model: clustering.Model, rows: DataFrame) -> DataFrame:
    """Label new rows with a trained or loaded model; grams it does not know are left out."""
    _, held = text_features(rows, model.vocabulary)
    return with_labels(rows, held, model).select(*CATEGORIZED.names)
