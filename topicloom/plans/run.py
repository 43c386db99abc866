"""The whole run, from a folder of Markdown files to categories and summary."""

from pyspark.sql import SparkSession

from ..operators.clustering import HIGH_K, LOW_K, load_model, save_model
from ..operators.summary import summary_lines
from ..session import spread_input
from ..sources import tables
from ..sources.layout import SessionLayout
from ..sources.markdown_files import scan_markdown, with_file_key
from .categorise import apply_model, categorise
from .extract import extract_documents
from .rank import model_input


def extract_step(spark: SparkSession, root: str, layout: SessionLayout,
                 skip_hidden_names=False, key="File", fmt="parquet") -> None:
    """Write *docs*. ``key="path"`` uses the full path where file keys collide."""
    files = scan_markdown(spark, root, skip_hidden_names=skip_hidden_names)
    if skip_hidden_names:
        files = spread_input(files)
    files = with_file_key(files, root)
    if key == "path":
        files = files.withColumn("File", files["path"])
    tables.write_docs(extract_documents(files.select("File", "content")), layout.docs, fmt)


def rank_step(spark: SparkSession, layout: SessionLayout, fmt="parquet", **options) -> None:
    """Write *model input*, sorted by document."""
    docs = tables.read_docs(spark, layout.docs, fmt)
    tables.write_model_input(model_input(docs, **options).orderBy("File"), layout.model_input, fmt)


def categorise_step(spark: SparkSession, layout: SessionLayout, fmt="parquet",
                    ks=range(LOW_K, HIGH_K + 1), weight="xor", **options):
    """Write the model, *categorized* and the summary; return the sweep."""
    rows = tables.read_model_input(spark, layout.model_input, fmt)
    result = categorise(rows, ks, **options)
    save_model(result.model, layout.model)
    _write_labelled(spark, result.rows, layout, fmt, weight)
    return result.sweep


def _write_labelled(spark, rows, layout, fmt, weight):
    tables.write_categorized(rows, layout.categorized, fmt)
    labelled = tables.read_categorized(spark, layout.categorized, fmt)
    tables.write_summary(summary_lines(labelled, weight=weight), layout.summary)


def apply_step(spark: SparkSession, root: str, layout: SessionLayout, model: str, fmt="parquet",
               weight="xor", extract: dict | None = None, rank: dict | None = None) -> None:
    """Label the documents of a new folder with the model stored at ``model``.

    All tables of the run are written to ``layout``; the model stays as it is.
    Terms are weighed within the new documents.
    """
    extract_step(spark, root, layout, fmt=fmt, **(extract or {}))
    rank_step(spark, layout, fmt=fmt, **(rank or {}))
    rows = tables.read_model_input(spark, layout.model_input, fmt)
    _write_labelled(spark, apply_model(load_model(spark, model), rows), layout, fmt, weight)


def run(spark: SparkSession, root: str, layout: SessionLayout, fmt="parquet",
        extract: dict | None = None, rank: dict | None = None, categorise: dict | None = None):
    """All three steps over stored tables, each with its own options.

    ``extract``: skip_hidden_names, key. ``rank``: k, stop_words, variant.
    ``categorise``: ks, weight, metric, max_iter.
    """
    extract_step(spark, root, layout, fmt=fmt, **(extract or {}))
    rank_step(spark, layout, fmt=fmt, **(rank or {}))
    return categorise_step(spark, layout, fmt=fmt, **(categorise or {}))
