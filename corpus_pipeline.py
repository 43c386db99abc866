"""A corpus pipeline of the text operators: each stage is written as Parquet and read again by the next.

Every stage takes the documents its predecessor kept and returns the columns of documents, the last one its pieces.
Rows travel as one struct beside the columns an operator reads, so further columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import line_dedup, mixing, ngram_join, quality, sentence_pieces
from topicloom.llm.common import read_table, stored, where_computed
from topicloom.llm.queries import piece_model


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*columns, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; those with a null text go."""
    return where_computed(quality.judge(_packed(docs, "text", "lang")), F.col("kept")).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stood before; documents with no line left go."""
    found = where_computed(line_dedup.dedup_lines(_packed(docs, "doc_id", "text")), (F.col("n_kept") > 0) | (F.col("n_lines") == 0))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(row.alias("row")).select("row.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, with digests of the ids and of the text they decode to."""
    return sentence_pieces.piece_digest(docs, piece_model(), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", one_of_near_duplicates),
    ("source_mix", mixed_sources),
    ("sentence_pieces", encoded),
]

#: Mixing draws by hashes and encoding runs a model, so the whole run has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
