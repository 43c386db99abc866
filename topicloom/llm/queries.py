"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import chat_tools, conversation_repair, license_scan, line_dedup, merkle, mixing, ngram_join, quality, secret_scan, sentence_pieces, suffix_dedup, url_filter, vector_file
from topicloom.llm.common import read_table


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(read_table(spark, sf_dir, "documents"))


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.piece_digest(read_table(spark, sf_dir, "documents"), piece_model())


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(read_table(spark, sf_dir, "documents")))


#: Verdict, host and path of each rule of the URL query.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mixture(read_table(spark, sf_dir, "documents")))


def op6_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat_tools.conversation_calls(read_table(spark, sf_dir, "conversations"))
    return chat_tools.link_calls(calls, results, chat_tools.ASK)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES).drop("score")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_file.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judge_stored(docs).select(*names)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_digest(read_table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(read_table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(read_table(spark, sf_dir, "documents")))


QUERIES = (op1_line_dedup, op2_ngram_join, op3_sentence_pieces, op4_source_mix, op5_secret_scan, op6_chat_tools, op7_url_filter, op8_exact_top_k, op9_quality_rules, op10_suffix_dedup, op11_conversation_repair, op12_merkle_manifest, op13_license_scan)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.SQL, "op6_chat_tools": chat_tools.SQL, "op8_exact_top_k": vector_file.SQL, "op9_quality_rules": quality.SQL, "op10_suffix_dedup": suffix_dedup.SQL, "op11_conversation_repair": conversation_repair.SQL, "op12_merkle_manifest": merkle.SQL, "op13_license_scan": license_scan.SQL}
