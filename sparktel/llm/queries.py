"""The registered queries opN_<name> of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktel.llm import ann, decontamination, html_extraction, language_id, line_dedup, ngram_join, sentencepiece_codec, substring_dedup, token_store, warc
from sparktel.llm.common import table


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file; SPARKTEL_TOKENIZERS names another folder."""
    if folder := os.environ.get("SPARKTEL_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"), host="source").select("doc_id", "n_lines", "n_removed", "text")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), n=35)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), share=20, n=13)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_store_read(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"), n=5, percent=75)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest_documents(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


_ALL = (op1_ann, op2_line_dedup, op3_substring_dedup, op4_language_id, op5_decontamination, op6_warc, op7_token_store, op8_ngram_jaccard_join, op9_html_extraction, op10_sentencepiece)
_SQL = {"op2_line_dedup": line_dedup.ORACLE, "op3_substring_dedup": substring_dedup.ORACLE, "op5_decontamination": decontamination.ORACLE, "op6_warc": warc.ORACLE, "op8_ngram_jaccard_join": ngram_join.ORACLE}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
