"""A training corpus from raw documents: each stage takes the documents that the one before it kept.

language_id      documents without a letter (or text) go; a missing lang is filled in
line_dedup       boilerplate lines of a site (`source`) go from its documents; n_chars follows the text
ngram_join       of each group of linked near-duplicates the document with the smallest doc_id stays (null last)
decontamination  documents with a twentieth or more of their words in benchmark windows go
sentencepiece    whole texts to token ids, and the sha256 of the text that they decode to

Rows are told apart by doc_id and text together, so null and repeated ids do no harm; of equal rows one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktel.llm import decontamination, language_id, line_dedup, ngram_join, sentencepiece_codec
from sparktel.llm.common import fits_broadcast, remove, row_key, table, work_dir, written
from sparktel.llm.queries import tokenizer
from sparktel.session import ship

#: Rows that go are sent to all tasks up to this size, which is counted first; beyond it they are joined by key.
BROADCAST_BYTES = 32 << 20


def _key(docs: DataFrame) -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), row_key(docs, "doc_id", "text").alias("h"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of docs whose _key isn't in gone(_key)."""
    gone = written(docs.sparkSession, gone.select("_key"), "gone")
    return docs.join(F.broadcast(gone) if fits_broadcast(gone, 64, BROADCAST_BYTES) else gone, "_key", "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark, chain=True)
    model = language_id.fit(docs)
    found = language_id.predict(docs, model, names=("_lang", "_score")).where(F.col("_lang") != language_id.UND)
    return found.withColumn("lang", F.coalesce("lang", "_lang")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark, chain=True)
    out = line_dedup.drop_boilerplate(docs, host="source")
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark, chain=True)
    keyed = docs.withColumn("_key", _key(docs))
    groups = ngram_join.link_components(keyed, key="_key")  # a written table
    out = _without(keyed, groups.where(F.col("_key") != F.col("component_id")))
    if not groups.groupBy("_key").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["_key"])
    return out.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark, chain=True)
    keyed = docs.withColumn("_key", _key(docs))
    found = decontamination.decontaminate(keyed, table(spark, sf_dir, "benchmark"), key="_key")
    return _without(keyed, found.where("contaminated")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark, chain=True)
    out = sentencepiece_codec.encode_documents(docs, tokenizer("piece_bpe_32k.model"), with_text=False, with_digest=True)
    return out.select("doc_id", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_join", join_near_duplicates),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: The first and last stages can't be put in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's result a written table that the next one reads and that goes when it is done.

    The last stage's input stays, as its result is computed from it when it is asked for.
    """
    ship(spark, chain=True)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
