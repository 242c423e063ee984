"""Corpus pipeline over ``documents``: language ID, near-dedup, removal of repeated passages, packing.

Each stage gets what its predecessor wrote and works on all of it. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procweave.llm import langid, lpf, minhash_forest, packing, storage

#: A text goes if its language is predicted with less than this score.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text has a language: those without text or letters go, and those of which the model, fitted
    on a sample of the labelled rows, cannot tell the language."""
    names = docs.columns
    found = langid.predict(docs, langid.fit(docs), lang_as="__lang", score_as="__score")
    return found.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= LEAST_SCORE)).select(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least doc_id of each group of near copies (five words, 0.8). Rows that repeat a doc_id are one
    document, of which each distinct text stays once, with the least of its other columns; rows without one are kept."""
    kept = minhash_forest.near_duplicates(docs).where("kept").select("doc_id")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id", "text")
    one = rows.agg(F.min(F.struct(*rest)).alias("__rest")).select("doc_id", "text", "__rest.*").select(*docs.columns)
    return one.unionByName(docs.where(F.col("doc_id").isNull()))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of at least 50 bytes that a document of smaller doc_id has too; n_chars follows. A row is known by its
    doc_id and the digest of its text, so each stays beside its own columns. Rows without a doc_id stay as they are."""
    texts = lpf.without_repeats(docs.where(F.col("doc_id").isNotNull())).dropDuplicates(["doc_id", "text_sha256"])
    keyed = docs.withColumn("text_sha256", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    joined = keyed.drop("text", "n_chars").join(texts, ["doc_id", "text_sha256"])
    out = joined.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
    return out.unionByName(docs.where(F.col("doc_id").isNull()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the stream of all documents into sequences of 4096 tokens; one row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", remove_repeats),
    ("packing", pack),
]

#: SQL cannot run the tokenizer or the classifier; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        docs, path = storage.written(stage(spark, docs, sf_dir), name)
        storage.remove(spark, *before)
        before = [path]
    return docs
