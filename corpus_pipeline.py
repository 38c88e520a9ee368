"""From raw documents to token identifiers, stage by stage.

Each stage takes all that the one before kept, as a table that was written and
read again, and returns the columns of ``documents``; the last one returns
identifiers.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import decontamination, language_id, line_dedup, sentencepiece_dropout, simhash_dedup
from skylattice.llm.common import cut, spare

#: A document whose language is less certain than this is rejected.
LEAST_SCORE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, by a network that learns from their labels."""
    network = language_id.fit(docs)
    lang, score = spare(docs, "lang_pred"), spare(docs, "score")
    rated = language_id.predict(docs, network, out=lang, score=score)
    sure = (F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= LEAST_SCORE)
    return rated.where(sure).select(docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of any length that stand on many sites."""
    cleaned = line_dedup.remove_boilerplate(docs, removed=spare(docs, "n_removed"))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by three-word shingles and at most three differing bits."""
    return simhash_dedup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers of every document, and whether they decode to its text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = sentencepiece_dropout.encode_checked(docs, path, F.col("doc_id"))
    return done.select("doc_id", "lang", "source", "n_pieces", "lossless", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("line dedup", without_boilerplate),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", encoded),
]

#: SQL has neither the network nor the fingerprints; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
