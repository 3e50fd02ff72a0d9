"""From raw documents to packed training sequences, in five stages of the language-model operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, jaccard_join, packing, quality, secret_scan
from millrace.llm.common import documents, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality votes reject go.

    Null and empty texts are judged as empty ones, repeated rows and ties each by their text; an empty table stays empty; other columns, whatever their names, stay as they are.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays.

    Null and empty texts are equal; a row without doc_id stays only where no equal one has any; of rows repeated with their doc_id one stays; an empty table stays empty; all columns
    stay, whatever their names.
    """
    return exact_dedup.drop_exact_copies(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest doc_id stays.

    Texts without words and rows without doc_id stay; an empty table stays empty; all columns stay, whatever their names.
    """
    return jaccard_join.drop_near_copies(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks; every document stays.

    A null text stays null; an empty table stays empty; all columns stay, whatever their names, and n_chars is set anew.
    """
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences. By then executors hold what earlier stages left, so encoders get less memory.

    A null or empty text is one piece of one id; rows without doc_id and repeated rows are each packed; an empty table gives an empty result; only doc_id and text are read.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), max_cuts=100_000, gathered_chars=1_500_000)


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", keep_first_copies),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack),
]

#: Tokens and votes can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
