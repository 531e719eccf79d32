"""Corpus pipeline: language ID, exact dedup, near-dedup, benchmark
decontamination, BPE encoding.

Every stage takes all rows that its predecessor kept, written as Parquet and
read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from registrar.llm import bpe, decontam, exact_dedup, langid, minhash
from registrar.llm.common import saved, table
from registrar.llm.queries import TOKENIZER


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text has a language and no ambiguity. The model
    is learned from the labelled rows that are not held out."""
    model = langid.train(langid.held_out(docs).where("not held_out"))
    return langid.keep_known(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every component of near copies (five
    words, similarity 0.8 or more)."""
    return minhash.keep_one(docs, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that contain no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of what is left."""
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", encoding),
]

#: No stage but exact dedup is plain SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs, f"stage-{k}")
    return docs
