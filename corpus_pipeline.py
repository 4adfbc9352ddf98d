"""A corpus made ready for training: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.  All but
the last return the columns of ``documents``; the last adds the tokens.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ebbline.llm import bpe, decontam, exact, nbsvm, near  # noqa: E402
from ebbline.llm.common import save, table  # noqa: E402
from ebbline.session import ship  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of these documents."""
    ship(spark)
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"))
    return nbsvm.score(docs, model).where(F.col("score") >= nbsvm.THRESHOLD).select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one that stays."""
    ship(spark)
    return exact.exact_groups(docs).where("kept").select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash masks find and five-word Jaccard similarity of 0.8 or more links: the least doc_id."""
    ship(spark)
    return near.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that are mostly such passages go."""
    ship(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``n_tokens``, ``ids`` and ``round_trip``: whether the ids decode to the text."""
    ship(spark)
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    own = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    same = F.col("decoded") == F.coalesce("doc.text", F.lit("")).cast("binary")
    return coded.select(*own, F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", encoding),
]

#: The classifier and the near duplicates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each result written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
