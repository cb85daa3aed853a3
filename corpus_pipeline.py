"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Every stage but the last returns the columns of ``documents``; the last one returns the
packed pieces.  Documents that lose all their words to the substring stage stay as empty
documents, so that the rows of a stage only go by that stage's own decisions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from carelake.llm import decontam, ordinal, packing, simhash, substring
from carelake.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier selects: P(grade 2, sound and clean) of 0.8 or more."""
    return ordinal.keep_selected(docs, table(spark, sf_dir, "labels"), least=0.8)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that link at 3 bits."""
    return simhash.keep_first(docs, shingle=3, max_bits=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeated 20-word windows cover."""
    return substring.rewrite(docs, window=20)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are words of benchmark windows."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", contamination),
    ("best-fit packing", packing_plan),
]
#: the classifier's fit, the fingerprints and the tokens are beyond SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from ``documents`` to the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
