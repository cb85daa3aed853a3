"""The operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import (arc, chat, collisions, decontam, divergence, extract, licenses, negatives, ordinal, packing, simhash,
                          sql, substring, winnow)
from carelake.llm.common import staged, table


def op1_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprint_neighbours(table(spark, sf_dir, "documents"), k=16, window=64, short=512,
                                         short_window=16)


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.archive_pages(table(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ordinal.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), least=0.8)
    return found.select(F.col("c0").alias("doc_id"), F.col("r_expected_grade").alias("expected_grade"),
                        F.col("r_tail_probability").alias("tail_probability"), "keep")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.digest(found)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_main_text(table(spark, sf_dir, "pages"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=20).select(
        F.col("c0").alias("doc_id"), F.col("r_n_words").alias("n_words"), F.col("r_n_removed").alias("n_removed"),
        F.sha2("r_kept", 256).alias("kept_sha256"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                  capacity=4096, end_id=1)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.per_document(licenses.scan(docs, licenses.fit(docs), least=0.6, similarity=0.8))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(staged(chat.prefix_target_examples(rows.unionByName(extra)), "chat"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=10, top_terms=10)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), n_positives=5, n_negatives=10, low=30, high=90, every=100,
                          scale=256, label=shifted)


def op13_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98, recall=0.99)


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_winnow, op2_arc_to_warc, op3_quality, op4_decontaminate, op5_simhash, op6_extract, op7_substring, op8_pack,
        op9_licenses, op10_chat, op11_divergence, op12_negatives,
        op13_collisions)}


def oracle_sql() -> dict[str, str]:
    return {"op4_decontaminate": sql.DECONTAMINATE, "op10_chat": sql.CHAT, "op11_divergence": sql.DIVERGENCE,
            "op12_negatives": sql.NEGATIVES, "op13_collisions": sql.COLLISIONS}
