"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyworks.llm import bitplanes, chat_format, chosen_path, decontamination, divergence, license_scan, merkle, mil, packing, quality_rules, toxicity, unigram, warc
from tallyworks.llm.oracle import ORACLE
from tallyworks.llm.staging import fresh_path, staged, table


def op1_robust_outliers(spark: SparkSession, d: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, d, "documents"), ["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "outlier_distance", "own_share")


def op2_chosen_path(spark: SparkSession, d: str) -> DataFrame:
    return chosen_path.similarity_join(table(spark, d, "documents"))


def op3_attention_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return mil.score(docs, mil.fit(docs, table(spark, d, "labels")))


def op4_bit_planes(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "planes")
    bitplanes.write_ids(table(spark, d, "documents"), path, public_tokenizers.path("word_bpe_49k.json"),
                        keep_white=False, end_id=1)
    return bitplanes.read_documents(spark.read.schema(bitplanes.CHUNK_SCHEMA).parquet(path))


def op5_warc_chunks(spark: SparkSession, d: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    manifest = warc.write_warc(warc.typed_records(table(spark, d, "pages")), folder)
    chunks = warc.read_chunks(manifest, folder, with_data=False)
    return chunks.where("last").select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def op6_mixture_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        keep_white=True, end_id=0, targets=packing.EQUAL)


def op7_unigram_counts(spark: SparkSession, d: str) -> DataFrame:
    return unigram.token_counts(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_seeded_alignment(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("row")


def op9_lexicon_automaton(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, d, "labels")))


def op10_diagonal_votes(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.scan(table(spark, d, "documents"))


def op11_role_machine(spark: SparkSession, d: str) -> DataFrame:
    chats = chat_format.with_probe(table(spark, d, "conversations"))
    written = staged(chat_format.segments(chats), "chat-segments")
    verdict = chat_format.validate(chats).withColumnRenamed("conv_id", "id")
    read = chat_format.digests(chat_format.read_back(written))
    return (read.join(verdict, F.col("conv_id").eqNullSafe(F.col("id")))
            .select(*read.columns, "faults", (F.col("complete") & (F.col("faults") == 0)).alias("valid")))


def op12_term_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit(table(spark, d, "documents"))


def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.verified(merkle.manifest(table(spark, d, "documents")))


QUERIES = {
    "op1_robust_outliers": op1_robust_outliers,
    "op2_chosen_path": op2_chosen_path,
    "op3_attention_quality": op3_attention_quality,
    "op4_bit_planes": op4_bit_planes,
    "op5_warc_chunks": op5_warc_chunks,
    "op6_mixture_packing": op6_mixture_packing,
    "op7_unigram_counts": op7_unigram_counts,
    "op8_seeded_alignment": op8_seeded_alignment,
    "op9_lexicon_automaton": op9_lexicon_automaton,
    "op10_diagonal_votes": op10_diagonal_votes,
    "op11_role_machine": op11_role_machine,
    "op12_term_divergence": op12_term_divergence,
    "op13_merkle_manifest": op13_merkle_manifest,
}

__all__ = ["ORACLE", "QUERIES"]
