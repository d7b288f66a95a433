"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import collocations, conversations, decontaminate, html_extract, langid, pieces, pii, sharding, simhash, substrings, token_file, toxicity, winnow
from millrace.llm.common import table
from millrace.session import scratch_dir


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.LanguageModel(langid.learnable(docs)).predict(docs)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.ToxicityModel(docs, toxicity.learnable(table(spark, sf_dir, "labels"))).score(docs)
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprints(table(spark, sf_dir, "documents"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-file")
    token_file.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_file.read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.audit(conversations.damaged(rows), rows.select("conv_id"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shards(table(spark, sf_dir, "documents"), 24)
    return dealt.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_language_id": op2_language_id,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_pii": op6_pii,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_token_ids": op9_token_ids,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_sharding": op13_sharding,
}
