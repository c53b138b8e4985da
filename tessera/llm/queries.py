"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import (conversation_repair, line_keep, line_quality, mixing, packing, phrase_dedup, secret_links, simhash_blocks, token_counts,
                         toxicity, url_rules, vector_graph, whitening)
from tessera.llm.common import table
from tessera.llm.oracles import ORACLES  # noqa: F401


def op1_embedding_dedup(spark, sf_dir):
    return vector_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrase_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op5_mixing(spark, sf_dir):
    drawn = mixing.sample_documents(table(spark, sf_dir, "documents"), rate=mixing.RATE)
    return drawn.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled", "target_gap")


def op6_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "n_blocking")


def op7_secret_scan(spark, sf_dir):
    found = secret_links.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op8_simhash(spark, sf_dir):
    return simhash_blocks.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op9_line_quality(spark, sf_dir):
    return line_quality.judge_documents(table(spark, sf_dir, "documents"), **line_quality.NOTICES)


def op10_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark, sf_dir):
    told = conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))
    return told.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")


def op13_line_dedup(spark, sf_dir):
    return line_keep.dedup_lines(table(spark, sf_dir, "documents")).drop("keep")


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_url_filter": op6_url_filter,
    "op7_secret_scan": op7_secret_scan,
    "op8_simhash": op8_simhash,
    "op9_line_quality": op9_line_quality,
    "op10_token_counts": op10_token_counts,
    "op11_whitening": op11_whitening,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_line_dedup": op13_line_dedup,
}
