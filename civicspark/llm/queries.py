"""Registered queries opN_<name> over the driver's tables, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chat, decontamination, embeddings, language, lexical_search, mixing, oracles, packing, prefix_trie, sharding, simhash, substring_dedup,
    suffix_dedup, toxicity,
)
from .common import gapless, keep, table

SHARDS = 24

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op11_lexical_search": oracles.LEXICAL_SEARCH,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_hash_tree(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    tree = sharding.uniform_tree(SHARDS)
    placed = sharding.assign(sharding.assign(rows, tree), sharding.grow(tree), out="grown_shard")
    return gapless(keep(placed, "shards"), ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op3_best_fit_packing(spark, sf_dir):
    found = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.pack(found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


@query
def op4_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_substring_dedup(spark, sf_dir):
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_benchmark_decontamination(spark, sf_dir):
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", "differing_bits", "similarity")


@query
def op8_chat_format(spark, sf_dir):
    found = chat.transcripts(table(spark, sf_dir, "conversations"))
    learned = F.pmod(F.crc32(F.col("transcript").cast("binary")), F.lit(3)) != 1
    done = chat.formatted_transcripts(found, chat.train(found.where(learned)))
    return done.select("row.conv_id", "row.segment", "n_lines", F.size("roles").alias("n_turns"),
                       F.array_join("roles", ",").alias("roles"), "chat")


@query
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identified(docs.select("doc_id", "text"), language.train(docs))
    return found.select("row.doc_id", "lang_pred", "score", "accepted").withColumn("held_out", language.held_out())


@query
def op10_embedding_near_dedup(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "n_links", "component_id", "kept")


@query
def op11_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_source_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
