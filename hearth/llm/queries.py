"""Queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hearth.llm import (
    chat_masks, circulant_minhash, containment, glr_repair, group_join, link_trust, multiset_hash, piece_count, prefix_bpe, repeat_removal,
    secret_ledger, toxicity, trie_frontier,
)
from hearth.llm.common import id_text, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


@query("op9_document_fingerprints", multiset_hash.SQL)
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edited_documents(id_text(table(spark, sf_dir, "documents")))


@query("op5_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return prefix_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op4_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_secret_scan", secret_ledger.SQL)
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.document_findings(id_text(table(spark, sf_dir, "documents")))


#: A conversation whose turns look like a chat template.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op7_chat_format")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return chat_masks.format_digests(turns.unionByName(probe), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_benchmark_decontamination", containment.SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op8_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op2_url_filters", link_trust.SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge(table(spark, sf_dir, "pages"))


@query("op1_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeat_removal.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_spelling_variants", trie_frontier.SQL)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_frontier.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return glr_repair.repair_digests(table(spark, sf_dir, "conversations"))


@query("op13_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"))
