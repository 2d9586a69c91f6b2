"""The registered queries of this subpackage: each operator with production settings on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftlake.llm import (
    conversation_trie,
    cotraining_quality,
    crf_toxicity,
    fair_mixing,
    ftrl_langid,
    phrase_index,
    pruned_graph_search,
    secret_ledger,
    setsketch_dedup,
    simhash_decontamination,
    skipchain_pii,
    threshold_sketch,
    tree_sharding,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_skip_chain_pii(spark, sf_dir):
    return skipchain_pii.personal_data(_table(spark, sf_dir, "documents"))


def op2_secret_blob_ledger(spark, sf_dir):
    return secret_ledger.scan_documents(_table(spark, sf_dir, "documents"))


def op3_setsketch_near_duplicates(spark, sf_dir):
    return setsketch_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_weighted_tree_shards(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tree_sharding.assign(docs).drop("text")


def op5_cotraining_quality(spark, sf_dir):
    return cotraining_quality.qualities(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_fair_queue_mix(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return fair_mixing.mix(docs).drop("text", "source")


def op7_pruned_graph_neighbours(spark, sf_dir):
    return pruned_graph_search.nearest(_table(spark, sf_dir, "embeddings"))


def op8_simhash_decontamination(spark, sf_dir):
    return simhash_decontamination.contaminations(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op9_ftrl_languages(spark, sf_dir):
    return ftrl_langid.languages(_table(spark, sf_dir, "documents"))


def op10_crf_toxicity(spark, sf_dir):
    return crf_toxicity.scored_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_phrase_collocations(spark, sf_dir):
    return phrase_index.collocations(_table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark, sf_dir):
    return conversation_trie.conversation_nodes(_table(spark, sf_dir, "conversations"))


def op13_threshold_fingerprints(spark, sf_dir):
    return threshold_sketch.edited_documents(_table(spark, sf_dir, "documents"))


_QUERIES = (
    op1_skip_chain_pii,
    op2_secret_blob_ledger,
    op3_setsketch_near_duplicates,
    op4_weighted_tree_shards,
    op5_cotraining_quality,
    op6_fair_queue_mix,
    op7_pruned_graph_neighbours,
    op8_simhash_decontamination,
    op9_ftrl_languages,
    op10_crf_toxicity,
    op11_phrase_collocations,
    op12_conversation_trie,
    op13_threshold_fingerprints,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_fair_queue_mix": fair_mixing.ORACLE_SQL,
        "op11_phrase_collocations": phrase_index.ORACLE_SQL,
        "op12_conversation_trie": conversation_trie.ORACLE_SQL,
    }
