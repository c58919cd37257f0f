"""Queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from atelier.llm import chat_masks, chosen_path, collocations, conversation_trie, decontaminate, html_crf, jump_shards, packing, pii_tagger, source_mixing, suffix_rules, warc_revisit, zstd_quality
from atelier.llm.common import table

QUERIES = {
    "op1_revisit_resolution": lambda spark, d: warc_revisit.revisits_of_pages(table(spark, d, "pages")),
    "op2_latent_decontamination": lambda spark, d: decontaminate.find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op3_pii_tagger": lambda spark, d: pii_tagger.tag_documents(table(spark, d, "documents")),
    "op4_crf_extraction": lambda spark, d: html_crf.extract(table(spark, d, "pages")),
    "op5_length_buckets": lambda spark, d: packing.pack_documents(table(spark, d, "documents")),
    "op6_compression_quality": lambda spark, d: zstd_quality.classify(table(spark, d, "documents"), table(spark, d, "labels")),
    "op7_suffix_repetition": lambda spark, d: suffix_rules.repetition_rules(table(spark, d, "documents")),
    "op8_jump_sharding": lambda spark, d: jump_shards.shard_rows(table(spark, d, "documents")),
    "op9_chat_masks": lambda spark, d: chat_masks.masks_of_conversations(table(spark, d, "conversations")),
    "op10_chosen_path_join": lambda spark, d: chosen_path.jaccard_join(table(spark, d, "documents")),
    "op11_priority_mixing": lambda spark, d: source_mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "labels")),
    "op12_truncation_trie": lambda spark, d: conversation_trie.trie_of_conversations(table(spark, d, "conversations")),
    "op13_hat_collocations": lambda spark, d: collocations.collocations(table(spark, d, "documents")),
}

ORACLES = {
    "op1_revisit_resolution": warc_revisit.revisits_of_pages_sql(),
    "op8_jump_sharding": jump_shards.shard_rows_sql(),
    "op9_chat_masks": chat_masks.masks_of_conversations_sql(),
    "op10_chosen_path_join": chosen_path.jaccard_join_sql(),
    "op11_priority_mixing": source_mixing.mix_documents_sql(),
    "op12_truncation_trie": conversation_trie.trie_of_conversations_sql(),
    "op13_hat_collocations": collocations.collocations_sql(),
}
