"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roompulse.llm import (
    chat,
    chosen_path,
    decontaminate,
    language_id,
    line_cleaning,
    packing,
    page_text,
    prefix_trie,
    revisits,
    sharding,
    suffix_dedup,
    token_files,
    zone_clusters,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_suffix_array_dedup": suffix_dedup.op1_suffix_array_dedup,
    "op2_harmonic_packing": packing.op2_harmonic_packing,
    "op3_chosen_path": chosen_path.op3_chosen_path,
    "op4_revisit_resolution": revisits.op4_revisit_resolution,
    "op5_best_fit_sharding": sharding.op5_best_fit_sharding,
    "op6_chat_template": chat.op6_chat_template,
    "op7_language_id": language_id.op7_language_id,
    "op8_line_cleaning": line_cleaning.op8_line_cleaning,
    "op9_token_files": token_files.op9_token_files,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_page_text": page_text.op12_page_text,
    "op13_zone_clusters": zone_clusters.op13_zone_clusters,
}
ORACLES: dict[str, str] = {
    "op1_suffix_array_dedup": suffix_dedup.OP1_SQL,
    "op3_chosen_path": chosen_path.OP3_SQL,
    "op4_revisit_resolution": revisits.OP4_SQL,
    "op6_chat_template": chat.OP6_SQL,
    "op8_line_cleaning": line_cleaning.OP8_SQL,
    "op10_decontamination": decontaminate.OP10_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_page_text": page_text.OP12_SQL,
    "op13_zone_clusters": zone_clusters.OP13_SQL,
}
