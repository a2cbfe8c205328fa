"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.llm.bpe import op9_byte_bpe
from wardflow.llm.chat import OP10_SQL, op10_format_chats
from wardflow.llm.common import ship_package
from wardflow.llm.exact import OP3_SQL, op3_exact_dedup
from wardflow.llm.merkle import OP12_SQL, op12_merkle_manifest
from wardflow.llm.near import op6_near_dedup
from wardflow.llm.packing import op4_pack_documents
from wardflow.llm.quality import op7_compression_rules
from wardflow.llm.repair import op1_grammar_ids
from wardflow.llm.resample import op2_importance_resampling
from wardflow.llm.signatures import OP13_SQL, op13_ranked_search
from wardflow.llm.substring import op5_substring_dedup
from wardflow.llm.urls import OP8_SQL, op8_temporal_url_lists
from wardflow.llm.warc import OP11_SQL, op11_warc_packages


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)
    run.__name__ = f.__name__
    return run


QUERIES = {f.__name__: _query(f) for f in (
    op1_grammar_ids, op2_importance_resampling, op3_exact_dedup, op4_pack_documents,
    op5_substring_dedup, op6_near_dedup, op7_compression_rules, op8_temporal_url_lists, op9_byte_bpe, op10_format_chats,
    op11_warc_packages, op12_merkle_manifest, op13_ranked_search,
)}

SQL: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op8_temporal_url_lists": OP8_SQL,
    "op10_format_chats": OP10_SQL,
    "op11_warc_packages": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
