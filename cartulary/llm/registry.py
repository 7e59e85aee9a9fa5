"""The queries of the operators, one each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartulary.llm import sql
from cartulary.llm.chat_format import op5_chat_format
from cartulary.llm.context_tree import op6_context_tree_scores
from cartulary.llm.decontamination import op7_decontamination
from cartulary.llm.embedding_dedup import op12_embedding_dedup
from cartulary.llm.lexical_search import op13_lexical_search
from cartulary.llm.line_dedup import op4_line_dedup
from cartulary.llm.minhash_dedup import op2_minhash_dedup
from cartulary.llm.packing import op10_packing
from cartulary.llm.quality import op8_quality_rules
from cartulary.llm.secret_scan import op9_secret_scan
from cartulary.llm.substring_dedup import op1_substring_dedup
from cartulary.llm.suffix_dedup import op3_suffix_dedup
from cartulary.llm.turn_repair import op11_turn_repair

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    found = (
        op1_substring_dedup,
        op2_minhash_dedup,
        op3_suffix_dedup,
        op4_line_dedup,
        op5_chat_format,
        op6_context_tree_scores,
        op7_decontamination,
        op8_quality_rules,
        op9_secret_scan,
        op10_packing,
        op11_turn_repair,
        op12_embedding_dedup,
        op13_lexical_search,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
