"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat,
    common,
    decontaminate,
    language_id,
    mixing,
    ngram_join,
    oracles,
    pages,
    pii,
    quality,
    ranked_search,
    role_repair,
    secrets,
    token_store,
    vectors,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_mixing": mixing.op1_mixing,
        "op10_main_text": pages.op10_main_text,
        "op11_role_repair": role_repair.op11_role_repair,
        "op12_personal_data": pii.op12_personal_data,
        "op13_ranked_search": ranked_search.op13_ranked_search,
        "op2_language_id": language_id.op2_language_id,
        "op3_chat_format": chat.op3_chat_format,
        "op4_ngram_join": ngram_join.op4_ngram_join,
        "op5_quality": quality.op5_quality,
        "op6_secrets": secrets.op6_secrets,
        "op7_token_store": token_store.op7_token_store,
        "op8_near_vectors": vectors.op8_near_vectors,
        "op9_decontaminate": decontaminate.op9_decontaminate,
    }
    return {name: common.shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL can express; tests hold the others against brute force."""
    return dict(oracles.ORACLES)
