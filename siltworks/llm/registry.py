"""The queries of this subpackage and the SQL that their results must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, langid, lm, mixing, pieces, quality, simhash, tokens, topk, vptree


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": quality.op1_quality,
        "op2_simhash": simhash.op2_simhash,
        "op3_topk": topk.op3_topk,
        "op4_vptree": vptree.op4_vptree,
        "op5_mixing": mixing.op5_mixing,
        "op6_pieces": pieces.op6_pieces,
        "op7_chat": chat.op7_chat,
        "op8_tokens": tokens.op8_tokens,
        "op9_lm": lm.op9_lm,
        "op10_langid": langid.op10_langid,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_topk": topk.SQL, "op5_mixing": mixing.SQL, "op7_chat": chat.SQL}
