"""Queries of this sub-package and their DuckDB texts: one ``opN_<name>`` for each operator."""

from __future__ import annotations

from . import bpe, chat, decontaminate, language, licenses, near_dups, phrases, pii, quality, repeats, runs, secrets, toxicity
from .common import QueryFn

_QUERIES: dict[str, QueryFn] = {
    "op1_private": pii.op1_private,
    "op2_quality": quality.op2_quality,
    "op3_secrets": secrets.op3_secrets,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_bpe": bpe.op6_bpe,
    "op7_repeats": repeats.op7_repeats,
    "op8_licenses": licenses.op8_licenses,
    "op9_chat": chat.op9_chat,
    "op10_near_dups": near_dups.op10_near_dups,
    "op11_runs": runs.op11_runs,
    "op12_language": language.op12_language,
    "op13_phrases": phrases.op13_phrases,
}

_ORACLE: dict[str, str] = {
    "op2_quality": quality.SQL,
    "op3_secrets": secrets.SQL,
    "op4_decontaminate": decontaminate.SQL,
    "op9_chat": chat.SQL,
    "op13_phrases": phrases.SQL,
}


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
