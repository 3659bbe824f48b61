"""Queries and statements of the operators of this subpackage."""

from __future__ import annotations

from . import chat, decontaminate, divergence, mtree, whitening, exact_dedup, language, language_model, licenses, mixing, sharding, shingle_join, tokens

MODULES = [tokens, licenses, language, mixing, sharding, language_model, exact_dedup, decontaminate, chat, shingle_join, divergence, mtree, whitening]


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_statements() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
