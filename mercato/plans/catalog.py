"""Imports every query module so their ``@register`` calls run."""

from __future__ import annotations

import importlib

from mercato.plans.registry import ORACLE, QUERIES

_MODULES = [
    "mercato.plans.q_features",
    "mercato.plans.q_pairs",
    "mercato.plans.q_quality",
    "mercato.plans.q_eda",
    "mercato.plans.q_store",
    "mercato.plans.q_sources",
    "mercato.plans.q_streaming",
    "mercato.plans.q_lineage",
    "mercato.plans.q_extras",
    "mercato.plans.q_tables",
    "mercato.plans.q_bronze",
    "mercato.plans.q_dirty",
    "mercato.plans.q_serving",
]


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracle_sql():
    _load()
    return dict(ORACLE)
