"""The registered queries and their SQL twins."""

from __future__ import annotations

from caseweave.catalog import evaluation, handling, preparation

_PARTS = (preparation, handling, evaluation)


def all_queries() -> dict:
    merged = {}
    for part in _PARTS:
        merged.update(part.QUERIES)
    return dict(sorted(merged.items()))


def all_oracles() -> dict:
    merged = {}
    for part in _PARTS:
        merged.update(part.ORACLE)
    return dict(sorted(merged.items()))
