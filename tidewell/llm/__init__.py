"""Training-data operators: one module per operator, one query per module.

Nothing outside this subpackage imports it.
"""

from __future__ import annotations

import importlib

_MODULES = (
    "fingerprints",
    "packing",
    "toxicity",
    "language",
    "lines",
    "quality",
    "neardup",
    "html_text",
    "vectors",
    "bpe",
)


def _load():
    return [importlib.import_module(f"{__name__}.{name}") for name in _MODULES]


def queries() -> dict:
    """Query name to callable(spark, sf_dir)."""
    return {m.QUERY: m.query for m in _load()}


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL, where SQL can express the operator."""
    return {m.QUERY: m.ORACLE_SQL for m in _load() if getattr(m, "ORACLE_SQL", None)}
