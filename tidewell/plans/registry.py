"""All queries of the reference's operators, by name, and their DuckDB SQL."""

from __future__ import annotations

from tidewell.plans import identity_queries, page_queries, report_queries, scope_queries, slug_queries, stream_queries, text_queries

MODULES = (identity_queries, page_queries, report_queries, scope_queries, slug_queries, stream_queries, text_queries)


def queries() -> dict:
    return {name: fn for m in MODULES for name, (fn, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
