"""The engine's queries over the provided tables, and their SQL counterparts."""

from __future__ import annotations


def load() -> dict:
    """All registered queries: name -> (query, SQL or None)."""
    from workload import core, folding, many, queries, selecting, stored  # noqa: F401  (they register their queries)
    return queries.QUERIES
