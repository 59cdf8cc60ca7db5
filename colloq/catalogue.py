"""All queries of the engine by name, each a function of (spark, sf_dir), and their SQL."""

from __future__ import annotations

from .plans import coding, language, measures, sources, study

_PARTS = (measures, language, coding, sources, study)
QUERIES = {k: f for part in _PARTS for k, f in part.QUERIES.items()}


def oracle() -> dict[str, str]:
    """The SQL texts; some hold word lists that need a session."""
    return {k: q() if callable(q) else q for part in _PARTS for k, q in part.ORACLE.items()}
