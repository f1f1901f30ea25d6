"""All queries by key, and the SQL that must give the same rows."""

from pulsegrain.registry import scans, filters, texts, reshaping, measures, corpus, reports  # noqa: F401
from pulsegrain.registry.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
