"""All queries that run over the given tables, with their SQL twins."""

from wellspring.registry import file_queries, load_queries, star_queries, vault_queries  # noqa: F401
from wellspring.registry.checks import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
