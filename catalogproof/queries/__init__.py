"""Named queries over the given tables, each with its SQL counterpart."""

from catalogproof.queries import documents, markup, paging, records, storage, text  # noqa: F401
from catalogproof.queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
