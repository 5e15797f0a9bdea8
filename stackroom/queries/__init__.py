"""Queries over the given tables, each with the SQL that gives the same rows."""

from stackroom.queries import (  # noqa: F401
    catalog,
    commits,
    datasets,
    dedup,
    fields,
    incremental,
    parsing,
    tags,
)
from stackroom.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
