"""Registered queries with, where SQL can express them, the SQL that must give the same rows."""

from tablework.catalog.registry import QUERIES, SQL  # noqa: F401
from tablework.catalog import (  # noqa: F401
    charts, cleaning, grouping, joins, learning, matrices, selection, sources, statistics,
)
