"""Registered queries and the SQL that states the same result.

Every module adds its queries with :func:`registry.query`; importing this package loads them all.
"""

from corpusloom.plans import registry
from corpusloom.plans import (  # noqa: F401  (the imports register the queries)
    chat,
    corpus,
    evals,
    runs,
    streams,
    tokens,
)

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
